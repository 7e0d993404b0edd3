"""Explicit schemas of the landing feeds and the raw-response table. Instants are TIMESTAMP read in UTC."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType,
                               TimestampType)


def _f(name, t):
    return StructField(name, t, True)


_LABELS = ArrayType(StructType([_f("description", StringType())]))

# Field names and types of the catalogue feeds.
CATALOG_SNAPSHOT = StructType([
    _f("appid", IntegerType()), _f("name", StringType()), _f("last_modified", LongType()),
    _f("price_change_number", LongType()), _f("extracted_at", TimestampType()),
])

CHANGE_LOG = StructType([_f("appid", IntegerType()), _f("extracted_at", TimestampType())])

DETAILS = StructType([
    _f("appid", IntegerType()),
    _f("extracted_at", TimestampType()),
    _f("is_free", BooleanType()),
    _f("short_description", StringType()),
    _f("header_image", StringType()),
    _f("developers", ArrayType(StringType())),
    _f("publishers", ArrayType(StringType())),
    _f("price_overview", StructType([_f("currency", StringType()), _f("initial", LongType()),
                                     _f("final", LongType()), _f("discount_percent", IntegerType())])),
    _f("metacritic", StructType([_f("score", IntegerType())])),
    _f("genres", _LABELS),
    _f("categories", _LABELS),
    _f("release_date", StructType([_f("coming_soon", BooleanType()), _f("date", StringType())])),
    _f("extracted_at_game", TimestampType()),
])

REVIEWS = StructType([
    _f("appid", IntegerType()), _f("review_score", IntegerType()), _f("review_score_desc", StringType()),
    _f("total_positive", LongType()), _f("total_negative", LongType()), _f("total_reviews", LongType()),
    _f("extracted_at", TimestampType()),
])

# player_count is BIGINT here (an INT field turns 3,000,000,000 into null).
ACTIVITY = StructType([_f("appid", IntegerType()), _f("player_count", LongType()),
                       _f("extracted_at", TimestampType())])

RAW_RESPONSE = StructType([
    _f("feed", StringType()), _f("key", IntegerType()), _f("attempt", IntegerType()), _f("status", IntegerType()),
    _f("payload", StringType()), _f("received_at", TimestampType()),
])

CATALOG_PAGE = StructType([_f("response", StructType([
    _f("apps", ArrayType(StructType([_f("appid", IntegerType()), _f("name", StringType()),
                                     _f("last_modified", LongType()), _f("price_change_number", LongType())]))),
    _f("have_more_results", BooleanType()),
    _f("last_appid", IntegerType()),
]))])
