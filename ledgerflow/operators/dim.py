"""Dimensions: the calendar (date) dimension and the cleansed catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.scalars import epoch_seconds_to_ts, iso_year_week, year_week


def date_rows(dates: DataFrame, col: str = "full_date") -> DataFrame:
    """Calendar attributes for a column of DATEs.

    date_key yyyymmdd int; ISO week number; ``year_week`` glues the calendar year to the ISO week (the catalogue's
    form, so 2021-01-01 is '2021-53'); ``iso_year_week`` uses the ISO year; Saturday and Sunday are weekend.
    """
    d = F.col(col)
    return dates.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.month(d).alias("month_num"),
        F.weekofyear(d).alias("week_num"),
        F.dayofmonth(d).alias("day_of_month"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        year_week(d).alias("year_week"),
        iso_year_week(d).alias("iso_year_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
    )


def date_dim(spark: SparkSession, start, end) -> DataFrame:
    """One row per day from ``start`` to ``end``, both inclusive (literal dates)."""
    bounds = spark.range(1).select(F.lit(start).cast("date").alias("lo"), F.lit(end).cast("date").alias("hi"))
    return date_dim_between(bounds, "lo", "hi")


def date_dim_between(bounds: DataFrame, lo: str, hi: str) -> DataFrame:
    """Date dimension spanning bounds computed by Spark (e.g. min/max of a fact's dates).

    ``bounds`` has one row. The series is days between the bounds: its size is set by the calendar span, not by
    the fact table's row count.
    """
    days = bounds.select(F.explode(F.sequence(F.col(lo), F.col(hi), F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    return date_rows(days)


def date_dim_for(facts: DataFrame, ts_col: str) -> DataFrame:
    """Date dimension covering every day from the first to the last date in ``facts.ts_col``."""
    d: Column = F.to_date(F.col(ts_col))
    bounds = facts.agg(F.min(d).alias("lo"), F.max(d).alias("hi"))
    return date_dim_between(bounds, "lo", "hi")


def clean_catalog(df: DataFrame, key: str = "appid", name: str = "name",
                  last_modified: str = "last_modified", ts=epoch_seconds_to_ts) -> DataFrame:
    """Valid names only (not null, not empty); epoch seconds -> timestamp; three columns."""
    return (df.where(F.col(name).isNotNull() & (F.col(name) != ""))
            .select(key, name, ts(F.col(last_modified)).alias(last_modified)))
