"""The recurring runs, as plain ordered function calls (bronze -> silver -> gold).

``run_daily``    ``ingest`` (details and reviews that have landed; never gated) -> ``history`` (SCD2 price history, review
                 fact) -> ``refresh_catalog`` (snapshot, change log, cleansed catalogue; once per logical day) ->
                 ``refresh_reviews`` (items to ask reviews for; its own gate) -> ``pending_worklist`` -> ``gold``.
``run_activity`` activity ingest; hour/day fact; gold view.

Fetching from the remote API is outside the engine: runs consume whatever has landed; a landing folder that is not there
means that nothing has landed. Every step is idempotent (checkpointed streams, a dimension that ignores versions it has, whole tables or
whole days replaced) and the two gates are marked only after their step has ended, so a failed run is simply run again.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType, TimestampType

from ledgerflow import schemas
from ledgerflow.functions.calendar import batch_due, logical_day_py
from ledgerflow.operators import bridge, dim, facts, responses, scd2, worklist
from ledgerflow.operators.flatten import flatten_details
from ledgerflow.plans.publish import BucketedDimension
from ledgerflow.session import path_exists
from ledgerflow.sources.landing import RESCUED, with_rescued
from ledgerflow.sources.tables import (append_table, create_once, create_view_once, ensure_namespace, replace_partition,
                                       swap_table, table_exists)
from ledgerflow.streaming.ingest import append_available_now, table_stream

# The date dimension's span.
DATE_DIM_FIRST, DATE_DIM_LAST = "2020-01-01", "2030-12-31"


@dataclass(frozen=True)
class Site:
    landing: str          # landing root: pages/<logical day>/, details/, reviews/, activity/
    state: str            # shared folder: stream checkpoints and the versioned price history
    db: str = "ledgerflow"
    layout: str = "array"      # of the landing files; "lines" can be split over tasks
    files_per_trigger: int = 1000     # a backlog comes in micro-batches of this many files
    buckets: int = 64          # of the price history
    clean_source: str = "off"  # "delete" or "archive" where the landing folder is this engine's to clean

    def t(self, name: str) -> str:
        return f"{self.db}.{name}"

    def ck(self, name: str) -> str:
        return f"{self.state}/checkpoints/{name}"


def _versions(details: DataFrame) -> DataFrame:
    """Flat details; the labels also as arrays, which a comma in a label does not part."""
    return flatten_details(details.select("*", F.col("genres.description").alias("genre_names"),
                                          F.col("categories.description").alias("category_names")))


def details_dimension(spark: SparkSession, site: Site) -> BucketedDimension:
    flat = _versions(spark.createDataFrame([], schemas.DETAILS).withColumn(RESCUED, F.lit(None).cast("string")))
    schema = StructType(flat.schema.fields + [StructField(scd2.IS_CURRENT, BooleanType()),
                                              StructField(scd2.START, TimestampType()),
                                              StructField(scd2.END, TimestampType())])
    # two fetches of an item at one time: the one asked for last, then the rescued text
    return BucketedDimension(site.t("details_scd2"), f"{site.state}/details_scd2", schema, key="appid", version="extracted_at_game",
                             tie=("extracted_at", RESCUED, "final_price", "initial_price"), buckets=site.buckets)


def _table_or_empty(spark: SparkSession, name: str, schema: str) -> DataFrame:
    return spark.table(name) if table_exists(spark, name) else spark.createDataFrame([], schema)


def _ingest(spark: SparkSession, site: Site, feed: str, schema: StructType) -> bool:
    """Append what has newly landed of one feed to its bronze table; False when its folder is not there."""
    path, name = f"{site.landing}/{feed}", f"{feed}_bronze"
    if not path_exists(spark, path):
        return False
    options = {"maxFilesPerTrigger": site.files_per_trigger}
    if site.clean_source != "off":
        options["cleanSource"] = site.clean_source
        if site.clean_source == "archive":
            options["sourceArchiveDir"] = f"{site.state}/archive/{feed}"
    landed = with_rescued(spark, path, schema, layout=site.layout, stream=True, **options)
    append_available_now(landed, site.ck(name), table=site.t(name))
    return True


def ingest(spark: SparkSession, site: Site) -> None:
    """What landed of details and reviews, exactly once, whatever the state of the catalogue."""
    _ingest(spark, site, "details", schemas.DETAILS)
    _ingest(spark, site, "reviews", schemas.REVIEWS)


def history(spark: SparkSession, site: Site) -> BucketedDimension:
    """Silver: price history (every version of new bronze rows put in its place), review fact.

    Rows without key or version time (malformed records among them) are no versions; they stay in view.
    """
    hist = details_dimension(spark, site)
    if table_exists(spark, site.t("details_bronze")):
        create_view_once(spark, site.t("details_quarantine"), f"SELECT * FROM {site.t('details_bronze')} "
                         "WHERE appid IS NULL OR extracted_at_game IS NULL")
        hist.apply_stream(_versions(table_stream(spark, site.t("details_bronze"))), site.ck("details_scd2"))
    if table_exists(spark, site.t("reviews_bronze")):
        append_available_now(facts.rating(table_stream(spark, site.t("reviews_bronze"))), site.ck("reviews_silver"),
                             table=site.t("reviews_silver"))
    return hist


def _gate(spark: SparkSession, site: Site, step: str, now: dt.datetime):
    """One row: is ``step`` due in the logical day of ``now``, and in which day did it last end."""
    done = _table_or_empty(spark, site.t("steps_done"), "step string, at timestamp")
    return batch_due(done.where(F.col("step") == step), "at", F.lit(now)).first()


def _mark(spark: SparkSession, site: Site, step: str, now: dt.datetime) -> None:
    done = spark.range(1).select(F.lit(step).alias("step"), F.lit(now).cast("timestamp").alias("at"))
    append_table(done, site.t("steps_done"))


def _snapshot_of(spark: SparkSession, site: Site, day: dt.date) -> DataFrame:
    return spark.table(site.t("catalog_days")).where(F.col("logical_day") == F.lit(day)).drop("logical_day")


def refresh_catalog(spark: SparkSession, site: Site, now: dt.datetime, pages_dir: str | None = None) -> dict:
    """Catalogue snapshot of the logical day, its change log against the last ended day, cleansed catalogue.

    Each day's snapshot and change log are partitions that a rerun of the same day writes anew; the day counts as done
    only when all of them are written. Pages whose chain has not ended, or has gaps, are half a catalogue: the step waits
    for the rest (``incomplete``).
    """
    gate, day = _gate(spark, site, "catalog", now), logical_day_py(now)
    pages_dir = pages_dir or f"{site.landing}/pages/{day}"
    if not gate["due"] or not path_exists(spark, pages_dir):
        return {"ran": False, "last_day": gate["last_day"]}
    pages = spark.read.text(pages_dir, wholetext=True).select(F.col("value").alias("payload"))
    chain = responses.chain_complete(responses.page_chain(pages)).first()
    if chain is None or not chain["complete"]:
        return {"ran": False, "last_day": gate["last_day"], "incomplete": True}
    replace_partition(responses.flatten_pages(pages, extracted_at=now), site.t("catalog_days"), "logical_day", day)
    snap = _snapshot_of(spark, site, day)
    if gate["last_day"] is not None:
        old = _snapshot_of(spark, site, gate["last_day"])
        changed = worklist.changed(snap, old, "appid", cmp=["last_modified"], keep=["extracted_at"])
        replace_partition(changed, site.t("change_log"), "logical_day", day)
    swap_table(dim.clean_catalog(snap), site.t("catalog_clean"))
    create_view_once(spark, site.t("dim_items"), f"SELECT appid, name AS appName FROM {site.t('catalog_clean')}")
    _mark(spark, site, "catalog", now)
    return {"ran": True, "last_day": day}


def refresh_reviews(spark: SparkSession, site: Site, now: dt.datetime) -> dict:
    """Items to ask reviews for: the cleansed catalogue, once per logical day by the reviews' own gate."""
    gate = _gate(spark, site, "reviews", now)
    if not gate["due"] or not table_exists(spark, site.t("catalog_clean")):
        return {"ran": False, "last_day": gate["last_day"]}
    asked = spark.table(site.t("catalog_clean")).select("appid", F.lit(now).cast("timestamp").alias("requested_at"))
    swap_table(asked, site.t("reviews_worklist"))
    _mark(spark, site, "reviews", now)
    return {"ran": True, "last_day": logical_day_py(now)}


def pending_worklist(spark: SparkSession, site: Site, now: dt.datetime) -> None:
    """Items whose details are to be fetched (stays a table; the fetcher reads it). After the ingest, so that what has
    landed is not asked for again."""
    last = _gate(spark, site, "catalog", now)["last_day"]
    if last is None:
        return
    fetched = _table_or_empty(spark, site.t("details_bronze"), "appid int, extracted_at timestamp")
    changes = _table_or_empty(spark, site.t("change_log"), "appid int, extracted_at timestamp")
    swap_table(worklist.pending(_snapshot_of(spark, site, last), changes.select("appid", "extracted_at"),
                                fetched.select("appid", "extracted_at")), site.t("worklist"))


def gold(spark: SparkSession, site: Site, hist: BucketedDimension) -> None:
    current = scd2.current_rows(hist.read(spark))
    create_view_once(spark, site.t("price_history"), facts.price_view_sql(hist.name))
    for labels, one, label in (("developers", "developer", "developer"), ("publishers", "publisher", "publisher"),
                               ("genre_names", "genre", "genre_name"), ("category_names", "category", "category_name")):
        swap_table(bridge.from_array(current, "appid", labels, label), site.t(f"item_{one}"))
    create_once(dim.date_dim(spark, DATE_DIM_FIRST, DATE_DIM_LAST), site.t("dim_date"))
    if table_exists(spark, site.t("reviews_silver")):
        create_view_once(spark, site.t("review_scores"), f"SELECT * EXCEPT (extracted_at) FROM {site.t('reviews_silver')}")


def run_daily(spark: SparkSession, site: Site, now: dt.datetime, pages_dir: str | None = None) -> dict:
    """All steps in order. ``ran``: the catalogue was refreshed; the other steps always do what there is to do."""
    ensure_namespace(spark, site.db)
    ingest(spark, site)
    hist = history(spark, site)
    catalog = refresh_catalog(spark, site, now, pages_dir)
    reviews = refresh_reviews(spark, site, now)
    pending_worklist(spark, site, now)
    gold(spark, site, hist)
    return {**catalog, "reviews_ran": reviews["ran"]}


def run_activity(spark: SparkSession, site: Site) -> None:
    ensure_namespace(spark, site.db)
    _ingest(spark, site, "activity", schemas.ACTIVITY)
    if not table_exists(spark, site.t("activity_bronze")):
        return
    append_available_now(facts.snapshot(table_stream(spark, site.t("activity_bronze")).drop(RESCUED)),
                         site.ck("activity_silver"), table=site.t("activity_silver"))
    create_view_once(spark, site.t("activity_hours"),
                     f"SELECT appid, player_count, snapshot_date, snapshot_hour FROM {site.t('activity_silver')}")
