"""Registered queries: the engine's operators run over the driver tables (whole tables, no id subsets).

The driver tables stand in for the catalogue feeds:
  item -> ``events.user_id`` (or ``part``/``customer``); version time -> ``events.ts``; nested payload ->
  ``events.props`` JSON; prices in minor units -> ``orders.o_totalprice * 100``; delimited labels -> ``part.p_name``;
  epoch seconds -> ``1700000000 + events.event_id``. Business cuts (batch boundaries, "fetched" records) are
  predicates on time or value, never on ids.
Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.calendar import batch_due, logical_day
from ledgerflow.functions.payload import parse
from ledgerflow.functions.scalars import (epoch_seconds_to_ts_ntz, hour_of, iso_year_week, join_labels,
                                          to_minor_units)
from ledgerflow.operators import analytics, bridge, dim, facts, responses, scd2, worklist
from ledgerflow.operators.flatten import FlattenSpec, flatten, flatten_details
from ledgerflow.operators.sequence import latest_per_key, with_neighbours
from ledgerflow import schemas
from ledgerflow.session import fresh_dir, materialize, work_dir
from ledgerflow.sources.landing import FILE, MALFORMED, RESCUED, read_landing, with_rescued, write_batches
from ledgerflow.sources.tables import append_table, bucketed_table, read_table, swap_table
from ledgerflow.streaming.ingest import append_available_now, file_stream, table_stream
from ledgerflow.streaming.rollup import ActivityRollup

# Business cut points of the scenarios below.
BATCH_CUTS = (dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 20))
OLD_SNAPSHOT_BEFORE = dt.datetime(2024, 1, 30)
WORKLIST_SNAPSHOT_BEFORE = dt.datetime(2024, 1, 29)
DETAILS_MIN_VALUE = 100.0
HOT_SLICE_ROWS = 700
CHURN_FALL, CHURN_GAP = 0.5, 3
VERSIONED_FROM = 50.0
ORDERS_SINCE = dt.datetime(2001, 1, 1)
PAIRS_BEFORE = dt.datetime(2024, 1, 3)
AS_OF = dt.datetime(2024, 1, 15)
GATE_NOW = dt.datetime(2024, 1, 31, 12, 0)
EPOCH_BASE = 1_700_000_000
PAGE_SIZE = 500
SHIFT_ALERT = 50.0
LATE_CUTS = (60.0, 200.0)
LABEL_FILTER = {"all_of": ("small",), "any_of": ("ring", "gear", "bolt"), "none_of": ("bolt",)}


def _ntz(v: dt.datetime):
    return F.lit(v.isoformat(sep=" ")).cast("timestamp_ntz")


def _purchases(spark, sf_dir) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return ev.where(F.col("event_type") == "purchase").select("user_id", "event_id", "ts", "value")


# ---- calendar / facts -------------------------------------------------------------------------------------------

def q_logical_day(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return ev.groupBy(logical_day("ts").alias("logical_day")).agg(F.count(F.lit(1)).alias("n"))


def q_snapshot_fact(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id", "value", "ts")
    return facts.snapshot(ev, observed="ts")


def q_snapshot_hour(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return (ev.groupBy(hour_of("ts").alias("snapshot_hour"), F.to_date("ts").alias("snapshot_date"))
            .agg(F.count(F.lit(1)).alias("n")))


def q_batch_gate(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return batch_due(ev, "ts", _ntz(GATE_NOW), by=["event_type"])


def _daily_ratings(spark, sf_dir) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    g = (ev.groupBy("user_id", F.to_date("ts").alias("__day"))
         .agg(F.count_if(F.col("event_type") == "purchase").alias("total_positive"),
              F.count(F.lit(1)).alias("total_reviews"), F.max("ts").alias("extracted_at")))
    return facts.rating(g, keep=("user_id",))


def q_rating(spark, sf_dir):
    return _daily_ratings(spark, sf_dir)


def q_star_except(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return spark.sql("SELECT * EXCEPT (props) FROM {ev}", ev=ev)


def q_price_view(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    minor = o.select("o_orderkey", "o_orderdate", "o_orderstatus", to_minor_units("o_totalprice").alias("final_price"))
    return facts.price_view(minor, key="o_orderkey", version="o_orderdate", minor_cols=("final_price",),
                            keep=("o_orderstatus",))


def q_catalog_clean(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    cat = ev.select(F.col("event_id"), F.col("event_type").alias("name"),
                    (F.lit(EPOCH_BASE) + F.col("event_id")).alias("last_modified"))
    return dim.clean_catalog(cat, key="event_id", ts=epoch_seconds_to_ts_ntz)


def q_date_dim(spark, sf_dir):
    return dim.date_dim_for(read_table(spark, sf_dir, "orders"), "o_orderdate")


def q_iso_year_week(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return li.groupBy(iso_year_week(F.to_date("l_shipdate")).alias("iso_year_week")).agg(
        F.count(F.lit(1)).alias("n"))


# ---- flatten / labels / bridges --------------------------------------------------------------------------------

def q_flatten_json(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    nested = ev.select("event_id", parse("props", "struct<k:int>").alias("props"))
    return flatten(nested, FlattenSpec(lift={"k": "props.k"}, drop=("props",)))


def q_concat_labels(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    return p.select("p_partkey", join_labels(F.array_sort(F.split("p_name", " "))).alias("labels"))


def q_bridge_delimited(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    return bridge.from_delimited(p, "p_partkey", "p_name", "label", sep=" ")


def q_bridge_array(spark, sf_dir):
    p = read_table(spark, sf_dir, "part").select("p_brand", F.split("p_name", " ").alias("words"))
    return bridge.from_array(p, "p_brand", "words", "label")


def q_bridge_filter(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    b = bridge.from_delimited(p, "p_partkey", "p_name", "label", sep=" ", unique=False)
    return bridge.items_with_label(p.select("p_partkey", "p_brand"), b, "p_partkey", "label", "ring")


# ---- SCD2 ------------------------------------------------------------------------------------------------------

def q_scd2_build(spark, sf_dir):
    return scd2.build(_purchases(spark, sf_dir), "user_id", "ts", tie="event_id")


def q_scd2_incremental(spark, sf_dir):
    base = _purchases(spark, sf_dir)
    first = scd2.build(base.where(F.col("ts") < _ntz(BATCH_CUTS[0])), "user_id", "ts", tie="event_id")
    return scd2.apply(first, base, "user_id", "ts", tie="event_id")


def q_scd2_batches(spark, sf_dir):
    base = _purchases(spark, sf_dir)
    lo, hi = _ntz(BATCH_CUTS[0]), _ntz(BATCH_CUTS[1])
    batches = [base.where(F.col("ts") < lo), base.where((F.col("ts") >= lo) & (F.col("ts") < hi)),
               base.where(F.col("ts") >= hi)]
    dim_ = scd2.build(scd2.latest_per_key(batches[0], "user_id", ["ts", "event_id"]), "user_id", "ts",
                      tie="event_id")
    for b in batches[1:]:
        # cut the lineage between batches (a written table in the shared folder): without it every earlier batch
        # is recomputed by each later one
        dim_ = scd2.apply(materialize(dim_, "scd2-batch"), b, "user_id", "ts", tie="event_id")
    return dim_


def q_scd2_published(spark, sf_dir):
    """The three batches of ``scd2_batches`` through the on-disk publish protocol (commit log + partitions)."""
    from ledgerflow.plans.publish import VersionedDimension

    base = _purchases(spark, sf_dir)
    lo, hi = _ntz(BATCH_CUTS[0]), _ntz(BATCH_CUTS[1])
    batches = [base.where(F.col("ts") < lo), base.where((F.col("ts") >= lo) & (F.col("ts") < hi)),
               base.where(F.col("ts") >= hi)]
    schema = scd2.build(base.limit(0), "user_id", "ts", tie="event_id", skew_safe=False).schema
    target = VersionedDimension(fresh_dir(spark, "scd2-published"), schema, "user_id", "ts", tie="event_id")
    for i, b in enumerate(batches):
        target.apply_batch(spark, b, src=f"purchases:{i}")
    return target.read(spark)


def q_latest_per_key(spark, sf_dir):
    return latest_per_key(read_table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"])


def q_price_as_of(spark, sf_dir):
    """The version of every item that was valid at one instant: of the versions up to then, the latest (no history is
    built)."""
    upto = scd2.versioned(_purchases(spark, sf_dir), "user_id", "ts").where(F.col("ts") <= _ntz(AS_OF))
    return latest_per_key(upto, "user_id", ["ts", "event_id"]).select("user_id", "value", "ts")


def q_price_as_of_join(spark, sf_dir):
    """Price valid at every product view (point-in-time lookup of each view against the purchase history)."""
    ev = read_table(spark, sf_dir, "events")
    hist = scd2.build(_purchases(spark, sf_dir), "user_id", "ts", tie="event_id")
    views = ev.where(F.col("event_type") == "view").select("event_id", "user_id", "ts")
    return scd2.as_of_join(views, hist, "user_id", "ts", ["value"], tie="event_id")


def q_price_moves(spark, sf_dir):
    return analytics.price_moves(_purchases(spark, sf_dir), "user_id", "ts", "value", tie="event_id")


def _slice_rows(rows: DataFrame) -> int:
    """Rows a slice that split the largest keys into some dozens of slices, at any size of the input."""
    return max(HOT_SLICE_ROWS, rows.count() // 64)


def _neighbours(rows, order):
    """(k, event_id, value, prev_value, next_value) over rows (k, event_id, value, ...), keys split."""
    out = with_neighbours(rows, "k", order, ["value"], rows_per_slice=_slice_rows(rows))
    return out.select(F.coalesce("k", F.lit(-1)).alias("k"), "event_id", "value", "prev_value", "next_value")


def q_neighbours_hot(spark, sf_dir):
    """All views are one item's: the split of hot keys is forced by the argument."""
    ev = read_table(spark, sf_dir, "events")
    k = F.when(F.col("event_type") == "view", F.lit(0)).otherwise(F.col("user_id"))
    return _neighbours(ev.select(k.cast("long").alias("k"), "event_id", "ts", "value"), ["ts", "event_id"])


def q_neighbours_null_keys(spark, sf_dir):
    """Views have no key: they belong to no item and have no neighbours."""
    ev = read_table(spark, sf_dir, "events")
    k = F.when(F.col("event_type") != "view", F.col("user_id"))
    return _neighbours(ev.select(k.cast("long").alias("k"), "event_id", "ts", "value"), ["ts", "event_id"])


def q_neighbours_text_version(spark, sf_dir):
    """A text as first ordering column, with split keys."""
    ev = read_table(spark, sf_dir, "events").withColumn("version", F.date_format("ts", "yyyy-MM-dd"))
    k = F.when(F.col("event_type") == "view", F.lit(0)).otherwise(F.col("user_id"))
    return _neighbours(ev.select(k.cast("long").alias("k"), "event_id", "version", "value"), ["version", "event_id"])


def q_neighbours_tied(spark, sf_dir):
    """One day for all rows of a day: slices part ties on the first ordering column."""
    ev = read_table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return _neighbours(ev.select(F.lit(0).cast("long").alias("k"), "event_id", "day", "value"), ["day", "event_id"])


def _null_versions(spark, sf_dir):
    """Purchases whose version time is missing below a value, with their true time as ``at``."""
    base = _purchases(spark, sf_dir)
    return base.withColumn("at", F.col("ts")).withColumn("ts", F.when(F.col("value") >= VERSIONED_FROM, F.col("ts")))


def q_scd2_null_version(spark, sf_dir):
    base = _null_versions(spark, sf_dir)
    first = scd2.build(base.where(F.col("at") < _ntz(BATCH_CUTS[0])).drop("at"), "user_id", "ts", tie="event_id")
    return scd2.apply(first, base.drop("at"), "user_id", "ts", tie="event_id")


def q_scd2_quarantine(spark, sf_dir):
    return scd2.quarantine(_null_versions(spark, sf_dir), "user_id", "ts").select("user_id", "event_id", "at", "value")


def q_scd2_mode_all(spark, sf_dir):
    base = _purchases(spark, sf_dir)
    first = scd2.build(base.where(F.col("ts") < _ntz(BATCH_CUTS[0])), "user_id", "ts", tie="event_id")
    return scd2.apply(first, base.where(F.col("ts") >= _ntz(BATCH_CUTS[0])), "user_id", "ts", tie="event_id", mode="all")


def q_scd2_stage(spark, sf_dir):
    base = _purchases(spark, sf_dir)
    first = scd2.build(base.where(F.col("ts") < _ntz(BATCH_CUTS[0])), "user_id", "ts", tie="event_id")
    staged = scd2.stage(base, first, "user_id", "ts", tie="event_id")
    return staged.withColumn("merge_key", F.coalesce("merge_key", F.lit(-1)))


def q_score_shift(spark, sf_dir):
    daily = _daily_ratings(spark, sf_dir).select("user_id", F.col("extracted_at_Date").alias("day"),
                                                 "review_score")
    return analytics.score_shift(daily, "user_id", "day", "review_score", SHIFT_ALERT)


def q_peak_activity(spark, sf_dir):
    return analytics.peak_activity(read_table(spark, sf_dir, "events"), "user_id", "ts", "value", "hour")


def _activity(spark, sf_dir, grain: str) -> DataFrame:
    # minor units: sums of integers are exact in any order
    ev = read_table(spark, sf_dir, "events").select("user_id", "ts", to_minor_units("value").alias("value"))
    found = analytics.peak_activity(ev, "user_id", "ts", "value", grain, mean="mean")
    dates = dim.date_dim_between(ev.agg(F.to_date(F.date_trunc("week", F.min("ts"))).alias("lo"), F.to_date(F.max("ts")).alias("hi")), "lo", "hi")
    return analytics.with_dates(found, dates, grain)


def q_activity_by_day(spark, sf_dir):
    return _activity(spark, sf_dir, "day")


def q_activity_by_week(spark, sf_dir):
    return _activity(spark, sf_dir, "week")


def q_activity_churn(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    daily = ev.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return analytics.activity_churn(daily, "user_id", "day", "n", CHURN_FALL, CHURN_GAP).fillna(-1)


def q_as_of_text_tie(spark, sf_dir):
    """As ``price_as_of_join`` by day, where only a text tells versions of one time apart."""
    ev = read_table(spark, sf_dir, "events").withColumn("day", F.to_date("ts").cast("timestamp_ntz"))
    bought = ev.where(F.col("event_type") == "purchase").select("user_id", "day", "value", F.format_string("%012d", "event_id").alias("tie"))
    hist = scd2.build(bought, "user_id", "day", tie="tie")
    views = ev.where(F.col("event_type") == "view").select("event_id", "user_id", "day")
    return scd2.as_of_join(views, hist, "user_id", "day", ["value"], tie="tie").fillna(-1.0)


# ---- joins / worklists ---------------------------------------------------------------------------------------

def q_anti_single(spark, sf_dir):
    c, o = read_table(spark, sf_dir, "customer"), read_table(spark, sf_dir, "orders")
    recent = (o.where(F.col("o_orderdate") >= _ntz(ORDERS_SINCE)).select(F.col("o_custkey").alias("c_custkey"))
              .distinct())   # one row per customer on the build side, whatever the order count
    return c.select("c_custkey").join(recent, on="c_custkey", how="left_anti")


def q_anti_composite(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    seen = ev.where(F.col("ts") < _ntz(PAIRS_BEFORE)).select("user_id", "event_type").distinct()
    return ev.select("user_id", "event_id", "event_type").join(seen, on=["user_id", "event_type"],
                                                               how="left_anti").select("user_id", "event_id")


def _snapshots(spark, sf_dir, before: dt.datetime):
    ev = read_table(spark, sf_dir, "events")
    new = ev.groupBy("user_id").agg(F.max("ts").alias("lm"))
    old = ev.where(F.col("ts") < _ntz(before)).groupBy("user_id").agg(F.max("ts").alias("lm"))
    return ev, new, old


def q_changed_keys(spark, sf_dir):
    _, new, old = _snapshots(spark, sf_dir, OLD_SNAPSHOT_BEFORE)
    return worklist.changed(new, old, "user_id", cmp=["lm"], keep=["lm"])


def q_pending_worklist(spark, sf_dir):
    ev, new, old = _snapshots(spark, sf_dir, WORKLIST_SNAPSHOT_BEFORE)
    changes = worklist.changed(new, old, "user_id", cmp=["lm"], keep=["lm"])
    details = (ev.where((F.col("event_type") == "purchase") & (F.col("value") >= DETAILS_MIN_VALUE))
               .select("user_id", F.col("ts").alias("lm")))
    return worklist.pending(new, changes, details, key="user_id", at="lm")


# ---- responses ------------------------------------------------------------------------------------------------

def _raw_responses(spark, sf_dir) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    feed = (F.when(F.col("value") < 20, "activity").when(F.col("value") < 60, "details").otherwise("reviews"))
    status = (F.when(F.col("value") >= 300, F.lit(None).cast("int"))
              .when(F.col("event_type") == "purchase", 200).when(F.col("event_type") == "view", 429)
              .when(F.col("event_type") == "click", 403).when(F.col("event_type") == "signup", 420)
              .otherwise(500))
    return ev.select(feed.alias("feed"), F.col("user_id").alias("key"), F.col("event_id").alias("attempt"),
                     status.alias("status"), F.col("props").alias("payload"), F.col("ts").alias("received_at"))


def _full_responses(spark, sf_dir) -> DataFrame:
    """Attempts of all feeds whose bodies carry, by the hour, no JSON, an error, an empty, a wrong or a whole body."""
    ev = read_table(spark, sf_dir, "events")
    feed = F.when(F.col("value") < 20, "activity").when(F.col("value") < 60, "details").otherwise("reviews")
    status = (F.when(F.col("value") >= 300, F.lit(None).cast("int")).when(F.col("event_type") == "view", 429)
              .when(F.col("event_type") == "signup", 403).otherwise(200))
    key, cents, hour = F.col("user_id"), F.round(F.col("value") * 100).cast("bigint"), F.hour("ts")
    details = F.format_string('{"%d": {"success": true, "data": {"is_free": false, "price_overview": {"final": %d}, '
                              '"genres": [{"description": "%s"}]}}, "0x": 5}', key, cents, "event_type")
    whole = (F.when(feed == "activity", F.format_string('{"response": {"player_count": %d}}', F.col("event_id") + 3000000000))
             .when(feed == "details", details)
             .otherwise(F.format_string('{"query_summary": {"review_score": 8, "review_score_desc": "%s", "total_positive": '
                                        '%d, "total_negative": 1, "total_reviews": %d}}', "event_type", cents, cents + 1)))
    empty = (F.when(feed == "activity", F.lit('{"response": {}}'))
             .when(feed == "details", F.format_string('{"%d": {"success": false}}', key)).otherwise(F.lit('{"query_summary": {}}')))
    wrong = (F.when(feed == "activity", F.lit('{"response": 5}'))
             .when(feed == "details", F.format_string('{"%d": {"success": true}}', key)).otherwise(F.lit('{"query_summary": null}')))
    payload = (F.when(hour < 3, F.expr("left(w, length(w) - 2)")).when(hour < 6, F.lit('{"error": "x"}')).when(hour < 9, F.col("e"))
               .when(hour < 12, F.col("x")).otherwise(F.col("w")))
    return (ev.select(feed.alias("feed"), key.alias("key"), F.col("event_id").alias("attempt"), status.alias("status"),
                      whole.alias("w"), empty.alias("e"), wrong.alias("x"), "ts", F.to_date("ts").cast("timestamp_ntz").alias("requested_at"))
            .select("feed", "key", "attempt", "status", payload.alias("payload"), F.col("ts").alias("received_at"), "requested_at"))


def q_outcome_counts(spark, sf_dir):
    return responses.outcome_counts(responses.classify(_full_responses(spark, sf_dir)))


def q_outcome_statuses(spark, sf_dir):
    """Bodies that lack everything a feed needs, over all statuses."""
    return responses.outcome_counts(responses.classify(_raw_responses(spark, sf_dir)))


def q_normalize_activity(spark, sf_dir):
    return responses.normalize(_full_responses(spark, sf_dir), "activity")


def q_normalize_details(spark, sf_dir):
    rows = responses.normalize(_full_responses(spark, sf_dir), "details")
    return rows.select("appid", "extracted_at", "is_free", F.col("price_overview.final").alias("final_price"),
                       F.col("genres")[0]["description"].alias("genre"), "extracted_at_game")


def q_normalize_reviews(spark, sf_dir):
    rows = responses.normalize(_full_responses(spark, sf_dir), "reviews")
    return rows.fillna(-1)      # numbers that the body leaves out


def q_retry_by_feed(spark, sf_dir):
    """Attempts a round differ by feed (an item's attempts of one day)."""
    attempts = responses.classify(_full_responses(spark, sf_dir)).withColumn("day", F.to_date("received_at"))
    return responses.retry_worklist(attempts, ["key", "day"])


def q_retry_worklist(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    outcome = (F.when(F.col("event_type") == "purchase", "ok").when(F.col("event_type") == "error", "drop")
               .otherwise("retry"))
    attempts = ev.select("user_id", F.to_date("ts").alias("day"), "event_id", outcome.alias("outcome"))
    return responses.retry_worklist(attempts, ["user_id", "day"], attempt="event_id", feed=None,
                                    attempts_per_round=1, max_rounds=3)


def q_page_flatten(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    item = F.struct(F.col("c_custkey").cast("int").alias("appid"), F.col("c_name").alias("name"),
                    to_minor_units("c_acctbal").alias("last_modified"),
                    F.col("c_nationkey").cast("bigint").alias("price_change_number"))
    # pages of at most PAGE_SIZE keys: groups bounded by the page size, not by the data
    pages = (c.groupBy(F.floor(F.col("c_custkey") / PAGE_SIZE).alias("page"))
             .agg(F.collect_list(item).alias("apps"), F.max("c_custkey").cast("int").alias("last_appid"))
             .select(F.to_json(F.struct(F.struct("apps", F.lit(True).alias("have_more_results"),
                                                 "last_appid").alias("response"))).alias("payload")))
    return responses.flatten_pages(pages, extracted_at=GATE_NOW).drop("extracted_at")


# ---- landing / streaming --------------------------------------------------------------------------------------

def q_rescued_rows(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    landing = fresh_dir(spark, "landing-events")
    write_batches(ev, landing)
    known = ev.drop("props").schema
    rows = with_rescued(spark, landing, known, layout="lines")
    return rows.select("event_id", "user_id", "event_type", "value", "ts",
                       F.get_json_object("_rescued_data", "$.props").alias("rescued_props"))


def _landed_lines(spark, sf_dir, cut: bool) -> DataFrame:
    """Events landed as JSON lines: clicks overflow ``amount``, views have text in it, every record has an unknown nested
    key; with ``cut`` the line of an error event ends early. Read back typed, with the rescued column."""
    ev = read_table(spark, sf_dir, "events")
    amount = (F.when(F.col("event_type") == "view", F.lit('"n/a"')).when(F.col("event_type") == "click", F.lit("3000000000"))
              .otherwise(F.col("user_id").cast("string")))
    line = F.format_string('{"event_id": %d, "amount": %s, "inner": {"k": %d, "extra": "%s"}}', "event_id", amount, "user_id", "event_type")
    if cut:
        line = F.when(F.col("event_type") == "error", F.substring(line, 1, 40)).otherwise(line)
    landing = fresh_dir(spark, "landing-lines")
    ev.select(line.alias("value")).write.text(landing)
    schema = "event_id bigint, amount int, inner struct<k: int>"
    return with_rescued(spark, landing, spark.createDataFrame([], schema).schema, layout="lines")


def q_iso_timestamps(spark, sf_dir):
    """Times landed as ISO texts of UTC, with microseconds or (low values) without."""
    ev = read_table(spark, sf_dir, "events")
    text = F.concat(F.when(F.col("value") < 50, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
                    .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")), F.lit("+00:00"))
    landing = fresh_dir(spark, "landing-times")
    ev.select(F.to_json(F.struct("event_id", text.alias("extracted_at"))).alias("value")).write.text(landing)
    schema = spark.createDataFrame([], "event_id bigint, extracted_at timestamp").schema
    rows = with_rescued(spark, landing, schema, layout="lines")
    return rows.select("event_id", F.col("extracted_at").cast("timestamp_ntz").alias("extracted_at"), F.col(RESCUED).isNull().alias("clean"))


def q_rescued_types(spark, sf_dir):
    r = _landed_lines(spark, sf_dir, cut=False)
    return r.fillna(-1).select("event_id", "amount", F.col("inner.k").alias("k"), F.get_json_object(RESCUED, "$.amount").alias("rescued_amount"),
                    F.get_json_object(RESCUED, "$['inner.extra']").alias("rescued_extra"))


def q_rescued_malformed(spark, sf_dir):
    r = _landed_lines(spark, sf_dir, cut=True)
    return r.fillna(-1).select("event_id", "amount", F.get_json_object(RESCUED, f"$.{MALFORMED}").alias("malformed"),
                    F.get_json_object(RESCUED, f"$.{FILE}").isNotNull().alias("has_file"))


def q_stream_snapshot(spark, sf_dir):
    schema = read_table(spark, sf_dir, "events").schema
    src = file_stream(spark, sf_dir, schema, fmt="parquet", glob="events.parquet")
    out = fresh_dir(spark, "stream-snapshot")
    fact = facts.snapshot(src.select("event_id", "user_id", "value", "ts"), observed="ts")
    append_available_now(fact, f"{out}/_checkpoint", path=f"{out}/data")
    return spark.read.parquet(f"{out}/data")


def q_scd2_published_full(spark, sf_dir):
    """Every purchase, in batches by value: each batch brings versions older than those that are there."""
    base = _purchases(spark, sf_dir)
    target = _bucketed_dimension(spark, base)
    for lo, hi in zip((None, *LATE_CUTS), (*LATE_CUTS, None), strict=True):
        part = base if lo is None else base.where(F.col("value") >= lo)
        target.apply_batch(spark, part if hi is None else part.where(F.col("value") < hi))
    target.apply_batch(spark, base.where(F.col("value") >= LATE_CUTS[-1]))      # a replay changes nothing
    return target.read(spark)


def _bucketed_dimension(spark, base):
    from ledgerflow.plans.publish import BucketedDimension

    schema = scd2.build(base.limit(0), "user_id", "ts", tie="event_id", skew_safe=False).schema
    place = fresh_dir(spark, "scd2-bucketed")
    return BucketedDimension(place.rsplit("/", 1)[1].replace("-", "_"), place, schema, "user_id", "ts", tie="event_id", buckets=16)


def q_scd2_one_key(spark, sf_dir):
    """Files of the published dimension after a batch of the item with the dearest purchase: those of its bucket only are
    new. One row: buckets, and buckets whose files changed."""
    base = _purchases(spark, sf_dir)
    target = _bucketed_dimension(spark, base)
    target.apply_batch(spark, base)
    files = lambda: set(spark.sql(f"SELECT DISTINCT bucket, input_file_name() AS f FROM {target.name}").collect())
    before = files()
    dearest = base.agg(F.max(F.struct("value", "event_id", "user_id")).alias("one")).select("one.user_id")
    late = base.join(dearest, "user_id").select("user_id", (F.col("event_id") + 1).alias("event_id"), (F.col("ts") + F.expr("INTERVAL 1 SECOND")).alias("ts"), "value")
    target.apply_batch(spark, late)
    spark.catalog.refreshTable(target.name)
    changed = {b for b, _ in files() ^ before}
    return spark.table(target.name).agg(F.count(F.lit(1)).alias("versions"), F.lit(len(changed)).cast("long").alias("buckets_changed"))


def q_price_islands(spark, sf_dir):
    """Runs of equal prices in steps of 10; all cheap purchases are one item's, and keys are split by force."""
    base = _purchases(spark, sf_dir)
    k = F.when(F.col("value") < 40, F.lit(0)).otherwise(F.col("user_id")).cast("long")
    rows = base.select(k.alias("user_id"), "event_id", "ts", F.floor(F.col("value") / 10).alias("price"))
    return analytics.price_islands(rows, "user_id", "ts", "price", tie="event_id", rows_per_slice=_slice_rows(rows))


def q_activity_rollup(spark, sf_dir):
    """Activity by week out of hourly partials, after three runs of the stream, the last of which finds nothing new."""
    ev = read_table(spark, sf_dir, "events").select("user_id", "ts", to_minor_units("value").alias("value"))
    place = fresh_dir(spark, "rollup")
    roll = ActivityRollup(f"{place}/state", "user_id", "ts", "value")
    for part in (ev.where(F.col("ts") < _ntz(BATCH_CUTS[0])), ev.where(F.col("ts") >= _ntz(BATCH_CUTS[0])), None):
        if part is not None:
            part.write.mode("append").parquet(f"{place}/landed")
        roll.apply_stream(file_stream(spark, f"{place}/landed", ev.schema), f"{place}/checkpoint")
    return roll.read(spark, "week")


def q_bridge_multi(spark, sf_dir):
    """Parts with both of two labels, one of two others, and none of a fifth."""
    p = read_table(spark, sf_dir, "part")
    b = bridge.from_delimited(p, "p_partkey", "p_name", "label", sep=" ", unique=False)
    return bridge.items_with_labels(p.select("p_partkey", "p_brand"), b, "p_partkey", "label", **LABEL_FILTER)


def q_page_chain(spark, sf_dir):
    """A catalogue a market segment: pages of one key range each, some of which end before the next one's start."""
    c = read_table(spark, sf_dir, "customer")
    page = F.floor(F.col("c_custkey") / PAGE_SIZE)
    last = c.agg(F.max(page).alias("last_page"))
    item = F.struct(F.col("c_custkey").cast("int").alias("appid"), F.col("c_name").alias("name"))
    pages = (c.groupBy("c_mktsegment", page.alias("page")).agg(F.collect_list(item).alias("apps"), F.max("c_custkey").cast("int").alias("last_appid"))
             .join(last).select("c_mktsegment", (F.col("page") * PAGE_SIZE - 1).alias("start"), F.to_json(F.struct(F.struct(
                 "apps", (F.col("page") < F.col("last_page")).alias("have_more_results"), "last_appid").alias("response"))).alias("payload")))
    return responses.page_chain(pages, start="start", chain="c_mktsegment")


def q_rescued_nested(spark, sf_dir):
    """Unknown keys and wrong types inside arrays of structs inside a struct."""
    ev = read_table(spark, sf_dir, "events")
    line = F.format_string('{"event_id": %d, "box": {"items": [{"k": %d}, {"k": %d, "extra": "%s", "deep": {"a": 1, "b": [%d]}}]}}',
                           "event_id", "user_id", "user_id", "event_type", "event_id")
    landing = fresh_dir(spark, "landing-nested")
    ev.select(line.alias("value")).write.text(landing)
    schema = spark.createDataFrame([], "event_id bigint, box struct<items: array<struct<k: int, deep: struct<a: int>>>>").schema
    r = with_rescued(spark, landing, schema, layout="lines")
    return r.select("event_id", F.col("box.items")[1]["deep"]["a"].alias("a"), F.get_json_object(RESCUED, "$['box.items[1].extra']").alias("extra"),
                    F.get_json_object(RESCUED, "$['box.items[1].deep.b']").alias("b"))


def q_table_swap(spark, sf_dir):
    """A table replaced twice under its readers' view, then a third time by a run that stops before the swap."""
    ev = read_table(spark, sf_dir, "events")
    name = fresh_dir(spark, "swap").rsplit("/", 1)[1].replace("-", "_")
    for day, stop in ((BATCH_CUTS[1], False), (BATCH_CUTS[0], False), (AS_OF, True)):
        swap_table(ev.where(F.col("ts") < _ntz(day)).select("event_id", "user_id"), name, stop_before_swap=stop)
    return spark.table(name)


def q_table_stream(spark, sf_dir):
    """A table as a stream into a table: two runs, the second of which sees the rows appended since."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id", "value", "ts")
    name = fresh_dir(spark, "stream").rsplit("/", 1)[1].replace("-", "_")
    for rows in (ev.where(F.col("ts") < _ntz(BATCH_CUTS[0])), ev.where(F.col("ts") >= _ntz(BATCH_CUTS[0]))):
        append_table(rows, f"{name}_bronze")
        append_available_now(facts.snapshot(table_stream(spark, f"{name}_bronze"), observed="ts"),
                             work_dir(spark, "runs", f"{name}-checkpoint"), table=f"{name}_silver")
    return spark.table(f"{name}_silver")


def q_flatten_nested(spark, sf_dir):
    """A whole nested details record, flattened by the catalogue's own rules, landed as files of JSON arrays."""
    ev = read_table(spark, sf_dir, "events")
    cents = to_minor_units("value")
    label = lambda c: F.struct(F.col(c).alias("description"))
    record = F.struct(F.col("event_id").cast("int").alias("appid"), F.array("event_type").alias("developers"),
                      F.when(F.col("value") >= 50, F.struct(F.lit("EUR").alias("currency"), (cents + 1).alias("initial"), cents.alias("final"))).alias("price_overview"),
                      F.array(label("event_type"), F.struct(F.lit("Indie, too").alias("description"))).alias("genres"),
                      F.struct((F.col("value") < 20).alias("coming_soon"), F.date_format("ts", "yyyy").alias("date")).alias("release_date"))
    files = ev.groupBy(F.to_date("ts").alias("day"), F.pmod(F.xxhash64("event_id"), F.lit(8)).alias("part")).agg(F.collect_list(record).alias("all"))
    landing = fresh_dir(spark, "landing-arrays")
    files.select("day", "part", F.to_json("all").alias("value")).write.partitionBy("day", "part").text(landing)
    flat = flatten_details(read_landing(spark, landing, schemas.DETAILS, layout="array"))
    return flat.fillna(-1, ["initial_price", "final_price"]).select("appid", "currency", "initial_price", "final_price", "genres", "categories", "coming_soon", "release_date",
                       F.size("developers").alias("n_developers"))


def q_pending_bucketed(spark, sf_dir):
    """``pending_worklist`` with the details in a table bucketed by item, which neither join shuffles."""
    ev, new, old = _snapshots(spark, sf_dir, WORKLIST_SNAPSHOT_BEFORE)
    details = (ev.where((F.col("event_type") == "purchase") & (F.col("value") >= DETAILS_MIN_VALUE))
               .select("user_id", F.col("ts").alias("lm")))
    name = fresh_dir(spark, "details").rsplit("/", 1)[1].replace("-", "_")
    bucketed_table(details, name, "user_id", int(spark.conf.get("spark.sql.shuffle.partitions")))
    changes = worklist.changed(new, old, "user_id", cmp=["lm"], keep=["lm"])
    return worklist.pending(new, changes, spark.table(name), key="user_id", at="lm")


def q_daily_run(spark, sf_dir):
    """The daily run over landed driver rows: customers are the catalogue, purchases the fetched details (two landings, two
    runs); the price history it shows."""
    from ledgerflow.plans import runs

    place = fresh_dir(spark, "daily")
    site = runs.Site(landing=f"{place}/landing", state=f"{place}/state", db=place.rsplit("/", 1)[1].replace("-", "_"), layout="lines", buckets=8)
    c = read_table(spark, sf_dir, "customer")
    page = F.floor(F.col("c_custkey") / PAGE_SIZE)
    item = F.struct(F.col("c_custkey").cast("int").alias("appid"), F.col("c_name").alias("name"), to_minor_units("c_acctbal").alias("last_modified"))
    pages = (c.groupBy(page.alias("page")).agg(F.collect_list(item).alias("apps"), F.max("c_custkey").alias("last_appid"))
             .join(c.agg(F.max(page).alias("last"))).select("page", F.to_json(F.struct(F.struct(
                 "apps", "last_appid", (F.col("page") < F.col("last")).alias("have_more_results")).alias("response"))).alias("value")))
    pages.write.partitionBy("page").text(f"{site.landing}/pages/2024-01-31")
    bought = _purchases(spark, sf_dir).select(F.col("user_id").cast("int").alias("appid"), F.lit(False).alias("is_free"),
        F.struct(F.lit("EUR").alias("currency"), F.col("event_id").cast("bigint").alias("initial"), to_minor_units("value").alias("final")).alias("price_overview"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("extracted_at_game"), F.col("value"))
    for late in (False, True):      # the second landing holds versions between those of the first
        part = bought.where(F.col("value") >= DETAILS_MIN_VALUE) if late else bought.where(F.col("value") < DETAILS_MIN_VALUE)
        part.drop("value").write.mode("append").json(f"{site.landing}/details")
        runs.run_daily(spark, site, dt.datetime(2024, 1, 31, 18) if late else dt.datetime(2024, 1, 31, 17))
    shown = spark.table(site.t("price_history"))
    listed = spark.table(site.t("dim_items")).select("appid")
    return shown.select("appid", "extracted_date", "final_price", "is_current", F.col("initial_price").alias("initial_price")).join(
        listed.withColumn("listed", F.lit(True)), "appid", "left").fillna(False, ["listed"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "logical_day": q_logical_day,
    "snapshot_fact": q_snapshot_fact,
    "snapshot_hour": q_snapshot_hour,
    "batch_gate": q_batch_gate,
    "rating": q_rating,
    "star_except": q_star_except,
    "price_view": q_price_view,
    "catalog_clean": q_catalog_clean,
    "date_dim": q_date_dim,
    "iso_year_week": q_iso_year_week,
    "flatten_json": q_flatten_json,
    "concat_labels": q_concat_labels,
    "bridge_delimited": q_bridge_delimited,
    "bridge_array": q_bridge_array,
    "bridge_filter": q_bridge_filter,
    "scd2_build": q_scd2_build,
    "scd2_incremental": q_scd2_incremental,
    "scd2_batches": q_scd2_batches,
    "scd2_published": q_scd2_published,
    "latest_per_key": q_latest_per_key,
    "price_as_of": q_price_as_of,
    "price_as_of_join": q_price_as_of_join,
    "price_moves": q_price_moves,
    "neighbours_hot": q_neighbours_hot,
    "neighbours_null_keys": q_neighbours_null_keys,
    "neighbours_text_version": q_neighbours_text_version,
    "neighbours_tied": q_neighbours_tied,
    "scd2_null_version": q_scd2_null_version,
    "scd2_quarantine": q_scd2_quarantine,
    "scd2_mode_all": q_scd2_mode_all,
    "scd2_stage": q_scd2_stage,
    "score_shift": q_score_shift,
    "peak_activity": q_peak_activity,
    "activity_by_day": q_activity_by_day,
    "activity_by_week": q_activity_by_week,
    "activity_churn": q_activity_churn,
    "as_of_text_tie": q_as_of_text_tie,
    "anti_single": q_anti_single,
    "anti_composite": q_anti_composite,
    "changed_keys": q_changed_keys,
    "pending_worklist": q_pending_worklist,
    "outcome_counts": q_outcome_counts,
    "outcome_statuses": q_outcome_statuses,
    "normalize_activity": q_normalize_activity,
    "normalize_details": q_normalize_details,
    "normalize_reviews": q_normalize_reviews,
    "retry_by_feed": q_retry_by_feed,
    "retry_worklist": q_retry_worklist,
    "page_flatten": q_page_flatten,
    "rescued_rows": q_rescued_rows,
    "iso_timestamps": q_iso_timestamps,
    "rescued_types": q_rescued_types,
    "rescued_malformed": q_rescued_malformed,
    "stream_snapshot": q_stream_snapshot,
    "scd2_published_full": q_scd2_published_full,
    "scd2_one_key": q_scd2_one_key,
    "price_islands": q_price_islands,
    "activity_rollup": q_activity_rollup,
    "bridge_multi": q_bridge_multi,
    "page_chain": q_page_chain,
    "rescued_nested": q_rescued_nested,
    "table_swap": q_table_swap,
    "table_stream": q_table_stream,
    "flatten_nested": q_flatten_nested,
    "pending_bucketed": q_pending_bucketed,
    "daily_run": q_daily_run,
}
