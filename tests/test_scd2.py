import datetime as dt

from pyspark.sql import functions as F

from support import SF_CHECK, closed_form, rows
from ledgerflow.operators import scd2

SCHEMA = "k int, v timestamp_ntz, id int, price bigint"


def T(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def _dim(spark, data):
    return scd2.build(spark.createDataFrame(data, SCHEMA), "k", "v", tie="id")


def _check_intervals(dim):
    """One current row per key; each closed version ends where the next starts."""
    by_key = {}
    for r in dim.collect():
        by_key.setdefault(r["k"], []).append(r)
    for versions in by_key.values():
        versions.sort(key=lambda r: (r["start_date"], r["id"]))
        assert sum(r["is_current"] for r in versions) == 1
        assert versions[-1]["is_current"] and versions[-1]["end_date"] is None
        for a, b in zip(versions, versions[1:]):
            assert not a["is_current"] and a["end_date"] == b["start_date"]


def test_build_one_and_three_versions(spark):
    dim = _dim(spark, [(1, T(1), 1, 100), (2, T(1), 2, 10), (2, T(2), 3, 11), (2, T(3), 4, 12)])
    assert rows(dim, "k", "v", "is_current", "end_date") == [
        (1, T(1), True, None), (2, T(1), False, T(2)), (2, T(2), False, T(3)), (2, T(3), True, None)]
    _check_intervals(dim)


def test_build_tie_on_version_time_is_total(spark):
    dim = _dim(spark, [(1, T(5), 1, 100), (1, T(5), 2, 101)])
    got = rows(dim, "id", "is_current", "end_date")
    assert got == [(1, False, T(5)), (2, True, None)]   # never two current rows, never a current row with an end


def test_build_quarantines_null_keys(spark):
    data = [(None, T(1), 1, 1), (1, T(1), 2, 2)]
    dim = _dim(spark, data)
    assert dim.count() == 1
    assert scd2.quarantine(spark.createDataFrame(data, SCHEMA), "k", SCHEMA.split(",")[1].split()[0]).count() == 1


def test_apply_cases(spark):
    dim = _dim(spark, [(1, T(1), 1, 100), (2, T(1), 2, 200), (3, T(5), 3, 300)])
    batch = spark.createDataFrame([
        (4, T(2), 10, 400),                    # new key
        (1, T(3), 11, 110),                    # newer version
        (2, T(1), 2, 200),                     # same version: no change
        (3, T(4), 12, 290),                    # older version: ignored
        (1, T(2), 13, 105),                    # two versions of key 1 in one batch: latest wins
        (None, T(9), 14, 1),                   # null key: never enters
    ], SCHEMA)
    out = scd2.apply(dim, batch, "k", "v", tie="id")
    assert rows(out, "k", "v", "price", "is_current", "start_date", "end_date") == [
        (1, T(1), 100, False, T(1), T(3)), (1, T(3), 110, True, T(3), None),
        (2, T(1), 200, True, T(1), None), (3, T(5), 300, True, T(5), None), (4, T(2), 400, True, T(2), None)]
    _check_intervals(out)
    # replaying the same batch changes nothing
    again = scd2.apply(out, batch, "k", "v", tie="id")
    assert rows(again) == rows(out)


def test_apply_mode_all_keeps_every_newer_version(spark):
    dim = _dim(spark, [(1, T(1), 1, 100)])
    batch = spark.createDataFrame([(1, T(2), 2, 105), (1, T(3), 3, 110), (1, T(1), 1, 100)], SCHEMA)
    out = scd2.apply(dim, batch, "k", "v", tie="id", mode="all")
    assert rows(out, "v", "is_current", "end_date") == [(T(1), False, T(2)), (T(2), False, T(3)), (T(3), True, None)]
    _check_intervals(out)


def test_stage_change_set(spark):
    dim = _dim(spark, [(1, T(1), 1, 100), (2, T(1), 2, 200)])
    batch = spark.createDataFrame([(1, T(2), 3, 110), (2, T(1), 2, 200), (5, T(1), 4, 500)], SCHEMA)
    st = scd2.stage(batch, dim, "k", "v", tie="id")
    assert rows(st, "k", "merge_key") == sorted([(1, None), (1, 1), (5, 5)], key=repr)


def test_batches_one_by_one_equal_closed_form(spark):
    ev = spark.read.parquet(f"{SF_CHECK}/events.parquet").where("event_type = 'purchase'")
    base = ev.select(F.col("user_id").cast("int").alias("k"), F.col("ts").alias("v"),
                     F.col("event_id").cast("int").alias("id"), F.col("value").alias("price"))
    cuts = [F.lit(c).cast("timestamp_ntz") for c in ("2024-01-08", "2024-01-16", "2024-01-24")]
    bt = (F.when(F.col("v") < cuts[0], 0).when(F.col("v") < cuts[1], 1).when(F.col("v") < cuts[2], 2).otherwise(3))
    tagged = base.withColumn("bt", bt)
    dim = scd2.build(scd2.latest_per_key(tagged.where("bt = 0").drop("bt"), "k", ["v", "id"]), "k", "v", tie="id")
    for b in (1, 2, 3):
        dim = scd2.apply(dim, tagged.where(f"bt = {b}").drop("bt"), "k", "v", tie="id")
    closed = closed_form(tagged, "k", "v", "bt", "id")
    assert rows(dim) == rows(closed)
    _check_intervals(dim)


def test_as_of(spark):
    dim = _dim(spark, [(1, T(1), 1, 100), (1, T(5), 2, 90)])
    assert rows(scd2.as_of(dim, T(3)), "price") == [(100,)]
    assert rows(scd2.as_of(dim, T(5)), "price") == [(90,)]


def test_as_of_join_matches_range_join(spark):
    ev = spark.read.parquet(f"{SF_CHECK}/events.parquet")
    hist = scd2.build(ev.where("event_type = 'purchase'").select("user_id", "event_id", "ts", "value"),
                      "user_id", "ts", tie="event_id")
    views = ev.where("event_type = 'view'").select("event_id", "user_id", "ts")
    brute = (views.alias("v").join(hist.alias("h"), (F.col("v.user_id") == F.col("h.user_id"))
                                   & (F.col("h.start_date") <= F.col("v.ts"))
                                   & (F.col("h.end_date").isNull() | (F.col("v.ts") < F.col("h.end_date"))), "left")
             .select("v.event_id", "v.user_id", "v.ts", "h.value"))
    for rps in (None, 40):      # plain window, and hot keys forced to split
        got = scd2.as_of_join(views, hist, "user_id", "ts", ["value"], tie="event_id", rows_per_slice=rps)
        assert rows(got) == rows(brute)


def test_as_of_join_edges(spark):
    dim = _dim(spark, [(1, T(1), 1, 100), (1, T(5), 2, 90), (1, T(5), 3, 80)])   # tie at T(5): id 3 wins
    look = spark.createDataFrame([(1, T(1)), (1, T(4)), (1, T(5)), (1, T(9)), (2, T(3)),
                                  (1, dt.datetime(2023, 12, 31))], "k int, at timestamp_ntz")
    got = rows(scd2.as_of_join(look, dim, "k", "at", ["price"], tie="id"))
    assert got == sorted([(1, T(1), 100), (1, T(4), 100), (1, T(5), 80), (1, T(9), 80), (2, T(3), None),
                          (1, dt.datetime(2023, 12, 31), None)], key=repr)
