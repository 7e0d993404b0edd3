from pyspark.sql import functions as F

from support import SF_CHECK, rows
from ledgerflow.operators.sequence import latest_per_key, with_neighbours


def _hot_events(spark):
    ev = spark.read.parquet(f"{SF_CHECK}/events.parquet")
    # a third of all rows moved onto one key
    return ev.withColumn("user_id", F.when(F.col("ts") < F.lit("2024-01-11").cast("timestamp_ntz"), F.lit(7))
                         .otherwise(F.col("user_id")))


def test_neighbours_hot_key_split_equals_plain_window(spark):
    hot = _hot_events(spark)
    split = with_neighbours(hot, "user_id", ["ts", "event_id"], ["ts", "value"], rows_per_slice=250)
    plain = with_neighbours(hot, "user_id", ["ts", "event_id"], ["ts", "value"], skew_safe=False)
    assert split.count() == plain.count() == hot.count()
    assert split.exceptAll(plain).count() == 0 and plain.exceptAll(split).count() == 0


def test_neighbours_hot_key_spreads_over_many_window_partitions(spark):
    hot = _hot_events(spark)
    split = with_neighbours(hot, "user_id", ["ts", "event_id"], ["ts"], rows_per_slice=250)
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    assert "__slice" in plan  # the window is partitioned by (key, slice)


def test_neighbours_edges(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 3, "c"), (2, 5, "z")], "k int, t int, v string")
    out = with_neighbours(df, "k", ["t"], ["v"], rows_per_slice=1)
    assert rows(out, "k", "t", "prev_v", "next_v") == [(1, 1, None, "b"), (1, 2, "a", "c"), (1, 3, "b", None),
                                                       (2, 5, None, None)]


def test_latest_per_key_total_order(spark):
    df = spark.createDataFrame([(1, 10, 1, "x"), (1, 10, 2, "y"), (1, 9, 3, "z"), (2, 1, 1, "w")],
                               "k int, ts int, id int, v string")
    out = latest_per_key(df, "k", ["ts", "id"])
    assert out.columns == df.columns
    assert rows(out) == [(1, 10, 2, "y"), (2, 1, 1, "w")]
    assert rows(latest_per_key(df, "k", ["ts", "id"], desc=False)) == [(1, 9, 3, "z"), (2, 1, 1, "w")]
