"""Whole histories in buckets, runs of equal prices, running sums."""
import datetime as dt
import uuid
from itertools import groupby

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerflow.operators import analytics, scd2
from ledgerflow.operators.sequence import running_sum
from ledgerflow.plans.publish import BucketedDimension

from support import rows

SCHEMA = "k int, v timestamp_ntz, id int, price int"
BASE = dt.datetime(2024, 1, 1)
histories = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 20), st.integers(0, 3), st.integers(0, 3)), min_size=1, max_size=30)


def _frame(spark, recs):
    return spark.createDataFrame([(k, BASE + dt.timedelta(hours=h), i, p) for i, (k, h, p, _) in enumerate(recs)], SCHEMA)


def _dimension(spark, tmp_dir, df, buckets=3):
    schema = scd2.build(df.limit(0), "k", "v", tie="id", skew_safe=False).schema
    name = f"dim_{uuid.uuid4().hex[:12]}"
    return BucketedDimension(name, f"{tmp_dir}/{name}", schema, "k", "v", tie="id", buckets=buckets)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(histories)
def test_any_cut_into_batches_gives_the_whole_history(spark, tmp_dir, recs):
    df = _frame(spark, recs)
    dim = _dimension(spark, tmp_dir, df)
    batch = {i: b for i, (_, _, _, b) in enumerate(recs)}
    of = F.create_map(*[F.lit(x) for p in batch.items() for x in p])[F.col("id")]
    for b in (2, 0, 3, 1, 2):                                     # late batches, and one twice
        dim.apply_batch(spark, df.where(of == b))
    assert rows(dim.read(spark)) == rows(scd2.build(df, "k", "v", tie="id").select(*dim.schema.names))


def test_a_batch_writes_its_own_buckets_only(spark, tmp_dir):
    df = spark.createDataFrame([(k, BASE + dt.timedelta(hours=h), k * 100 + h, h) for k in range(40) for h in range(3)], SCHEMA)
    dim = _dimension(spark, tmp_dir, df, buckets=8)
    assert dim.apply_batch(spark, df) == 8
    files = lambda: {r.f for r in spark.sql(f"SELECT DISTINCT input_file_name() AS f FROM {dim.name}").collect()}
    before = files()
    late = spark.createDataFrame([(7, BASE + dt.timedelta(minutes=30), 9000, 5), (None, BASE, 1, 1), (7, None, 2, 2)], SCHEMA)
    assert dim.apply_batch(spark, late) == 1
    spark.catalog.refreshTable(dim.name)
    gone = {f.split("bucket=")[1].split("/")[0] for f in before - files()}
    assert len(gone) == 1
    seven = rows(dim.read(spark).where("k = 7"), "v", "is_current", "end_date")
    assert seven == [(BASE, False, BASE + dt.timedelta(minutes=30)), (BASE + dt.timedelta(minutes=30), False, BASE + dt.timedelta(hours=1)),
                     (BASE + dt.timedelta(hours=1), False, BASE + dt.timedelta(hours=2)), (BASE + dt.timedelta(hours=2), True, None)]
    assert dim.apply_batch(spark, late.limit(0)) == 0


def _islands_by_hand(recs):
    out = []
    for k, own in groupby(sorted(recs), key=lambda r: r[0]):
        runs = [list(g) for _, g in groupby(own, key=lambda r: r[3])]
        for n, run in enumerate(runs, 1):
            until = runs[n][0][1] if n < len(runs) else None
            out.append((k, n, run[0][3], run[0][1], run[-1][1], until, len(run)))
    return sorted(out, key=repr)


def test_price_islands_of_split_keys(spark):
    recs = [(k, BASE + dt.timedelta(hours=(h * 7) % 50), h, (h // 4) % 3 if h % 9 else None) for k in (0, 0, 0, 1, 2) for h in range(60)]
    recs = [(k, v, i, p) for i, (k, v, _, p) in enumerate(recs)]
    df = spark.createDataFrame(recs + [(None, BASE, 9999, 1), (1, None, 9998, 1)], SCHEMA)
    for sliced in (None, 5):
        got = analytics.price_islands(df, "k", "v", "price", tie="id", rows_per_slice=sliced)
        assert rows(got.select("k", "island", "price", "first_ts", "last_ts", "until", "versions")) == _islands_by_hand(recs)


def test_running_sum_null_keys_and_values(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 2, None), (1, 3, 2), (None, 1, 4), (None, 2, None)], "k int, o int, x int")
    for sliced in (None, 1):
        assert rows(running_sum(df, "k", ["o"], "x", rows_per_slice=sliced), "k", "o", "running") == [
            (1, 1, 5), (1, 2, 5), (1, 3, 7), (None, 1, 4), (None, 2, 0)]


def test_price_islands_of_an_empty_table(spark):
    assert analytics.price_islands(spark.createDataFrame([], SCHEMA), "k", "v", "price", tie="id").count() == 0
