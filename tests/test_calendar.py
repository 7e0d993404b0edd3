import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerflow.functions.calendar import batch_due, logical_day, logical_day_between, logical_day_py

# The seven logical-day cases (cut-over 16:00 UTC).
CASES = [
    (dt.datetime(2026, 4, 28, 15, 59, 59), dt.date(2026, 4, 27)),
    (dt.datetime(2026, 4, 28, 16, 0, 0), dt.date(2026, 4, 28)),
    (dt.datetime(2026, 4, 28, 16, 0, 1), dt.date(2026, 4, 28)),
    (dt.datetime(2026, 4, 28, 0, 0, 0), dt.date(2026, 4, 27)),
    (dt.datetime(2026, 4, 28, 23, 59, 0), dt.date(2026, 4, 28)),
    (dt.datetime(2026, 5, 1, 3, 0, 0), dt.date(2026, 4, 30)),
    (dt.datetime(2026, 1, 1, 3, 0, 0), dt.date(2025, 12, 31)),
]


@pytest.mark.parametrize("ts,expected", CASES)
def test_logical_day_python_rule(ts, expected):
    assert logical_day_py(ts) == expected


def test_logical_day_native_expression_ntz_and_ltz(spark):
    df = spark.createDataFrame([(c[0].isoformat(sep=" "), c[1]) for c in CASES], "s string, expected date")
    out = df.select(logical_day(F.col("s").cast("timestamp_ntz")).alias("ntz"),
                    logical_day(F.to_timestamp("s")).alias("ltz"), "expected").collect()
    for r in out:
        assert r["ntz"] == r["expected"] == r["ltz"]


def test_logical_day_between_is_pushed_to_scan(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    q = ev.where(logical_day_between("ts", "2024-01-05", "2024-01-06"))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-05T16:00)" in plan and "LessThan(ts,2024-01-07T16:00)" in plan
    expected = ev.where(logical_day("ts").between(dt.date(2024, 1, 5), dt.date(2024, 1, 6))).count()
    assert q.count() == expected > 0


def test_batch_due_gate(spark):
    schema = "src string, ts timestamp_ntz"
    now = F.lit("2026-04-28 17:00:00").cast("timestamp_ntz")
    empty = spark.createDataFrame([], schema)
    assert batch_due(empty, "ts", now).first()["due"] is True            # empty table -> due
    same = spark.createDataFrame([("a", dt.datetime(2026, 4, 28, 16, 30))], schema)
    assert batch_due(same, "ts", now).first()["due"] is False             # same logical day -> not due
    prev = spark.createDataFrame([("a", dt.datetime(2026, 4, 28, 15, 30))], schema)
    assert batch_due(prev, "ts", now).first()["due"] is True              # previous logical day -> due
    both = same.unionByName(prev.withColumn("src", F.lit("b")))
    got = {r["src"]: r["due"] for r in batch_due(both, "ts", now, by=["src"]).collect()}
    assert got == {"a": False, "b": True}
