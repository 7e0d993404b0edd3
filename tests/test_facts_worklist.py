import datetime as dt

from ledgerflow.operators import facts, worklist

from support import rows


def test_rating_filters_and_rounds(spark):
    df = spark.createDataFrame([(1, "ok", 57, 100, dt.datetime(2024, 1, 2, 3)), (2, "none", 0, 0, None),
                                (3, "null", 1, None, None), (4, "all", 3, 3, dt.datetime(2024, 1, 3))],
                               "appid int, review_score_desc string, total_positive bigint, total_reviews bigint, "
                               "extracted_at timestamp")
    out = {r["appid"]: r for r in facts.rating(df).collect()}
    assert set(out) == {1, 4}
    assert out[1]["review_score"] == 57.0 and out[4]["review_score"] == 100.0
    assert out[1]["extracted_at_Date"] == dt.date(2024, 1, 2)
    parity = {r["appid"]: r["review_score"] for r in facts.rating(df, parity=True).collect()}
    assert parity[1] == 56.99999999999999     # the original's double noise, reproduced on demand


def test_snapshot_fact(spark):
    df = spark.createDataFrame([(1, 5, dt.datetime(2024, 1, 2, 3, 45, 12))],
                               "appid int, player_count bigint, extracted_at timestamp")
    r = facts.snapshot(df).first()
    assert r["snapshot_hour"] == dt.datetime(2024, 1, 2, 3) and r["snapshot_date"] == dt.date(2024, 1, 2)
    assert "extracted_at" not in facts.snapshot(df).columns


def test_price_view_minor_units(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 2, 20), 1999, 999, True)],
                               "appid int, extracted_at_game timestamp, initial_price bigint, final_price bigint, "
                               "is_current boolean")
    r = facts.price_view(df).first()
    assert r["initial_price"] == 19.99 and r["final_price"] == 9.99 and r["extracted_date"] == dt.date(2024, 1, 2)


def test_changed_null_semantics(spark):
    schema = "appid int, last_modified bigint, extracted_at string"
    new = spark.createDataFrame([(1, 5, "n"), (2, 6, "n"), (3, None, "n"), (4, 1, "n"), (6, 1, "n")], schema)
    old = spark.createDataFrame([(1, 5, "o"), (2, 5, "o"), (3, 7, "o"), (5, 1, "o"), (6, None, "o")], schema)
    assert rows(worklist.changed(new, old, "appid")) == [(2, "n")]
    assert rows(worklist.changed(new, old, "appid", null_safe=True)) == [(2, "n"), (3, "n"), (6, "n")]


def test_pending_worklist(spark):
    t = lambda d: dt.datetime(2024, 1, d)
    catalog = spark.createDataFrame([(1, t(9)), (2, t(9)), (3, t(9)), (4, t(9))], "appid int, extracted_at timestamp")
    changes = spark.createDataFrame([(1, t(5)), (1, t(8)), (2, t(6)), (3, t(7))],
                                    "appid int, extracted_at timestamp")
    details = spark.createDataFrame([(2, t(6)), (3, t(1)), (1, t(2))], "appid int, extracted_at timestamp")
    out = rows(worklist.pending(catalog, changes, details))
    # 1: two pending changes -> newest wins; 2: fetched at that time -> done; 3: changed; 4: new key
    assert out == [(1, t(8), "changed"), (3, t(7), "changed"), (4, t(9), "new")]
