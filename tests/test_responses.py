import datetime as dt

from pyspark.sql import functions as F

from ledgerflow import schemas
from ledgerflow.operators import responses

from support import rows

NOW = dt.datetime(2024, 1, 2, 12)


def _raw(spark, recs):
    return spark.createDataFrame([(f, k, a, s, p, NOW) for f, k, a, s, p in recs], schemas.RAW_RESPONSE)


def test_status_matrix(spark):
    bodies = {"activity": '{"response": {"player_count": 5}}', "details": '{"1": {"success": true, "data": {}}}',
              "reviews": '{"query_summary": {}}'}
    recs = []
    for feed in ("activity", "details", "reviews"):
        for st in (200, 403, 404, 420, 429, 500, None):
            recs.append((feed, 1, 1, st, bodies[feed]))
        recs.append((feed, 1, 1, 200, "not json"))
    got = {(r["feed"], r["status"], r["payload"] != "not json"): r["outcome"]
           for r in responses.classify(_raw(spark, recs)).collect()}
    for feed in ("activity", "details", "reviews"):
        assert got[(feed, 200, True)] == "ok"
        assert got[(feed, 420, True)] == got[(feed, 429, True)] == "retry"
        assert got[(feed, 404, True)] == got[(feed, 500, True)] == "drop"
    assert got[("activity", 403, True)] == "drop"
    assert got[("details", 403, True)] == got[("reviews", 403, True)] == "retry"
    assert got[("activity", None, True)] == "retry"
    assert got[("details", None, True)] == got[("reviews", None, True)] == "error"
    assert got[("activity", 200, False)] == "drop" and got[("details", 200, False)] == "error"
    counts = {(r["feed"], r["outcome"]): r["n"] for r in
              responses.outcome_counts(responses.classify(_raw(spark, recs))).collect()}
    assert counts[("activity", "retry")] == 3 and sum(counts.values()) == len(recs)


def test_bodies_that_lack_what_the_feed_needs(spark):
    cases = {
        ("activity", '{"response": {}}'): "ok", ("activity", '{"error": "x"}'): "drop", ("activity", '{"response": [1]}'): "drop",
        ("activity", '{"response": {"player_count": 5}'): "drop", ("activity", None): "drop",
        ("details", '{"1": {"success": true, "data": {"is_free": true}}, "2": 3}'): "ok", ("details", '{"1": {"success": false}}'): "absent",
        ("details", '{"1": {"success": true}}'): "error", ("details", '{"1": {}}'): "error", ("details", '{"2": {"success": true}}'): "error",
        ("details", '{"1": null}'): "error", ("details", "[]"): "error", ("details", None): "error",
        ("reviews", '{"query_summary": {}}'): "ok", ("reviews", '{"success": 1}'): "error", ("reviews", '{"query_summary": null}'): "error",
        ("reviews", '{"query_summary": 1}'): "error", ("reviews", ""): "error",
    }
    found = responses.classify(_raw(spark, [(f, 1, 1, 200, p) for f, p in cases])).collect()
    assert {(r["feed"], r["payload"]): r["outcome"] for r in found} == cases


def test_details_carry_the_time_that_was_asked_for(spark):
    raw = _raw(spark, [("details", 7, 1, 200, '{"7": {"success": true, "data": {}}}')])
    asked = dt.datetime(2024, 1, 1, 17)
    out = responses.normalize(raw.withColumn("requested_at", F.lit(asked)), "details").first()
    assert (out["extracted_at"], out["extracted_at_game"]) == (asked, NOW)
    assert responses.normalize(raw, "details").first()["extracted_at"] is None


def test_normalize_feeds(spark):
    details_ok = '{"7": {"success": true, "data": {"is_free": false, "price_overview": {"currency": "EUR", ' \
                 '"initial": 999, "final": 499, "discount_percent": 50}, "genres": [{"description": "RPG"}]}}}'
    recs = [
        ("activity", 1, 1, 200, '{"response": {"player_count": 3000000000}}'),
        ("activity", 2, 1, 200, '{"response": {}}'),                   # missing -> 0
        ("details", 7, 1, 200, details_ok),
        ("details", 8, 1, 200, '{"8": {"success": false}}'),           # success=false -> no row
        ("details", 9, 1, 200, '{"10": {"success": true, "data": {}}}'),   # missing item key -> no row
        ("reviews", 5, 1, 200, '{"query_summary": {"review_score": 8, "review_score_desc": "Very Positive", '
                               '"total_positive": 57, "total_negative": 43, "total_reviews": 100}}'),
        ("reviews", 6, 1, 429, "{}"),
    ]
    raw = _raw(spark, recs)
    assert rows(responses.normalize(raw, "activity"), "appid", "player_count") == [(1, 3000000000), (2, 0)]
    det = responses.normalize(raw, "details").collect()
    assert [r["appid"] for r in det] == [7]
    assert det[0]["price_overview"]["final"] == 499 and det[0]["genres"][0]["description"] == "RPG"
    assert det[0]["extracted_at_game"] == NOW
    rev = responses.normalize(raw, "reviews").collect()
    assert [(r["appid"], r["total_reviews"], r["review_score_desc"]) for r in rev] == [(5, 100, "Very Positive")]


def test_retry_worklist_rounds(spark):
    # key 1: retry x4 (initial + 3 rounds used up) -> not re-issued; key 2: retry x2 -> re-issued;
    # key 3: retry then ok -> done; key 4: drop -> not re-issued
    recs = [("details", 1, a, 429, "{}") for a in range(4)] + [("details", 2, a, 429, "{}") for a in range(2)] + \
           [("details", 3, 0, 429, "{}"), ("details", 3, 1, 200, '{"3": {"success": true, "data": {}}}'), ("details", 4, 0, 404, "{}")]
    att = responses.classify(_raw(spark, recs))
    assert rows(responses.retry_worklist(att, "key"), "key", "n") == [(2, 2)]
    # activity makes 5 attempts per round: 12 attempts = 3 rounds -> one more allowed
    act = responses.classify(_raw(spark, [("activity", 9, a, 429, "{}") for a in range(12)]))
    assert rows(responses.retry_worklist(act, "key"), "key") == [(9,)]


def test_flatten_pages(spark):
    p1 = '{"response": {"apps": [{"appid": 1, "name": "A", "last_modified": 10, "price_change_number": 1}], ' \
         '"have_more_results": true, "last_appid": 1}}'
    p2 = '{"response": {"apps": [{"appid": 2, "name": "B", "last_modified": 20}], "have_more_results": false}}'
    pages = spark.createDataFrame([(p1,), (p2,), ("broken",)], "payload string")
    out = responses.flatten_pages(pages, extracted_at=NOW)
    assert rows(out) == [(1, "A", 10, 1, NOW), (2, "B", 20, None, NOW)]
    stamps = responses.flatten_pages(pages).select(F.countDistinct("extracted_at")).first()[0]
    assert stamps == 1
