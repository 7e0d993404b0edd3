"""Page chains, tables replaced at once, bucketed joins, label filters, nested rescue, roll-ups."""
import datetime as dt
import json
import os
import uuid

import pytest

from ledgerflow.operators import bridge, responses, worklist
from ledgerflow.plans.runs import Site, run_daily
from ledgerflow.sources.landing import with_rescued
from ledgerflow.sources.tables import bucketed_table, create_once, swap_table
from ledgerflow.streaming.ingest import file_stream
from ledgerflow.streaming.rollup import ActivityRollup

from support import rows


def _page(first, last, more, start=None, chain="c"):
    apps = [{"appid": i, "name": str(i), "last_modified": 1} for i in range(first, last + 1)]
    return (json.dumps({"response": {"apps": apps, "have_more_results": more, "last_appid": last}}), start, chain)


PAGES = "payload string, start long, chain string"


@pytest.mark.parametrize("pages, want", [
    ([(1, 5, True, 0), (6, 9, False, 5)], ["ok", "ok"]),
    ([(1, 5, True, 0), (6, 9, True, 5)], ["ok", "unended"]),
    ([(1, 5, True, 0), (9, 12, False, 8)], ["ok", "gap"]),
    ([(1, 5, True, 0), (4, 9, False, 3)], ["ok", "overlap"]),
    ([(1, 5, False, 0), (6, 9, False, 5)], ["ok", "after_end"]),
    ([(1, 5, True, None), (9, 12, False, None)], ["ok", "ok"]),          # no cursor known: a gap cannot be seen
])
def test_page_chain(spark, pages, want):
    found = responses.page_chain(spark.createDataFrame([_page(*p) for p in pages], PAGES), start="start", chain="chain")
    assert [r.status for r in found.orderBy("last_appid").collect()] == want
    complete = responses.chain_complete(found).first()
    assert complete.complete == (set(want) == {"ok"}) and complete.pages == 2


def test_page_chains_apart_and_malformed(spark):
    pages = [_page(1, 5, False, None, "a"), _page(1, 5, True, None, "b"), ('{"response"', None, "a"), (None, None, None)]
    found = responses.page_chain(spark.createDataFrame(pages, PAGES), chain="chain")
    assert rows(found, "chain", "status") == [("", "malformed"), ("a", "malformed"), ("a", "ok"), ("b", "unended")]
    assert responses.chain_complete(responses.page_chain(spark.createDataFrame([], PAGES))).count() == 0


def test_a_half_landed_catalogue_does_not_count(spark, tmp_dir):
    site = Site(landing=f"{tmp_dir}/landing", state=f"{tmp_dir}/state", db=f"lf_half_{uuid.uuid4().hex[:8]}")
    os.makedirs(f"{site.landing}/pages/2024-01-01")
    with open(f"{site.landing}/pages/2024-01-01/p1.json", "w") as f:
        f.write(_page(1, 2, True)[0])
    now = dt.datetime(2024, 1, 1, 17)
    first = run_daily(spark, site, now)
    assert first["ran"] is False and first["incomplete"] and not spark.catalog.tableExists(site.t("dim_items"))
    with open(f"{site.landing}/pages/2024-01-01/p2.json", "w") as f:
        f.write(_page(3, 4, False)[0])
    assert run_daily(spark, site, now)["ran"]
    assert rows(spark.table(site.t("dim_items")), "appid") == [(1,), (2,), (3,), (4,)]


def test_swap_table(spark):
    name = f"swap_{uuid.uuid4().hex[:8]}"
    rows_of = lambda n: spark.range(n).toDF("x")
    swap_table(rows_of(1), name)
    open_query = spark.table(name)
    swap_table(rows_of(2), name)
    assert spark.table(name).count() == 2
    stopped = swap_table(rows_of(3), name, stop_before_swap=True)
    assert spark.table(name).count() == 2                          # readers see the old rows, whole
    assert swap_table(spark.table(name).unionAll(rows_of(2)), name) == stopped      # reads what it replaces
    assert spark.table(name).count() == 4
    left = {t.name for t in spark.catalog.listTables() if t.name.startswith(f"{name}__v")}
    assert left == {f"{name}__v2", f"{name}__v3"} and open_query.columns == ["x"]


def test_create_once(spark):
    name = f"once_{uuid.uuid4().hex[:8]}"
    create_once(spark.range(2), name)
    create_once(spark.range(5), name)
    assert spark.table(name).count() == 2


def test_bucketed_details_are_not_shuffled(spark):
    name = f"details_{uuid.uuid4().hex[:8]}"
    data = [(i, dt.datetime(2024, 1, 1 + i % 3)) for i in range(50)]
    details = spark.createDataFrame(data, "appid int, extracted_at timestamp_ntz")
    bucketed_table(details, name, "appid", 8)
    catalog = spark.createDataFrame([(i, dt.datetime(2024, 1, 2)) for i in range(60)], "appid int, extracted_at timestamp_ntz")
    changes = spark.createDataFrame([(1, dt.datetime(2024, 1, 2)), (2, dt.datetime(2024, 1, 2))], "appid int, extracted_at timestamp_ntz")
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pending = worklist.pending(catalog, changes, spark.table(name))
        plan = pending._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "FileScan" in line and name in line:
            depth = line.index("FileScan")
            above = []
            for up in reversed(lines[:i]):
                indent = len(up) - len(up.lstrip(" :+-"))
                if indent < depth:
                    above.append(up)
                    depth = indent
                if "Join" in up and indent <= depth:
                    break
            assert not any("Exchange" in a for a in above), above
    assert name in plan and rows(pending, "appid", "why") == rows(worklist.pending(catalog, changes, details), "appid", "why")


def test_items_with_labels(spark):
    items = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "n"), (4, "d")], "k int, label string")
    labels = spark.createDataFrame([(1, "x"), (1, "y"), (1, "y"), (2, "x"), (3, "y"), (3, "z"), (None, "x")], "k int, tag string")
    got = lambda **f: rows(bridge.items_with_labels(items, labels, "k", "tag", **f), "label")
    assert got() == [("a",), ("b",), ("c",), ("d",), ("n",)]
    assert got(all_of=["x", "y"]) == [("a",)]
    assert got(any_of=["y", "q"]) == [("a",), ("c",)]
    assert got(none_of=["z"]) == [("a",), ("b",), ("d",), ("n",)]
    assert got(all_of=["y"], any_of=["x", "z"], none_of=["z"]) == [("a",)]


def test_rescue_at_any_depth(spark, tmp_dir):
    schema = spark.createDataFrame([], "a int, list array<struct<k: int, in: struct<n: int>, more: array<struct<m: int>>>>, box struct<deep: struct<d: int>>").schema
    lines = [{"a": 1, "list": [{"k": 1}, {"k": 2, "u": 3, "in": {"n": 1, "x": "y"}, "more": [{"m": 1}, {"m": 2, "w": [1]}]}],
              "box": {"deep": {"d": 1, "e": 2}, "f": 3}},
             {"a": 2, "list": [{"k": 1}], "box": {"deep": {"d": 1}}}, {"a": 3, "list": None, "box": None}, {"a": 4}]
    with open(f"{tmp_dir}/rows.json", "w") as f:
        f.write("\n".join(map(json.dumps, lines)))
    got = {r.a: json.loads(r._rescued_data) if r._rescued_data else None for r in with_rescued(spark, f"{tmp_dir}/rows.json", schema, layout="lines").collect()}
    assert got == {1: {"list[1].u": "3", "list[1].in.x": "y", "list[1].more[1].w": "[1]", "box.deep.e": "2", "box.f": "3"}, 2: None, 3: None, 4: None}


def test_rollup_counts_a_repeated_batch_once(spark, tmp_dir):
    data = [(i % 3, dt.datetime(2024, 1, 1 + i % 9, i % 24, 30), i) for i in range(200)] + [(1, dt.datetime(2024, 1, 2), None)]
    ev = spark.createDataFrame(data, "k int, ts timestamp_ntz, v long")
    roll = ActivityRollup(f"{tmp_dir}/state", "k", "ts", "v")
    for step in (ev.where("v < 120"), ev.where("v >= 120 or v is null")):
        step.write.mode("append").parquet(f"{tmp_dir}/landed")
        roll.apply_stream(file_stream(spark, f"{tmp_dir}/landed", ev.schema), f"{tmp_dir}/checkpoint")
    roll.apply_batch(ev.where("v < 120"), 0)                        # delivered again
    for grain, bucket in (("hour", "date_trunc('hour', ts)"), ("day", "date(ts)"), ("week", "date(date_trunc('week', ts))")):
        want = ev.selectExpr("k", f"{bucket} as {grain}", "v").groupBy("k", grain).agg({"v": "max"})
        got = roll.read(spark, grain)
        assert got.count() == want.count() and got.agg({"n": "sum", "total": "sum"}).first().asDict() == {"sum(n)": 201, "sum(total)": sum(range(200))}
        assert {r.peak for r in got.collect()} == {r["max(v)"] for r in want.collect()}
