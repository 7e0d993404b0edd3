import datetime as dt
import json
import os

import pytest

from ledgerflow.plans import runs
from ledgerflow.plans.runs import Site, details_dimension, run_activity, run_daily

from support import rows


def _put(path, name, obj, indent=None):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        json.dump(obj, f, indent=indent)


def _page(apps, more, last):
    return {"response": {"apps": apps, "have_more_results": more, "last_appid": last}}


def _detail(appid, asked, day, final, genres, devs):
    return {"appid": appid, "is_free": False, "short_description": f"game {appid}", "header_image": "h.png",
            "developers": devs, "publishers": ["P"],
            "price_overview": {"currency": "EUR", "initial": 2000, "final": final, "discount_percent": 0},
            "metacritic": {"score": 80}, "genres": [{"description": g} for g in genres],
            "categories": [{"description": "Single-player"}], "release_date": {"coming_soon": False, "date": "2020"},
            "extracted_at": f"{asked}+00:00", "extracted_at_game": f"2024-01-0{day}T18:00:00+00:00"}


def _site(spark, tmp_dir, db):
    for t in spark.catalog.listTables(db) if spark.catalog.databaseExists(db) else []:
        spark.sql(f"DROP {'VIEW' if t.tableType == 'VIEW' else 'TABLE'} {db}.{t.name}")
    return Site(landing=f"{tmp_dir}/landing", state=f"{tmp_dir}/state", db=db)


def _first_day(site):
    L = site.landing
    _put(f"{L}/pages/2024-01-01", "p1.json", _page([{"appid": 1, "name": "A", "last_modified": 100},
                                                   {"appid": 2, "name": "", "last_modified": 100}], True, 2))
    _put(f"{L}/pages/2024-01-01", "p2.json", _page([{"appid": 3, "name": "C", "last_modified": 100}], False, 3))


def _second_day(site):
    _put(f"{site.landing}/pages/2024-01-02", "p1.json", _page([{"appid": 1, "name": "A", "last_modified": 200},
                                                              {"appid": 3, "name": "C", "last_modified": 100},
                                                              {"appid": 4, "name": "D", "last_modified": 100}], False, 4))


def test_daily_and_activity_runs_over_three_days(spark, tmp_dir):
    site = _site(spark, tmp_dir, "lf_e2e")
    L = site.landing

    # day 1 (logical 2024-01-01): two pages; nothing has been fetched yet, no landing folder is there
    _first_day(site)
    assert run_daily(spark, site, dt.datetime(2024, 1, 1, 17, 0))["ran"]
    run_activity(spark, site)
    assert rows(spark.table("lf_e2e.dim_items")) == [(1, "A"), (3, "C")]               # blank name dropped
    assert rows(spark.table("lf_e2e.reviews_worklist"), "appid") == [(1,), (3,)]
    assert rows(spark.table("lf_e2e.worklist"), "appid", "why") == [(1, "new"), (2, "new"), (3, "new")]
    assert spark.table("lf_e2e.price_history").count() == 0

    # what was fetched lands; a second run of the same logical day is not due, but takes it in
    asked = "2024-01-01T17:00:00"
    _put(f"{L}/details", "d1.json", [_detail(1, asked, 1, 1500, ["Action", "RPG"], ["Northwind"]),
                                     _detail(3, asked, 1, 999, ["Indie"], ["Solo"])], indent=3)
    with open(f"{L}/details/d1-cut.json", "w") as f:
        f.write('[{"appid": 9, "is_fr')
    _put(f"{L}/reviews", "r1.json", [{"appid": 1, "review_score": 8, "review_score_desc": "Very Positive",
                                      "total_positive": 57, "total_negative": 43, "total_reviews": 100,
                                      "extracted_at": "2024-01-01T17:00:00+00:00"},
                                     {"appid": 3, "total_positive": 0, "total_reviews": 0,
                                      "extracted_at": "2024-01-01T17:00:00+00:00"}])
    _put(f"{L}/activity", "a1.json", [{"appid": 1, "player_count": 3000000000,
                                       "extracted_at": "2024-01-01T17:45:10+00:00"}], indent=3)
    again = run_daily(spark, site, dt.datetime(2024, 1, 2, 15, 59))
    assert again["ran"] is False and again["reviews_ran"] is False
    run_activity(spark, site)
    assert rows(spark.table("lf_e2e.worklist"), "appid", "why") == [(2, "new")]
    assert rows(spark.table("lf_e2e.price_history"), "appid", "final_price") == [(1, 15.0), (3, 9.99)]
    assert rows(spark.table("lf_e2e.review_scores"), "appid", "review_score") == [(1, 57.0)]
    assert rows(spark.table("lf_e2e.activity_hours"), "appid", "player_count", "snapshot_hour") == [
        (1, 3000000000, dt.datetime(2024, 1, 1, 17))]
    assert dict(spark.table("lf_e2e.activity_hours").dtypes)["snapshot_hour"] == "timestamp"
    assert spark.table("lf_e2e.dim_date").count() == 4018
    cut = spark.table("lf_e2e.details_quarantine").collect()
    assert len(cut) == 1 and json.loads(cut[0]["_rescued_data"])["_malformed"] == '[{"appid": 9, "is_fr'
    assert json.loads(cut[0]["_rescued_data"])["_file"].endswith("d1-cut.json")

    # day 2: item 1 changed, item 4 is new, item 2 left the catalogue
    _second_day(site)
    assert run_daily(spark, site, dt.datetime(2024, 1, 2, 16, 5))["ran"]
    assert rows(spark.table("lf_e2e.change_log"), "appid") == [(1,)]
    assert rows(spark.table("lf_e2e.worklist"), "appid", "why") == [(1, "changed"), (4, "new")]
    asked = "2024-01-02T16:05:00"
    _put(f"{L}/details", "d2.json", [_detail(1, asked, 2, 1200, ["Action"], ["Northwind", "Hidden Lane"]),
                                     _detail(4, asked, 2, 500, [], [])])

    # day 3: nothing changed and all that was asked for has landed
    _put(f"{L}/pages/2024-01-03", "p1.json", _page([{"appid": 1, "name": "A", "last_modified": 200},
                                                   {"appid": 3, "name": "C", "last_modified": 100},
                                                   {"appid": 4, "name": "D", "last_modified": 100}], False, 4))
    assert run_daily(spark, site, dt.datetime(2024, 1, 3, 16, 5))["ran"]
    assert spark.table("lf_e2e.worklist").count() == 0

    hist = details_dimension(spark, site).read(spark)
    got = rows(hist, "appid", "final_price", "is_current", "end_date")
    assert got == [(1, 1200, True, None), (1, 1500, False, dt.datetime(2024, 1, 2, 18)), (3, 999, True, None),
                   (4, 500, True, None)]
    assert rows(spark.table("lf_e2e.item_developer")) == [(1, "Hidden Lane"), (1, "Northwind"), (3, "Solo")]
    assert rows(spark.table("lf_e2e.item_genre")) == [(1, "Action"), (3, "Indie")]

    # a rerun of the activity run ingests nothing new
    run_activity(spark, site)
    assert spark.table("lf_e2e.activity_silver").count() == 1


@pytest.mark.parametrize("step", ["ingest", "history", "clean", "_mark", "refresh_reviews", "pending_worklist", "gold"])
def test_a_run_that_stops_is_simply_run_again(spark, tmp_dir, monkeypatch, step):
    site = _site(spark, tmp_dir, f"lf_stop_{step.strip('_')}")
    _first_day(site)
    run_daily(spark, site, dt.datetime(2024, 1, 1, 17))
    _second_day(site)
    asked = "2024-01-01T17:00:00"
    _put(f"{site.landing}/details", "d1.json", [_detail(1, asked, 1, 1500, ["RPG"], []), _detail(3, asked, 1, 999, [], [])])

    def stop(*_, **__):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(*((runs.dim, "clean_catalog") if step == "clean" else (runs, step)), stop)
        with pytest.raises(RuntimeError, match="stopped"):
            run_daily(spark, site, dt.datetime(2024, 1, 2, 17))
    run_daily(spark, site, dt.datetime(2024, 1, 2, 19))
    assert rows(spark.table(site.t("change_log")), "appid") == [(1,)]
    assert rows(spark.table(site.t("worklist")), "appid", "why") == [(1, "changed"), (4, "new")]
    assert rows(spark.table(site.t("price_history")), "appid", "final_price") == [(1, 15.0), (3, 9.99)]
    assert rows(spark.table(site.t("dim_items")), "appid") == [(1,), (3,), (4,)]
    assert rows(spark.table(site.t("reviews_worklist")), "appid") == [(1,), (3,), (4,)]
