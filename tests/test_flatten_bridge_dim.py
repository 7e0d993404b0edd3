import datetime as dt

from ledgerflow import schemas
from ledgerflow.operators import bridge, dim
from ledgerflow.operators.flatten import flatten_details

from support import rows


def _details(spark, recs):
    return spark.createDataFrame(recs, schemas.DETAILS)


def _rec(appid, price=None, genres=None, release=None, devs=None):
    return (appid, None, False, "d", "h", devs, None, price, None, genres, None, release, dt.datetime(2024, 1, 1))


def test_flatten_nulls_and_empties(spark):
    df = _details(spark, [
        _rec(1, price=("EUR", 1000, 800, 20), genres=[("Action",), ("RPG",)], release=(False, "1 Jan, 2020")),
        _rec(2, price=None, genres=None, release=None),       # null struct, null array
        _rec(3, genres=[]),                                   # empty array
        _rec(4, genres=[("Indie",), (None,), None]),          # null element, null struct element
    ])
    out = {r["appid"]: r for r in flatten_details(df).collect()}
    assert (out[1]["currency"], out[1]["initial_price"], out[1]["final_price"], out[1]["discount_percent"]) == \
        ("EUR", 1000, 800, 20)
    assert out[1]["genres"] == "Action, RPG" and out[1]["release_date"] == "1 Jan, 2020"
    assert out[1]["coming_soon"] is False
    assert out[2]["currency"] is None and out[2]["genres"] == "" and out[2]["release_date"] is None
    assert out[3]["genres"] == ""
    assert out[4]["genres"] == "Indie"
    cols = flatten_details(df).columns
    assert "price_overview" not in cols and "metacritic" not in cols and cols.index("release_date") == 9


def test_bridges_edge_labels(spark):
    df = spark.createDataFrame([
        (1, True, ["Northwind", "Northwind", "Hidden Lane, Inc."], "Action, Indie,  , Action"),
        (2, True, None, ""),
        (3, False, ["Old"], "Old"),
        (4, True, [None, "X"], "A,B"),
    ], "appid int, is_current boolean, devs array<string>, genres string")
    arr = bridge.from_array(df, "appid", "devs", "developer", current_col="is_current")
    assert rows(arr) == [(1, "Hidden Lane, Inc."), (1, "Northwind"), (4, "X")]   # comma kept, dup + null dropped
    dl = bridge.from_delimited(df, "appid", "genres", "genre_name", current_col="is_current")
    assert rows(dl) == [(1, "Action"), (1, "Indie"), (4, "A"), (4, "B")]     # blanks and empty text dropped
    parity = bridge.from_delimited(df, "appid", "genres", "genre_name", current_col="is_current", parity=True)
    assert (1, "") in rows(parity)                                          # original: filter before trim
    hits = bridge.items_with_label(df.select("appid"), dl, "appid", "genre_name", "Indie")
    assert rows(hits) == [(1,)]


def test_date_dim_edges(spark):
    d = dim.date_dim(spark, "2020-01-01", "2030-12-31")
    assert d.count() == 4018
    got = {r["full_date"]: r for r in d.where(
        "full_date in (date'2021-01-01', date'2024-12-30', date'2023-01-01', date'2030-12-31')").collect()}
    assert got[dt.date(2021, 1, 1)]["year_week"] == "2021-53"
    assert got[dt.date(2021, 1, 1)]["iso_year_week"] == "2020-53"
    assert got[dt.date(2024, 12, 30)]["year_week"] == "2024-01"
    assert got[dt.date(2024, 12, 30)]["iso_year_week"] == "2025-01"
    sun = got[dt.date(2023, 1, 1)]
    assert sun["day_name"] == "Sunday" and sun["is_weekend"] is True
    last = got[dt.date(2030, 12, 31)]
    assert last["date_key"] == 20301231 and last["year_month"] == "2030-12" and last["day_of_month"] == 31
    assert d.agg({"full_date": "max"}).first()[0] == dt.date(2030, 12, 31)


def test_clean_catalog(spark):
    df = spark.createDataFrame([(1, "A", 0, 5, "x"), (2, None, 0, 5, "x"), (3, "", 0, 5, "x"),
                                (4, " ", 1700000000, 5, "x")], schemas.CATALOG_SNAPSHOT.simpleString()
                               .replace("extracted_at:timestamp", "extracted_at:string"))
    out = dim.clean_catalog(df)
    assert out.columns == ["appid", "name", "last_modified"]
    got = rows(out)
    assert [g[0] for g in got] == [1, 4]
    assert got[1][2] == dt.datetime(2023, 11, 14, 22, 13, 20)
