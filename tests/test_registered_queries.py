"""Every registered query against its DuckDB oracle (sf0.001 here; the driver repeats this at sf0.01)."""
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from check_oracles import frame_hash  # noqa: E402
from support import SF_SMALL  # noqa: E402
from ledgerflow.plans.oracles import ORACLES  # noqa: E402
from ledgerflow.plans.queries import QUERIES  # noqa: E402
from ledgerflow.sources.tables import DRIVER_TABLES  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    """All of the engine's own queries; queries on documents give SQL only where it can express them."""
    assert set(QUERIES) == set(ORACLES)
    assert set(oracle_sql()) <= set(queries()) and set(QUERIES) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    got = queries()[name](spark, SF_SMALL).toPandas()
    want = duck.execute(oracle_sql()[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert frame_hash(got) == frame_hash(want)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0 and "is_current" in df.columns
