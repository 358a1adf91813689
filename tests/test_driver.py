"""Driver contract: entry() smoke and every query against its DuckDB oracle (sf0.001)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, rows_sorted  # noqa: E402

from pricemart.queries.catalog import all_queries, all_sql  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["period", "fuel_type", "price_lkr", "price_usd", "usd_lkr_rate", "brent_usd_per_barrel",
                          "crude_cost_pct"]
    rows = df.collect()
    assert len(rows) == len({(r.period, r.fuel_type) for r in rows}) > 0
    assert all(r.price_lkr > 0 for r in rows)


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(all_sql())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    sc, sr = rows_sorted(df.columns, df.collect())
    res = con.execute(E.oracle_sql()[name])
    dc, dr = rows_sorted([d[0] for d in res.description], res.fetchall())
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr
