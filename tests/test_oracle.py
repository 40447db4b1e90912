"""Every registered query against its DuckDB oracle on the smoke tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tessellate.sources.tables import TABLE_NAMES

from .compare import multiset

SF = "/root/testdata/sf0.001"
NAMES = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLE_NAMES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "qty_roll_mean_lag_4_win_4" in df.columns


def test_every_query_has_callable():
    qs = entry.queries()
    assert set(entry.oracle_sql()) <= set(qs)
    assert len(qs) >= 90


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rows, cols = df.collect(), df.columns
    cur = con.execute(entry.oracle_sql()[name])
    drows, dcols = cur.fetchall(), [d[0] for d in cur.description]
    assert sorted(cols) == sorted(dcols)
    order = sorted(cols)
    assert len(rows) == len(drows)
    assert multiset(rows, cols, order) == multiset(drows, dcols, order)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_rows_only_queries_run(spark, name):
    df = entry.queries()[name](spark, SF)
    assert df.count() >= 0
