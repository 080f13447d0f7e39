"""Every registered query equals its DuckDB oracle (at sf0.01)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, norm, rows_key  # noqa: E402
from helpers import MEDIUM  # noqa: E402
from recurwork.plans.catalog import QUERIES  # noqa: E402

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{MEDIUM}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, MEDIUM)
    columns = sorted(df.columns)
    got = sorted([tuple(norm(r[c]) for c in columns) for r in df.collect()], key=rows_key)
    rel = duck.sql(E.oracle_sql()[key])
    names = list(rel.columns)
    assert sorted(names) == columns
    want = sorted([tuple(norm(r[names.index(c)]) for c in columns) for r in rel.fetchall()], key=rows_key)
    assert want, "no rows: the comparison would prove nothing"
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["trade", "total_repeats", "stores_affected", "assets_affected",
                          "repeats_90d", "repeats_180d", "repeats_365d"]
