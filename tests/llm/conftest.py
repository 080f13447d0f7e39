import os

import duckdb
import pytest

SMALL = "/root/testdata/sf0.001"


def rows_of(df, columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


@pytest.fixture(scope="session")
def same_as_sql():
    """Whether a query gives the rows of its SQL on the small tables."""

    def check(spark, name):
        from recurwork.llm import queries

        con = duckdb.connect()
        for f in os.listdir(SMALL):
            con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SMALL}/{f}'")
        found = con.execute(queries.oracle_sql()[name])
        columns = [d[0] for d in found.description]
        df = queries.QUERIES[name](spark, SMALL)
        assert sorted(df.columns) == sorted(columns)
        want = sorted((tuple(r) for r in found.fetchall()), key=repr)
        assert want and rows_of(df, columns) == want

    return check
