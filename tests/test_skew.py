"""The pair pipeline on a skewed work-order table equals the DuckDB oracle.

A third of all orders are forced onto one store / problem type / code (the
hot key), on few days, so the LAG, the bounded lists and the asset counts all
meet a hot group.
"""

import os
import tempfile

import duckdb
from pyspark.sql import functions as F

import oracle_queries as O
from helpers import MEDIUM
from oracle_check import norm, rows_key
from recurwork.operators.repeats import repeat_pairs_30d
from recurwork.sources.fixtures import AS_OF, fx_workorder_dim, fx_workorders


def test_hot_key_pairs_match_oracle(spark):
    hot = F.col("tracking_nbr") % 3 == 0
    s = fx_workorders(spark, MEDIUM) \
        .withColumn("store_nbr", F.when(hot, F.lit(0).cast("bigint")).otherwise(F.col("store_nbr"))) \
        .withColumn("problem_type_desc", F.when(hot, F.lit("1-URGENT")).otherwise(F.col("problem_type_desc"))) \
        .withColumn("problem_code_desc", F.when(hot, F.lit("F")).otherwise(F.col("problem_code_desc"))) \
        .withColumn("sc_trade_name", F.when(hot, F.lit("FM - HOT")).otherwise(F.col("sc_trade_name"))) \
        .withColumn("completion_date", F.when(hot, F.date_add(F.lit("2000-01-01").cast("date"),
                                                              (F.col("tracking_nbr") % 7).cast("int")))
                    .otherwise(F.col("completion_date")))
    path = os.path.join(tempfile.mkdtemp(prefix="recurwork-skew-"), "s.parquet")
    s.coalesce(1).write.parquet(path)
    s = spark.read.parquet(path)
    got = repeat_pairs_30d(s, fx_workorder_dim(spark, MEDIUM), AS_OF, 100)
    rows = sorted([tuple(norm(x) for x in r) for r in got.collect()], key=rows_key)
    hot_rows = [r for r in rows if r[0] == 0 and r[1] == "1-URGENT"]
    assert sum(r[9] for r in hot_rows) > 4000  # the hot key holds a third of all work orders

    con = duckdb.connect()
    for t in ("orders", "customer", "nation", "region"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{MEDIUM}/{t}.parquet')")
    fx_wo = f"fx_wo AS (SELECT * FROM read_parquet('{path}/*.parquet'))"
    sql = O.with_ctes(fx_wo, O.FX_DIM, *O.repeat_pairs_ctes(months=100)) + f"SELECT {', '.join(got.columns)} FROM repeat_pairs_30d"
    want = sorted([tuple(norm(x) for x in r) for r in con.sql(sql).fetchall()], key=rows_key)
    assert len(rows) == len(want)
    assert rows == want
