"""Fixture views: the driver's TPC-H-like tables playing R, W and S.

The reference ships no data.  These views derive work orders from ``orders``
joined to ``customer`` (and ``nation``/``region`` for the organisation), and
deliberately inject what the operators must handle: NULL and blank values,
sentinel technicians, unmatched dimension keys, padded asset names.

Fixed values (must stay equal to the oracle SQL in ``oracle_queries.py``):
  AS_OF                = 2001-08-02 (orders run 1995-01-01 .. 2001-08-01)
  fx_wo store          = o_custkey % 5 (few, so that groups are large)
  fx_rec store         = o_custkey % 100
  fx_wo trade          = 'PM - HOUSEHOLD' for HOUSEHOLD, else 'FM - ' || segment
  fx_wo type           = 'PM' for '4-NOT SPECIFIED', else the order priority
  fx_wo code           = order status, NULL for 'P'
  fx_wo amount         = NULL when o_orderkey % 11 = 0
  fx_wo asset desc     = '  ' when o_custkey % 7 = 0; ' Unit n' for even keys; 'Unit n' (n = o_custkey % 5)
  fx_wo asset tag      = '' when o_custkey % 3 = 0, else o_custkey as text
  fx_dim               = no row when o_orderkey % 10 = 0
  fx_dim fm_director   = '' when o_custkey % 13 = 0, else nation name
  fx_dim fs manager    = NULL when o_custkey % 4 = 0, else 'Manager ' || o_custkey % 25
  fx_dim technician    = 'None' / '' / NULL for o_custkey % 20 = 0 / 1 / 2, else 'Tech ' || o_custkey % 20
  fx_rec trade         = NULL for BUILDING, else 'FM - ' || segment, ' NIGHT' behind it when o_custkey // 100 is odd
  fx_rec flags         = gap <= 90 / 180 / 365 days to the customer's previous order
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

AS_OF = _dt.date(2001, 8, 2)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _orders_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = _table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    return o.join(c, o.o_custkey == c.c_custkey)


def _txt(c):
    return c.cast("string")


def fx_workorders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S — raw work orders."""
    oc = _orders_customers(spark, sf_dir)
    seg, key, cust = F.col("c_mktsegment"), F.col("o_orderkey"), F.col("o_custkey")
    return oc.select(
        key.alias("tracking_nbr"),
        (cust % 5).alias("store_nbr"),
        F.when(seg == "HOUSEHOLD", F.lit("PM - HOUSEHOLD"))
         .otherwise(F.concat(F.lit("FM - "), seg)).alias("sc_trade_name"),
        seg.alias("category_name"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("PM"))
         .otherwise(F.col("o_orderpriority")).alias("problem_type_desc"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("problem_code_desc"),
        F.to_date("o_orderdate").alias("completion_date"),
        F.when(key % 11 == 0, F.lit(None))
         .otherwise(F.col("o_totalprice").cast("decimal(18,2)")).alias("not_to_exceed_amt"),
        F.when(cust % 7 == 0, F.lit("  "))
         .when(key % 2 == 0, F.concat(F.lit(" Unit "), _txt(cust % 5)))
         .otherwise(F.concat(F.lit("Unit "), _txt(cust % 5))).alias("equipment_desc"),
        F.when(cust % 3 == 0, F.lit("")).otherwise(_txt(cust)).alias("equipment_tagid"),
        F.concat(F.lit("Order "), _txt(key), F.lit(" "), F.col("o_orderpriority")).alias("problem_desc"),
    )


def fx_workorder_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W — organisation / location / technician per work order; one in ten has no row."""
    oc = _orders_customers(spark, sf_dir).filter(F.col("o_orderkey") % 10 != 0)
    n = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = _table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = oc.join(n, oc.c_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == r.r_regionkey)
    cust = F.col("o_custkey")
    m20 = cust % 20
    return j.select(
        F.col("o_orderkey").alias("tracking_nbr"),
        F.col("n_name").alias("store_city"),
        F.col("r_name").alias("store_state"),
        F.col("r_name").alias("fm_sr_director"),
        F.when(cust % 13 == 0, F.lit("")).otherwise(F.col("n_name")).alias("fm_director"),
        F.concat(F.lit("Regional "), _txt(cust % 10)).alias("fm_regional_mgr"),
        F.when(cust % 4 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Manager "), _txt(cust % 25))).alias("aligned_fs_mgr"),
        F.col("c_mktsegment").alias("store_type_name"),
        F.when(m20 == 0, F.lit("None")).when(m20 == 1, F.lit(""))
         .when(m20 == 2, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Tech "), _txt(m20))).alias("latest_activity_tech"),
    )


def fx_recurring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R — each order with an earlier order of the same customer, flagged by gap."""
    oc = _orders_customers(spark, sf_dir)
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    seg = F.col("c_mktsegment")
    day = F.to_date("o_orderdate")
    x = oc.select(
        F.col("o_orderkey").alias("tracking_nbr"),
        F.lag("o_orderkey").over(w).alias("prev_tracking_nbr"),
        (F.col("o_custkey") % 100).alias("store_nbr"),
        F.when(seg == "BUILDING", F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("FM - "), seg, F.when(F.expr("o_custkey div 100") % 2 == 1, " NIGHT").otherwise(""))).alias("sc_trade_name"),
        _txt(F.col("o_custkey")).alias("equip_tagid"),
        seg.alias("asset_type"),
        day.alias("call_date"),
        F.lag(day).over(w).alias("prev_call_date"),
        F.col("o_orderpriority").alias("problem_code_desc"),
        F.lag("o_orderpriority").over(w).alias("prev_problem_code_desc"),
    )
    gap = F.datediff("call_date", "prev_call_date")
    flag = lambda d: F.when(gap <= d, F.lit(1)).otherwise(F.lit(0))
    return x.filter(F.col("prev_tracking_nbr").isNotNull()).select(
        "tracking_nbr", "prev_tracking_nbr", "store_nbr", "sc_trade_name", "equip_tagid",
        "asset_type", "call_date", "prev_call_date", "problem_code_desc", "prev_problem_code_desc",
        flag(90).alias("month3_flag"), flag(180).alias("month6_flag"), flag(365).alias("month12_flag"),
    )

