"""Declared schemas of the three inputs and of the persisted results.

Coercion happens once, at ingest (``sources.tables``); operators assume these
types.
"""

from pyspark.sql import types as T

# R — one row per work order that had an earlier work order on the same asset.
# The three flags are cumulative: month3 ⊂ month6 ⊂ month12.
RECURRING = T.StructType([
    T.StructField("tracking_nbr", T.LongType(), False),
    T.StructField("prev_tracking_nbr", T.LongType(), True),
    T.StructField("store_nbr", T.LongType(), False),
    T.StructField("sc_trade_name", T.StringType(), True),
    T.StructField("equip_tagid", T.StringType(), True),
    T.StructField("asset_type", T.StringType(), True),
    T.StructField("call_date", T.DateType(), False),
    T.StructField("prev_call_date", T.DateType(), True),
    T.StructField("problem_code_desc", T.StringType(), True),
    T.StructField("prev_problem_code_desc", T.StringType(), True),
    T.StructField("month3_flag", T.IntegerType(), False),
    T.StructField("month6_flag", T.IntegerType(), False),
    T.StructField("month12_flag", T.IntegerType(), False),
])

# W — work-order dimension (organisation alignment, location, technician).
WORKORDER_DIM = T.StructType([
    T.StructField("tracking_nbr", T.LongType(), False),
    T.StructField("store_city", T.StringType(), True),
    T.StructField("store_state", T.StringType(), True),
    T.StructField("fm_sr_director", T.StringType(), True),
    T.StructField("fm_director", T.StringType(), True),
    T.StructField("fm_regional_mgr", T.StringType(), True),
    T.StructField("aligned_fs_mgr", T.StringType(), True),
    T.StructField("store_type_name", T.StringType(), True),
    T.StructField("latest_activity_tech", T.StringType(), True),
])

# S — raw work-order fact.
WORKORDERS = T.StructType([
    T.StructField("tracking_nbr", T.LongType(), False),
    T.StructField("store_nbr", T.LongType(), True),
    T.StructField("sc_trade_name", T.StringType(), True),
    T.StructField("category_name", T.StringType(), True),
    T.StructField("problem_type_desc", T.StringType(), True),
    T.StructField("problem_code_desc", T.StringType(), True),
    T.StructField("completion_date", T.DateType(), True),
    T.StructField("not_to_exceed_amt", T.DecimalType(18, 2), True),
    T.StructField("equipment_desc", T.StringType(), True),
    T.StructField("equipment_tagid", T.StringType(), True),
    T.StructField("problem_desc", T.StringType(), True),
])

ASSET_COUNT = T.StructType([
    T.StructField("rank", T.IntegerType(), False),
    T.StructField("equipment_desc", T.StringType(), True),
    T.StructField("equipment_tagid", T.StringType(), True),
    T.StructField("wo_count", T.LongType(), False),
])

# Result of repeat_pairs_30d (one row per store, problem type, code, trade, category).
REPEAT_PAIRS = T.StructType([
    T.StructField("store_nbr", T.LongType(), True),
    T.StructField("problem_type_desc", T.StringType(), True),
    T.StructField("problem_code_desc", T.StringType(), True),
    T.StructField("sc_trade_name", T.StringType(), True),
    T.StructField("category_name", T.StringType(), True),
    T.StructField("fm_director", T.StringType(), True),
    T.StructField("sr_director", T.StringType(), True),
    T.StructField("regional_mgr", T.StringType(), True),
    T.StructField("fs_mgr", T.StringType(), True),
    T.StructField("completion_count", T.LongType(), True),
    T.StructField("first_completion", T.StringType(), True),
    T.StructField("last_completion", T.StringType(), True),
    T.StructField("total_nte", T.DoubleType(), True),
    T.StructField("avg_nte", T.DoubleType(), True),
    T.StructField("min_days_between", T.IntegerType(), True),
    T.StructField("repeat_count_30d", T.LongType(), True),
    T.StructField("tracking_numbers", T.StringType(), True),
    T.StructField("sample_descs_raw", T.StringType(), True),
    T.StructField("asset_counts_str", T.StringType(), True),
])
