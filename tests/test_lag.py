"""The skew-safe LAG equals the one-window LAG, also for a hot key."""

import pytest
from pyspark.sql import functions as F

from helpers import MEDIUM
from recurwork.operators.lag import previous_date, previous_date_plain


@pytest.fixture(scope="module")
def orders(spark):
    o = spark.read.parquet(f"{MEDIUM}/orders.parquet")
    # one hot key holds every order with o_custkey % 3 = 0 (a third of all rows),
    # the rest spread over 50 keys; dates repeat, so same-day ties are common
    return o.select(
        F.when(F.col("o_custkey") % 3 == 0, F.lit(0)).otherwise(F.col("o_custkey") % 50 + 1).alias("k"),
        F.to_date("o_orderdate").alias("d"), F.col("o_orderkey").alias("t"))


def test_day_table_lag_equals_plain_lag(orders):
    a = previous_date(orders, ["k"], "d", "t", "p").select("t", "p")
    b = previous_date_plain(orders, ["k"], "d", "t", "p").select("t", "p")
    assert a.count() == b.count() == orders.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_gaps_over_the_whole_history(spark):
    from recurwork.operators import repeats
    from recurwork.plans.catalog import QUERIES
    from recurwork.sources.fixtures import AS_OF, fx_workorders

    got = QUERIES["work_order_gaps_all"](spark, MEDIUM)
    every = repeats.work_orders(fx_workorders(spark, MEDIUM), AS_OF, 1200)  # 100 years: no lookback
    plain = previous_date_plain(every, repeats.KEY, "completion_date", "tracking_nbr", "prev_completion")
    want = plain.withColumn("days_since_prev", F.datediff("completion_date", "prev_completion")).select(got.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
