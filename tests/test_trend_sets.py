"""Distinct counts as sets and sketches: merged counts equal COUNT(DISTINCT), from the written table alone."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from helpers import AS_OF, MEDIUM, r_df, rec
from recurwork.operators import distinct
from recurwork.plans import reports, trend_sets
from recurwork.sources.fixtures import fx_recurring

ROLL_UPS = [("month", False), ("quarter", False), ("year", False), ("month", True), ("quarter", True), (None, True), (None, False)]


def rows(df):
    return sorted(map(str, df.collect()))


def plainly(r, of, by_trade):
    base = reports.recent(r, AS_OF, 365).filter("sc_trade_name IS NOT NULL")
    when = {"month": F.date_format("call_date", "yyyy-MM"), "quarter": F.date_format("call_date", "yyyy-'Q'q"), "year": F.date_format("call_date", "yyyy")}
    keys = ([when[of].alias("period")] if of else []) + ([F.col("sc_trade_name").alias("trade")] if by_trade else [])
    return base.groupBy(*keys).agg(F.count("*").alias("total_repeats"), F.sum("month3_flag").alias("within_90d"), F.countDistinct("store_nbr").alias("stores_affected"))


@pytest.fixture(scope="module")
def written_sets(spark):
    r = fx_recurring(spark, MEDIUM)
    at = tempfile.mkdtemp(prefix="recurwork-sets-") + "/sets"
    trend_sets.trend_sets(r, AS_OF).write.parquet(at)
    return r, spark.read.parquet(at)


@pytest.mark.parametrize("of,by_trade", ROLL_UPS)
def test_roll_ups_of_the_written_sets_equal_the_facts(written_sets, of, by_trade):
    r, sets = written_sets
    got = rows(trend_sets.roll_up(sets, of, by_trade))
    assert got == rows(plainly(r, of, by_trade)) and got


def test_the_sets_hold_the_trend_itself(written_sets):
    r, sets = written_sets
    got = trend_sets.roll_up(sets, "month", True).withColumnRenamed("period", "month")
    assert rows(got) == rows(reports.monthly_trend_groups(r, AS_OF))


def test_a_store_of_two_months_counts_once(spark):
    r = r_df(spark, [rec(1, "2001-04-03", 5, 7), rec(2, "2001-05-03", 100, 7), rec(3, "2001-05-04", 5, 8), rec(4, "2001-05-04", 5, 9, trade=None)])
    sets = trend_sets.trend_sets(r, AS_OF)
    assert [tuple(x) for x in trend_sets.roll_up(sets, "month").collect()] == [("2001-04", 1, 1, 1), ("2001-05", 2, 1, 2)]
    assert [tuple(x) for x in trend_sets.roll_up(sets, "quarter").collect()] == [("2001-Q2", 3, 2, 2)]
    with pytest.raises(ValueError):
        trend_sets.roll_up(sets, "week")


def test_no_rows(spark):
    sets = trend_sets.trend_sets(r_df(spark, []), AS_OF)
    assert trend_sets.roll_up(sets, "month").collect() == []
    assert [tuple(x) for x in distinct.count_sets(sets, [], "stores").collect()] == [(0,)]


def test_any_integer_has_a_bit_of_its_own(spark):
    rng = random.Random(5)
    edges = [0, 1, -1, 32767, 32768, 32769, -32767, -32768, -32769, 2**31, -2**31, 2**62, -2**62, 2**63 - 1]
    values = edges + [rng.randrange(-2**63 + 1, 2**63) for _ in range(300)] + [rng.randrange(-70000, 70000) for _ in range(3000)]
    data = [(i % 3, i % 7, v) for i, v in enumerate(values * 2)] + [(9, 0, None), (0, 0, None)]
    df = spark.createDataFrame(data, "a int, b int, v bigint")
    sets = distinct.distinct_sets(df, ["a", "b"], "v")
    assert rows(distinct.count_sets(sets, ["a"], "n")) == rows(df.groupBy("a").agg(F.countDistinct("v").alias("n")))
    assert distinct.count_sets(sets, [], "n").first().n == len(set(values))
    again = distinct.merge_sets(distinct.merge_sets(sets, ["a", "b"]), ["a"])  # a set of sets is a set
    assert rows(distinct.count_sets(again, ["a"], "n")) == rows(distinct.count_sets(sets, ["a"], "n"))


def test_sketches_merge_to_near_counts(spark):
    df = spark.range(60000).select((F.col("id") % 4).alias("month"), F.concat(F.lit("asset "), F.col("id") % 20000).alias("asset"))
    parts = distinct.distinct_sketches(df, ["month"], "asset")
    assert all(abs(x.n - 5000) < 500 for x in distinct.estimate_sketches(parts, ["month"], "n").collect())
    assert abs(distinct.estimate_sketches(parts, [], "n").first().n - 20000) < 1500


def test_a_hot_trade_is_spread_over_its_stores(spark, written_sets):
    """The first exchange of the sets hashes the store too, behind a partial count."""
    plan = trend_sets.trend_sets(written_sets[0], AS_OF)._jdf.queryExecution().executedPlan().toString()
    hashed = [line for line in plan.splitlines() if "Exchange hashpartitioning(month" in line]
    assert any("_set_value" in line for line in hashed) and "Python" not in plan
