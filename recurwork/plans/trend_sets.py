"""The monthly trend as mergeable sets (A2, A17, V15): stores per month, quarter, year or trade from one table.

``stores_affected`` of the trend is not additive: a store that calls in January and in
February counts in both.  :func:`trend_sets` is written once per refresh, a row per
month, trade and bucket of store numbers, and every roll-up of it is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recurwork.functions.exprs import UNKNOWN, default
from recurwork.operators.distinct import count_sets, distinct_sets
from recurwork.plans.reports import recent

MEASURES = ("total_repeats", "within_90d")


def trend_sets(r: DataFrame, as_of, lookback_days: int = 365, value: str = "store_nbr") -> DataFrame:
    """Per month and trade the repeats, the 90-day repeats and the set of stores (or of another integer column)."""
    base = recent(r, as_of, lookback_days).filter(F.col("sc_trade_name").isNotNull()).select(
        F.date_format("call_date", "yyyy-MM").alias("month"), default("sc_trade_name", UNKNOWN).alias("trade"), value, "month3_flag")
    return distinct_sets(base, ["month", "trade"], value, {"total_repeats": F.lit(1), "within_90d": F.col("month3_flag")})


def period(of: str) -> Column:
    """The ``month``, ``quarter`` ('2001-Q3') or ``year`` of a row of the trend."""
    year = F.substring("month", 1, 4)
    quarter = F.ceil(F.substring("month", 6, 2).cast("int") / 3).cast("string")
    known = {"month": F.col("month"), "quarter": F.concat(year, F.lit("-Q"), quarter), "year": year}
    if of not in known:
        raise ValueError(f"unknown period {of!r}; allowed: {sorted(known)}")
    return known[of].alias("period")


def roll_up(sets: DataFrame, of: str | None = "month", by_trade: bool = False, name: str = "stores_affected") -> DataFrame:
    """Repeats, 90-day repeats and exact distinct stores per period, per trade, per both or in all."""
    keys = [period(of)] if of else []
    out = count_sets(sets, [*keys, *([F.col("trade")] if by_trade else [])], name, MEASURES)
    named = (["period"] if of else []) + (["trade"] if by_trade else [])
    return out.orderBy(*named) if named else out
