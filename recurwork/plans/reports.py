"""The six recurring-repeat reports over R (and W), as lazy DataFrames.

Each takes the inputs and parameters and returns an un-collected DataFrame.
``w_unique=True`` declares W's ``tracking_nbr`` a key and skips the
de-duplication sort of W (see ``operators.dimension``).
``as_of`` replaces CURRENT_DATE so results are repeatable.  Default lookbacks
are the reference's; every row is kept unless a ``limit`` is asked for.  Every
order ends with the group keys so that a cut is deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurwork.functions.exprs import UNKNOWN, as_of_lit, day_lookback, default, present_tech
from recurwork.operators.dimension import enrich
from recurwork.operators.ordering import top_k
from recurwork.sources.tables import since_month_filter


def recent(r: DataFrame, as_of, lookback_days: int) -> DataFrame:
    start = F.date_sub(as_of_lit(as_of), lookback_days)
    return r.filter(since_month_filter(r, "call_date", start) & day_lookback("call_date", as_of, lookback_days))


def repeats_by_trade(r: DataFrame, as_of, lookback_days: int = 365, limit: int | None = None) -> DataFrame:
    """Repeats per trade with distinct stores / assets and the cumulative 90/180/365-day counts."""
    base = recent(r, as_of, lookback_days).filter(F.col("sc_trade_name").isNotNull())
    out = base.groupBy(default("sc_trade_name", UNKNOWN).alias("trade")).agg(
        F.count(F.lit(1)).alias("total_repeats"),
        F.countDistinct("store_nbr").alias("stores_affected"),
        F.countDistinct("equip_tagid").alias("assets_affected"),
        F.sum("month3_flag").alias("repeats_90d"),
        F.sum("month6_flag").alias("repeats_180d"),
        F.sum("month12_flag").alias("repeats_365d"),
    )
    return top_k(out, [F.col("total_repeats").desc(), F.col("trade").asc()], limit)


def problem_codes(r: DataFrame, as_of, lookback_days: int = 365, min_count: int = 3,
                  limit: int | None = None) -> DataFrame:
    """Problem codes per trade that repeat at least ``min_count`` times."""
    out = problem_code_groups(r, as_of, lookback_days, min_count)
    return top_k(out, [F.col("repeat_count").desc(), F.col("trade").asc(), F.col("problem_code").asc()], limit)


def problem_code_groups(r: DataFrame, as_of, lookback_days: int = 365, min_count: int = 3) -> DataFrame:
    """The unsorted aggregate behind :func:`problem_codes` (for consumers that re-aggregate)."""
    base = recent(r, as_of, lookback_days).filter(F.col("sc_trade_name").isNotNull())
    return base.groupBy(
        default("sc_trade_name", UNKNOWN).alias("trade"),
        default("problem_code_desc", UNKNOWN).alias("problem_code"),
    ).agg(
        F.count(F.lit(1)).alias("repeat_count"),
        F.countDistinct("store_nbr").alias("stores_affected"),
        F.sum("month3_flag").alias("within_90d"),
        F.sum("month6_flag").alias("within_180d"),
    ).filter(F.col("repeat_count") >= min_count)


def store_hotspots(r: DataFrame, w: DataFrame, as_of, lookback_days: int = 365,
                   limit: int | None = None, list_limit: int = 5, w_unique: bool = False) -> DataFrame:
    """Stores by 90-day repeats, with location / organisation from W.

    Keeps repeats without a trade (no trade filter, as in the reference).
    Only 90-day repeats are read, so ``total_repeats`` equals ``repeats_90d``
    by construction (both kept, as in the reference).
    ``top_trades`` lists up to ``list_limit`` distinct trades, alphabetically
    (the reference's pick is unordered); NULL when the store has none.  The
    rows are counted per (store, trade) first, then per store: R is read once, and
    a store gathers one row per trade.
    """
    base = recent(r, as_of, lookback_days).filter(F.col("month3_flag") == 1) \
        .select("tracking_nbr", "store_nbr", "sc_trade_name", "month3_flag", "month6_flag")
    j = enrich(base, w, ["store_city", "store_state", "fm_sr_director", "fm_director", "store_type_name"],
               dedupe=not w_unique)
    trades = j.groupBy("store_nbr", "sc_trade_name").agg(
        F.max("store_city").alias("city"),
        F.max("store_state").alias("state"),
        F.max("fm_sr_director").alias("sr_director"),
        F.max("fm_director").alias("fm_director"),
        F.max("store_type_name").alias("banner"),
        F.count(F.lit(1)).alias("n"),
        F.sum("month3_flag").alias("n90"),
        F.sum("month6_flag").alias("n180"),
    )
    names = F.array_sort(F.collect_list("sc_trade_name"))  # one entry per trade of the store
    out = trades.groupBy("store_nbr").agg(
        *[F.max(c).alias(c) for c in ("city", "state", "sr_director", "fm_director", "banner")],
        F.sum("n").alias("total_repeats"),
        F.count("sc_trade_name").alias("trades_affected"),
        F.sum("n90").alias("repeats_90d"),
        F.sum("n180").alias("repeats_180d"),
        F.when(F.count("sc_trade_name") > 0, F.array_join(F.slice(names, 1, list_limit), ", ")).alias("top_trades"),
    )
    return top_k(out, [F.col("total_repeats").desc(), F.col("store_nbr").asc()], limit)


def monthly_trend(r: DataFrame, as_of, lookback_days: int = 365) -> DataFrame:
    """Repeats per calendar month and trade (``stores_affected`` is not additive over months)."""
    out = monthly_trend_groups(r, as_of, lookback_days)
    return out.orderBy(F.col("month").asc(), F.col("total_repeats").desc(), F.col("trade").asc())


def monthly_trend_groups(r: DataFrame, as_of, lookback_days: int = 365) -> DataFrame:
    """The unsorted aggregate behind :func:`monthly_trend` (for views that re-aggregate it)."""
    base = recent(r, as_of, lookback_days).filter(F.col("sc_trade_name").isNotNull())
    return base.groupBy(
        F.date_format("call_date", "yyyy-MM").alias("month"),
        default("sc_trade_name", UNKNOWN).alias("trade"),
    ).agg(
        F.count(F.lit(1)).alias("total_repeats"),
        F.sum("month3_flag").alias("within_90d"),
        F.countDistinct("store_nbr").alias("stores_affected"),
    )


DETAIL_COLUMNS = ["tracking_nbr", "prev_tracking_nbr", "store_nbr", "trade", "asset_tag", "asset_type",
                  "call_date", "prev_call_date", "days_between", "problem_code", "prev_problem_code",
                  "month3_flag", "month6_flag", "month12_flag"]


def repeat_detail(r: DataFrame, as_of, lookback_days: int = 365, limit: int | None = None,
                  w: DataFrame | None = None, w_unique: bool = False) -> DataFrame:
    """Latest 90-day repeats, one row each (no join).

    With ``w`` the rows are enriched from W (city, state, directors, technician),
    the columns the gap finder filters and searches on.
    """
    base = recent(r, as_of, lookback_days).filter(
        (F.col("month3_flag") == 1) & F.col("sc_trade_name").isNotNull())
    out = base.select(
        "tracking_nbr", "prev_tracking_nbr", "store_nbr",
        default("sc_trade_name", "").alias("trade"),
        default("equip_tagid", "").alias("asset_tag"),
        default("asset_type", "").alias("asset_type"),
        F.col("call_date").cast("string").alias("call_date"),
        F.col("prev_call_date").cast("string").alias("prev_call_date"),
        F.datediff("call_date", "prev_call_date").alias("days_between"),
        default("problem_code_desc", "").alias("problem_code"),
        default("prev_problem_code_desc", "").alias("prev_problem_code"),
        "month3_flag", "month6_flag", "month12_flag",
    )
    out = top_k(out, [F.col("call_date").desc(), F.col("tracking_nbr").desc()], limit) if w is None or limit is not None else out
    if w is None:
        return out
    j = enrich(out, w, ["store_city", "store_state", "fm_director", "fm_sr_director", "latest_activity_tech"],
               dedupe=not w_unique)
    return j.select(*DETAIL_COLUMNS,
                    F.col("store_city").alias("city"), F.col("store_state").alias("state"),
                    "fm_director", F.col("fm_sr_director").alias("sr_director"),
                    F.col("latest_activity_tech").alias("tech_name"))


def tech_repeats(r: DataFrame, w: DataFrame, as_of, lookback_days: int = 365, min_count: int = 2,
                 limit: int | None = None, w_unique: bool = False) -> DataFrame:
    """90-day repeats per technician and trade.

    The reference writes a LEFT JOIN then filters on W's technician, which
    makes it an inner join; Catalyst rewrites it the same way.  Only 90-day
    repeats are read, so ``within_90d`` equals ``repeat_wos`` by construction.
    """
    base = recent(r, as_of, lookback_days).filter(F.col("month3_flag") == 1) \
        .select("tracking_nbr", "store_nbr", "sc_trade_name", "equip_tagid", "month3_flag")
    j = enrich(base, w, ["latest_activity_tech"], dedupe=not w_unique).filter(present_tech("latest_activity_tech"))
    out = j.groupBy(
        default("latest_activity_tech", UNKNOWN).alias("tech_name"),
        default("sc_trade_name", UNKNOWN).alias("trade"),
    ).agg(
        F.count(F.lit(1)).alias("repeat_wos"),
        F.countDistinct("store_nbr").alias("stores"),
        F.countDistinct("equip_tagid").alias("unique_assets"),
        F.sum("month3_flag").alias("within_90d"),
    ).filter(F.col("repeat_wos") >= min_count)
    return top_k(out, [F.col("repeat_wos").desc(), F.col("tech_name").asc(), F.col("trade").asc()], limit)
