"""Repeat pairs: work orders of one store / problem type / problem code that
come back within ``repeat_days`` of the previous completion.

Steps (each a lazy DataFrame function; none runs a job):

``work_orders``    S filtered to the lookback and to breakdown FM work, with
                   ``code_key`` (NULL and '' codes are one key everywhere).
``group_measures`` per (store, type, code, trade, category): counts, dates,
                   money and repeats, HAVING >= ``min_repeats``.
``recent``         the latest tracking numbers and descriptions per group.
``asset_counts``   the busiest assets per (store, type, code).

The gap to the previous work order is never computed row by row.  Work orders
are first counted per (key, day, trade, category); of all rows of a (key, day)
only the first one, in tracking-number order, follows an earlier day, the others
follow a row of their own day.  So one window over that count table, whose size
per key is bounded by days and categories however hot the key, gives every gap.
This equals LAG ordered by (date, tracking number, NULL first), copies included.

``surviving_rows`` the rows of the keys that have a surviving group, with its measures' key.

Lists, assets and the organisation from W are read for surviving groups only: one
semi-join of S to the keys of the measures comes first, and its rows know whether
their own group survives.  Lazily, each list then plans S and the measures again.  A
caller who runs large inputs writes both once and passes the written tables as
``measures`` and ``survivors`` (:func:`in_two_reads`, ``plans.refresh``): S is then
read twice in all, for the measures and for these rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recurwork.functions.exprs import (EXCLUDED_PROBLEM_TYPES, FM_TRADE_PREFIX, as_of_lit,
                                       blank_to_null, not_in_upper, upper_prefix)
from recurwork.operators.dimension import enrich
from recurwork.operators.topn import join_field, ranked_list
from recurwork.sources.tables import since_month_filter

KEY = ["store_nbr", "problem_type_desc", "code_key"]
GROUP = KEY + ["sc_trade_name", "category_name"]
ORGANISATION = {"fm_director": "fm_director", "fm_sr_director": "sr_director",
                "fm_regional_mgr": "regional_mgr", "aligned_fs_mgr": "fs_mgr"}

# The lengths of the lists and of a description in the saved result.
N_TRACKING, N_DESCRIPTIONS, N_ASSETS, DESCRIPTION_CHARS = 20, 3, 6, 200


def work_orders(s: DataFrame, as_of, lookback_months: int = 3, excluded_types=EXCLUDED_PROBLEM_TYPES,
                trade_prefix: str = FM_TRADE_PREFIX, lookback_pad_days: int = 0) -> DataFrame:
    """The work orders that count, with ``code_key`` and ``edge`` (the first day of the lookback).

    The lookback filter stays *below* the gap: the first work order inside the
    window has no predecessor even if one exists just before it.
    ``lookback_pad_days > 0`` lets rows that many days before the edge serve as
    predecessors without being counted themselves.
    """
    edge = F.add_months(as_of_lit(as_of), -lookback_months)
    start = F.date_sub(edge, lookback_pad_days) if lookback_pad_days else edge
    return s.filter(
        since_month_filter(s, "completion_date", start)
        & F.col("completion_date").isNotNull()
        & (F.col("completion_date") >= start)
        & F.col("store_nbr").isNotNull()
        & upper_prefix("sc_trade_name", trade_prefix)
        & not_in_upper("problem_type_desc", excluded_types)
    ).withColumns({"code_key": F.coalesce("problem_code_desc", F.lit("")), "edge": edge})


def _group_struct() -> F.Column:
    # NULL trades / categories must group and join as equal: a struct key
    # compares NULL fields as equal, and one column keeps both sides
    # hash-partitioned on the same expression (no re-shuffle at the join).
    return F.struct(*[F.col(c) for c in GROUP]).alias("gk")


def group_measures(orders: DataFrame, repeat_days: int = 30, min_repeats: int = 2) -> DataFrame:
    """``gk`` and the measures of each group with at least ``min_repeats`` repeats.

    With ``min_repeats`` below 1 the groups of keys that have any repeat are kept.
    """
    nte = F.coalesce(F.col("not_to_exceed_amt"), F.lit(0).cast("decimal(18,2)"))
    tie = F.struct(F.col("tracking_nbr").isNotNull().alias("known"), F.col("tracking_nbr"))  # NULL first
    days = orders.groupBy(*GROUP, "edge", F.col("completion_date").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.min(tie).alias("tie"), F.sum(nte).alias("nte"))
    key = Window.partitionBy(*KEY)
    order = [F.col("tie").asc(), F.col("sc_trade_name").asc_nulls_first(), F.col("category_name").asc_nulls_first()]
    earlier = key.orderBy(F.unix_date("day")).rangeBetween(Window.unboundedPreceding, -1)
    days = days.withColumns({
        "first": F.row_number().over(Window.partitionBy(*KEY, "day").orderBy(*order)) == 1,
        "gap": F.datediff("day", F.max("day").over(earlier))})
    days = days.filter(F.col("day") >= F.col("edge"))
    same_day = F.col("n") - F.col("first").cast("int")  # these follow a row of their own day: gap 0
    repeats = F.when(F.lit(repeat_days) >= 0, same_day).otherwise(0) \
        + F.when(F.col("first") & (F.col("gap") <= repeat_days), 1).otherwise(0)
    least_gap = F.when(same_day > 0, F.lit(0)).when(F.col("first"), F.col("gap"))
    days = days.withColumns({"repeats": repeats, "least_gap": least_gap})
    if min_repeats < 1:
        days = days.withColumn("paired", F.max(F.col("repeats") > 0).over(key)).filter("paired")
    total = F.sum("nte")
    return days.groupBy(_group_struct()).agg(
        F.sum("n").alias("completion_count"),
        F.min("day").cast("string").alias("first_completion"),
        F.max("day").cast("string").alias("last_completion"),
        F.round(total, 2).cast("double").alias("total_nte"),
        F.round(total / F.sum("n"), 2).cast("double").alias("avg_nte"),
        F.min("least_gap").alias("min_days_between"),
        F.sum("repeats").alias("repeat_count_30d"),
    ).filter(F.col("repeat_count_30d") >= min_repeats)


def surviving_rows(orders: DataFrame, measures: DataFrame) -> DataFrame:
    """The rows of the keys that have a surviving group, with ``gk`` (NULL where the row's own group does not survive).

    One join on the key: the groups of a key, few trades and categories, travel with it.
    """
    groups = measures.select(*[F.col("gk")[c].alias(c) for c in KEY], "gk").groupBy(*KEY).agg(F.collect_set("gk").alias("groups"))
    # A predecessor from the pad is no member of a group, but the assets count by key within the lookback too.
    rows = orders.filter(F.col("completion_date") >= F.col("edge")).join(groups, KEY)
    # A written key reads as nullable.  With the very type of the measures' key, joins on it need no cast and unread lists are pruned.
    own = _group_struct().cast(measures.schema["gk"].dataType)
    return rows.select(*KEY, F.when(F.array_contains("groups", own), own).alias("gk"), "tracking_nbr", "completion_date", "problem_desc", "equipment_desc", "equipment_tagid")


def organisation(rows: DataFrame, w: DataFrame, w_unique: bool = False) -> DataFrame:
    """The organisation of each group from W; '' where W has none."""
    j = enrich(rows.select("gk", "tracking_nbr"), w, list(ORGANISATION), dedupe=not w_unique)
    return j.groupBy("gk").agg(*[F.max(F.coalesce(F.col(src), F.lit(""))).alias(dst) for src, dst in ORGANISATION.items()])


def recent(rows: DataFrame, n_tracking: int = N_TRACKING, n_descs: int = N_DESCRIPTIONS,
           description_chars: int | None = DESCRIPTION_CHARS) -> DataFrame:
    """Per group the array ``recent`` (rank, tracking_nbr, description) of its latest work orders, date desc."""
    text = F.coalesce("problem_desc", F.lit(""))
    src = rows.select("gk", "completion_date", "tracking_nbr",
                      (text if description_chars is None else F.substring(text, 1, description_chars)).alias("text"))
    order = [F.col("completion_date").desc(), F.col("tracking_nbr").desc_nulls_last(), F.col("text").asc()]
    return ranked_list(src, ["gk"], order, max(n_tracking, n_descs),
                       {"tracking_nbr": F.col("tracking_nbr").cast("string"), "description": F.col("text")}, "recent")


def asset_counts(rows: DataFrame, n_assets: int = N_ASSETS) -> DataFrame:
    """Per (store, type, code_key): the ``n_assets`` assets with most work orders.

    Asset names are trimmed *before* grouping, so ' a' and 'a' are one asset;
    blank names are skipped.  Ties: count desc, then name, then tag.
    Returns the native array ``assets`` (rank, equipment_desc, equipment_tagid,
    wo_count) and its export string ``asset_counts_str`` ('desc~tag~count,..').
    """
    a = rows.select(*KEY, blank_to_null("equipment_desc").alias("equipment_desc"),
                    blank_to_null("equipment_tagid").alias("equipment_tagid")) \
        .filter(F.col("equipment_desc").isNotNull()) \
        .groupBy(*KEY, "equipment_desc", "equipment_tagid").agg(F.count(F.lit(1)).alias("wo_count"))
    order = [F.col("wo_count").desc(), F.col("equipment_desc").asc(), F.col("equipment_tagid").asc_nulls_first()]
    lst = ranked_list(a, KEY, order, n_assets,
                      {"equipment_desc": F.col("equipment_desc"), "equipment_tagid": F.col("equipment_tagid"),
                       "wo_count": F.col("wo_count")}, "assets")
    text = F.transform("assets", lambda x: F.concat(
        x["equipment_desc"], F.lit("~"), F.coalesce(x["equipment_tagid"], F.lit("")), F.lit("~"),
        x["wo_count"].cast("string")))
    return lst.withColumn("asset_counts_str", F.array_join(text, ","))


OUTPUT = ["store_nbr", "problem_type_desc", "problem_code_desc", "sc_trade_name", "category_name",
          "fm_director", "sr_director", "regional_mgr", "fs_mgr", "completion_count",
          "first_completion", "last_completion", "total_nte", "avg_nte", "min_days_between",
          "repeat_count_30d", "tracking_numbers", "sample_descs_raw", "asset_counts_str"]


def repeat_pairs_30d(s: DataFrame, w: DataFrame, as_of, lookback_months: int = 3, repeat_days: int = 30,
                     min_repeats: int = 2, excluded_types=EXCLUDED_PROBLEM_TYPES,
                     trade_prefix: str = FM_TRADE_PREFIX, lookback_pad_days: int = 0,
                     keep_arrays: bool = False, sort: bool = True, w_unique: bool = False,
                     n_tracking: int = N_TRACKING, n_descs: int = N_DESCRIPTIONS, n_assets: int = N_ASSETS,
                     description_chars: int | None = DESCRIPTION_CHARS, measures: DataFrame | None = None,
                     survivors: DataFrame | None = None) -> DataFrame:
    """Store + problem groups with at least ``min_repeats`` repeats within ``repeat_days``.

    ``problem_code_desc`` is output as ``NULLIF(code_key, '')``.  With
    ``keep_arrays`` the native arrays ``assets`` and ``recent`` are kept next to
    their strings.  ``measures`` and ``survivors`` may be the written results of
    :func:`group_measures` and :func:`surviving_rows` for the same parameters.
    """
    orders = work_orders(s, as_of, lookback_months, excluded_types, trade_prefix, lookback_pad_days)
    m = measures if measures is not None else group_measures(orders, repeat_days, min_repeats)
    of_keys = survivors if survivors is not None else surviving_rows(orders, m)
    of_groups = of_keys.filter(F.col("gk").isNotNull())
    # Every group has these rows; LEFT lets a branch that is not read be pruned.
    out = m.join(organisation(of_groups, w, w_unique), "gk", "left") \
        .join(recent(of_groups, n_tracking, n_descs, description_chars), "gk", "left")
    out = out.select("*", *[F.col("gk")[c].alias(c) for c in GROUP]).drop("gk")
    out = out.join(asset_counts(of_keys, n_assets), KEY, "left")
    out = out.withColumns({
        "problem_code_desc": F.nullif(F.col("code_key"), F.lit("")),
        "tracking_numbers": join_field("recent", "tracking_nbr", ",", n_tracking),
        "sample_descs_raw": join_field("recent", "description", ",", n_descs)})
    out = out.select(*OUTPUT, *(["assets", "recent"] if keep_arrays else []))
    if sort:
        out = out.orderBy(F.col("repeat_count_30d").desc(), F.col("total_nte").desc(),
                          *[F.col(c).asc_nulls_first() for c in
                            ["store_nbr", "problem_type_desc", "problem_code_desc", "sc_trade_name",
                             "category_name"]])
    return out


def in_two_reads(write, s: DataFrame, w: DataFrame, as_of, lookback_months: int = 3, repeat_days: int = 30,
                 min_repeats: int = 2, excluded_types=EXCLUDED_PROBLEM_TYPES, trade_prefix: str = FM_TRADE_PREFIX,
                 lookback_pad_days: int = 0, rows: bool = True, **kw) -> DataFrame:
    """:func:`repeat_pairs_30d` with the measures and the surviving rows written first.

    ``write(df, name)`` writes a table and reads it again (``session.written``).  Unlike
    the lazy form this runs two jobs when called; S is read once in each.  A caller
    that reads neither lists nor assets leaves the rows out (``rows=False``).
    """
    orders = work_orders(s, as_of, lookback_months, excluded_types, trade_prefix, lookback_pad_days)
    measures = write(group_measures(orders, repeat_days, min_repeats), "repeat-measures")
    survivors = write(surviving_rows(orders, measures), "repeat-rows") if rows else None
    return repeat_pairs_30d(s, w, as_of, lookback_months, repeat_days, min_repeats, excluded_types, trade_prefix,
                            lookback_pad_days, measures=measures, survivors=survivors, **kw)
