"""The dashboard's interactive views (§2.11) as DataFrame operators.

Each one is a lazy DataFrame over the whole results: global
results are aggregates (partial + final), per-entity results are group-bys,
and "first seen" / "top" picks use ``min_by`` with an explicit total order
instead of insertion order.  Filters are ``dict[str, str]``; empty values do
not filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recurwork.functions.exprs import (UNASSIGNED, any_column_contains, blank_to_null, contains_text,
                                       either_equals, falsy_default, first_non_empty, optional_equalities,
                                       shorten,
                                       strip_first, strip_label_prefixes, unassigned_prefix)
from recurwork.functions.measures import (band_above, band_at_least, code_if_distinct, gap_score,
                                          pair_severity, pct, rate_pct, urgency_band)
from recurwork.operators.ordering import Key, cursor_page, page, sort_by_field, top_k
from recurwork.plans import reports
from recurwork.sources.files import ROW

# Label prefixes, and the bounds of the bands.
LABEL_PREFIXES = ("FM - ", "PM - ")
RATE_BAND, PRIORITY_BAND, GAP_BAND, STORE_BAND = (30, 15), (60, 30), (60, 30), (20, 10)

ORG_FILTERS = ("sr", "dir", "rm", "fsm")
FACET_FIELDS = ("sr", "dir", "rm", "fsm", "prob")


def _money_sum(c) -> Column:
    """Order-independent money sum: add as DECIMAL(18,2), report as DOUBLE."""
    return F.sum(F.col(c).cast("decimal(18,2)")).cast("double")


def _detail_order() -> list[Column]:
    """Order of the repeat groups: 30-day repeats, then money, then the group key."""
    return [F.col("r30").desc(), F.col("nte").desc(), F.col("sn").asc(), F.col("prob").asc(),
            F.col("pcd").asc_nulls_first(), F.col("trade").asc_nulls_first(), F.col("cat").asc_nulls_first()]


def _first_seen(value: Column) -> Column:
    """``value`` of the first group in detail order (min_by over a total order)."""
    order = F.struct((-F.col("r30")).alias("a"), (-F.col("nte")).alias("b"), F.col("prob").alias("c"),
                     F.coalesce("pcd", F.lit("")).alias("d"), F.coalesce("trade", F.lit("")).alias("e"),
                     F.coalesce("cat", F.lit("")).alias("f"))
    return F.min_by(value, order)


# ── V2: compact record ─────────────────────────────────────────────────────

def repeat_groups(pairs: DataFrame) -> DataFrame:
    """One compact row per repeat group; empty organisation levels read 'Unassigned'."""
    return pairs.select(
        F.col("store_nbr").alias("sn"), F.col("problem_type_desc").alias("prob"),
        F.col("problem_code_desc").alias("pcd"), F.col("sc_trade_name").alias("trade"),
        F.col("category_name").alias("cat"), F.col("completion_count").alias("cnt"),
        F.col("first_completion").alias("fc"), F.col("last_completion").alias("lc"),
        F.col("total_nte").alias("nte"), F.col("avg_nte").alias("avgnte"),
        F.col("min_days_between").alias("mindays"), F.col("repeat_count_30d").alias("r30"),
        falsy_default("sr_director").alias("sr"), falsy_default("fm_director").alias("dir"),
        falsy_default("regional_mgr").alias("rm"), falsy_default("fs_mgr").alias("fsm"),
        F.lit("").alias("mkt"), F.col("tracking_numbers").alias("tnums"),
        F.col("sample_descs_raw").alias("descs"), F.col("asset_counts_str").alias("assets"),
    )


# ── V3–V5: unfiltered roll-ups ─────────────────────────────────────────────

PROBLEM_SORT = ("problem", "total_wos", "repeat_count", "affected_stores", "rate")
STORE_ROLLUP_SORT = ("store", "director", "region", "repeat_incidents", "total_nte")
STORE_FILTERED_SORT = ("store", "sr", "dir", "rm", "fsm", "repeat_groups")


def _chosen(out: DataFrame, field: str, descending: bool, allowed, tie: str) -> DataFrame:
    """T4 over a roll-up; ties by its key."""
    return sort_by_field(out, field, descending, {c: c for c in allowed}, [F.col(tie).asc()])


def by_problem(groups: DataFrame, sort_field: str = "repeat_count", descending: bool = True) -> DataFrame:
    """Per problem type: completions, 30-day repeats, stores, repeat rate (M7)."""
    out = groups.groupBy(F.col("prob").alias("problem")).agg(
        F.sum("cnt").alias("total_wos"), F.sum("r30").alias("repeat_count"),
        F.countDistinct("sn").alias("affected_stores"))
    out = out.withColumn("rate", rate_pct("repeat_count", "total_wos"))
    out = out.withColumn("rate_band", band_above("rate", *RATE_BAND))
    return _chosen(out, sort_field, descending, PROBLEM_SORT, "problem")


def by_store(groups: DataFrame, sort_field: str = "repeat_incidents", descending: bool = True) -> DataFrame:
    """Per store: 30-day repeat incidents, money, first-seen director / region, problem list."""
    out = groups.groupBy(F.col("sn").alias("store")).agg(
        _first_seen(F.col("dir")).alias("director"),
        _first_seen(F.col("rm")).alias("region"),
        F.sum("r30").alias("repeat_incidents"),
        _money_sum("nte").alias("total_nte"),
        F.array_join(F.array_sort(F.collect_set("prob")), ", ").alias("problems"),
    )
    return _chosen(out, sort_field, descending, STORE_ROLLUP_SORT, "store")


def _director_view(groups: DataFrame, measure: Column, measure_name: str, sort_field: str | None, descending: bool) -> DataFrame:
    """Per director: distinct stores, Σ measure, problem type with the largest Σ measure.

    One pass over the groups: each row plays a problem role and a store role;
    one aggregate over (director, role, key) combines map-side, a second one
    per director folds it — no join, and the groups are read once.
    """
    d = F.coalesce(F.nullif(F.col("dir"), F.lit("")), F.lit(UNASSIGNED)).alias("director")
    roles = F.array(F.struct(F.lit("p").alias("role"), F.col("prob").cast("string").alias("key"), measure.alias("m")),
                    F.struct(F.lit("s").alias("role"), F.col("sn").cast("string").alias("key"), measure.alias("m")))
    lvl = groups.select(d, F.explode(roles).alias("x")).select("director", "x.*") \
        .groupBy("director", "role", "key").agg(F.sum("m").alias("n"))
    is_p = F.col("role") == "p"
    out = lvl.groupBy("director").agg(
        F.count(F.when(F.col("role") == "s", F.lit(1))).alias("store_count"),
        F.sum(F.when(is_p, F.col("n"))).alias(measure_name),
        F.min_by("key", F.when(is_p, F.struct((-F.col("n")).alias("n"), F.col("key").alias("p")))).alias("top_problem"))
    out = out.withColumn("top_problem", F.coalesce("top_problem", F.lit("N/A")))
    return _chosen(out, sort_field or measure_name, descending, ("director", "store_count", measure_name, "top_problem"), "director")


def by_director(groups: DataFrame, sort_field: str | None = None, descending: bool = True) -> DataFrame:
    """Per director: stores, Σ 30-day repeats, problem type with the most repeats (ties: name)."""
    return _director_view(groups, F.col("r30"), "repeat_incidents", sort_field, descending)


# ── V6–V9: the filtered repeat views ───────────────────────────────────────

def _gate(filters: dict | None, require_org_filter: bool) -> bool:
    """P15 — with no organisation filter the views stay empty."""
    return require_org_filter and not any((filters or {}).get(k) for k in ORG_FILTERS)


def filter_groups(groups: DataFrame, filters: dict | None, require_org_filter: bool = True) -> DataFrame:
    if _gate(filters, require_org_filter):
        return groups.filter(F.lit(False))
    f = {k: v for k, v in (filters or {}).items() if k in FACET_FIELDS}
    return groups.filter(optional_equalities(f))


DETAIL_SORT = {"store": "sn", "cnt": "cnt", "r30": "r30", "nte": "nte", "lc": "lc"}


def repeat_detail_view(groups: DataFrame, filters: dict | None = None, require_org_filter: bool = True,
                       sort_field: str = "r30", descending: bool = True) -> DataFrame:
    """V6 — the filtered groups, sorted by a chosen field (ties: detail order)."""
    f = filter_groups(groups, filters, require_org_filter)
    f = f.select("*", code_if_distinct("pcd", "prob").alias("pcd_display"),
                 pair_severity("r30", two_levels=True).alias("severity"))
    return sort_by_field(f, sort_field, descending, DETAIL_SORT, _detail_order())


def detail_order(sort_field: str = "r30", descending: bool = True) -> list[Key]:
    """The total order of the repeat groups under a chosen sort."""
    if sort_field not in DETAIL_SORT:
        raise ValueError(f"unknown sort field {sort_field!r}; allowed: {sorted(DETAIL_SORT)}")
    keys = [Key(DETAIL_SORT[sort_field], descending), Key("r30", True), Key("nte", True), *[Key(c) for c in ("sn", "prob", "pcd", "trade", "cat")]]
    return [k for i, k in enumerate(keys) if k.name not in {x.name for x in keys[:i]}]


def detail_page(groups: DataFrame, filters: dict | None = None, require_org_filter: bool = True, size: int = 50,
                after: tuple | None = None, before: tuple | None = None, sort_field: str = "r30", descending: bool = True) -> DataFrame:
    """V6 by cursor."""
    order = detail_order(sort_field, descending)
    f = filter_groups(groups, filters, require_org_filter)
    f = f.select("*", code_if_distinct("pcd", "prob").alias("pcd_display"), pair_severity("r30", two_levels=True).alias("severity"))
    return cursor_page(f, order, size, after, before)


def filtered_kpis(groups: DataFrame, filters: dict | None = None, require_org_filter: bool = True) -> DataFrame:
    """V7 — pairs, Σ 30-day repeats, stores and problem types under the filters (one row)."""
    gated = _gate(filters, require_org_filter)
    f = filter_groups(groups, filters, False)
    out = f.agg(F.count(F.lit(1)).alias("pairs"), F.coalesce(F.sum("r30"), F.lit(0)).cast("bigint").alias("repeat_incidents"),
                F.countDistinct("sn").alias("stores"), F.countDistinct("prob").alias("problems"))
    return out.filter(F.lit(not gated))


def by_store_filtered(groups: DataFrame, filters: dict | None = None, require_org_filter: bool = True,
                      sort_field: str = "repeat_groups", descending: bool = True) -> DataFrame:
    """V7b — per store under the filters; the measure is the number of groups."""
    f = filter_groups(groups, filters, require_org_filter)
    out = f.groupBy(F.col("sn").alias("store")).agg(
        _first_seen(F.col("sr")).alias("sr"), _first_seen(F.col("dir")).alias("dir"),
        _first_seen(F.col("rm")).alias("rm"), _first_seen(F.col("fsm")).alias("fsm"),
        F.count(F.lit(1)).alias("repeat_groups"),
        F.array_join(F.array_sort(F.collect_set("prob")), ", ").alias("problems"))
    return _chosen(out, sort_field, descending, STORE_FILTERED_SORT, "store")


def by_director_filtered(groups: DataFrame, filters: dict | None = None, require_org_filter: bool = True,
                         sort_field: str | None = None, descending: bool = True) -> DataFrame:
    """V7b — per director under the filters; the measure is the number of groups."""
    f = filter_groups(groups, filters, require_org_filter)
    return _director_view(f, F.lit(1).cast("bigint"), "repeat_groups", sort_field, descending)


def by_problem_filtered(groups: DataFrame, filters: dict | None = None, require_org_filter: bool = True,
                        sort_field: str = "repeat_count", descending: bool = True) -> DataFrame:
    """V7c — unfiltered per-problem rows whose problem occurs under the filters (J6).

    The semi-join is a flag of the same aggregate, so the groups are read once.
    """
    f = {k: v for k, v in (filters or {}).items() if k in FACET_FIELDS}
    hit = F.lit(False) if _gate(filters, require_org_filter) else optional_equalities(f)
    out = groups.groupBy(F.col("prob").alias("problem")).agg(
        F.sum("cnt").alias("total_wos"), F.sum("r30").alias("repeat_count"),
        F.countDistinct("sn").alias("affected_stores"), F.max(hit).alias("_hit")).filter("_hit").drop("_hit")
    out = out.withColumn("rate", rate_pct("repeat_count", "total_wos"))
    out = out.withColumn("rate_band", band_above("rate", *RATE_BAND))
    return _chosen(out, sort_field, descending, PROBLEM_SORT, "problem")


def by_problem_on_filtered(groups: DataFrame, filters: dict | None = None,
                           require_org_filter: bool = True) -> DataFrame:
    """V3 recomputed on the filtered groups (the survey's default for V7c; see
    :func:`by_problem_filtered` for the reference's unfiltered totals)."""
    return by_problem(filter_groups(groups, filters, require_org_filter))


def facets(groups: DataFrame, filters: dict | None = None, fields=FACET_FIELDS) -> DataFrame:
    """V8 — per filter field, the distinct non-empty values under all *other* filters.

    One pass: each row emits (field, value, passes-the-other-filters) for every
    field, the array is exploded and filtered, and a distinct (partial
    aggregation) removes repeats.  The current selection is always listed.
    Values starting with 'Unassigned' read 'Unassigned'.
    """
    sel = {k: v for k, v in (filters or {}).items() if v and k in fields}
    items = []
    for f in fields:
        others = optional_equalities({k: v for k, v in sel.items() if k != f})
        items.append(F.struct(F.lit(f).alias("field"), unassigned_prefix(F.col(f)).alias("value"),
                              others.alias("ok")))
        if f in sel:  # the selection stays in its list
            items.append(F.struct(F.lit(f).alias("field"), F.lit(sel[f]).alias("value"), F.lit(True).alias("ok")))
    e = groups.select(F.explode(F.array(*items)).alias("x")).select("x.*")
    out = e.filter(F.col("ok") & F.col("value").isNotNull() & (F.col("value") != "")) \
        .select("field", "value").distinct()
    return out.orderBy("field", "value")


def store_slice(groups: DataFrame, store: int, filters: dict | None = None) -> DataFrame:
    """V9 — the groups of one store under the filters, by 30-day repeats."""
    f = {k: v for k, v in (filters or {}).items() if k in FACET_FIELDS}
    rows = groups.filter((F.col("sn") == F.lit(store)) & optional_equalities(f))
    rows = rows.select("*", code_if_distinct("pcd", "prob").alias("pcd_display"),
                       pair_severity("r30").alias("severity"))
    return rows.orderBy(*_detail_order())


def store_slice_summary(groups: DataFrame, store: int, filters: dict | None = None) -> DataFrame:
    """V9 — one store's pair count, Σ 30-day repeats, Σ money and first director / region."""
    rows = store_slice(groups, store, filters)
    return rows.agg(F.count(F.lit(1)).alias("pairs"),
                    F.coalesce(F.sum("r30"), F.lit(0)).cast("bigint").alias("repeat_incidents"),
                    F.coalesce(_money_sum("nte"), F.lit(0.0)).alias("total_nte"),
                    _first_seen(F.col("dir")).alias("director"), _first_seen(F.col("rm")).alias("region"))


# ── V1, V11–V17: overview, trade, store and trend views ─────────────────────

def kpi_overview(r: DataFrame, as_of, lookback_days: int = 365, min_count: int = 3) -> DataFrame:
    """V1 — one row: repeats, 90-day repeats, stores, top trade, top code, 90-day share (M9).

    Computed from R in one scan, with the total and the stores of the top trade.
    """
    # One scan of R: every row plays up to three roles — its
    # (trade, store), its (trade, code), and its store when it is a 90-day repeat — and one
    # aggregate over (role, key) with map-side combining feeds the fold.
    base = reports.recent(r, as_of, lookback_days)
    trade, m3 = F.col("sc_trade_name"), F.col("month3_flag")

    def role(cond, kind, k1, k2, r90):
        return F.when(cond, F.struct(F.lit(kind).alias("kind"), k1.cast("string").alias("k1"),
                                     k2.cast("string").alias("k2"), r90.cast("int").alias("r90")))

    items = F.array(role(trade.isNotNull(), "t", trade, F.col("store_nbr"), m3),
                    role(trade.isNotNull(), "c", trade, F.coalesce("problem_code_desc", F.lit("Unknown")), m3),
                    role(m3 == 1, "s", F.col("store_nbr"), F.lit(None), F.lit(0)))
    g = base.select(F.explode(items).alias("x")).filter(F.col("x").isNotNull()).select("x.*") \
        .groupBy("kind", "k1", "k2").agg(F.count(F.lit(1)).alias("n"), F.sum("r90").alias("r90"))
    # the stores of a trade are folded into its row
    g = g.groupBy("kind", "k1", F.when(F.col("kind") != "t", F.col("k2")).alias("k2")).agg(
        F.sum("n").alias("n"), F.sum("r90").alias("r90"), F.count("k2").alias("stores"))
    is_t, is_c = F.col("kind") == "t", (F.col("kind") == "c") & (F.col("n") >= min_count)
    t_order = F.when(is_t, F.struct((-F.col("n")).alias("a"), F.col("k1").alias("b")))
    c_order = F.when(is_c, F.struct((-F.col("n")).alias("a"), F.col("k1").alias("b"), F.col("k2").alias("c")))
    out = g.agg(
        F.coalesce(F.sum(F.when(is_t, F.col("n"))), F.lit(0)).cast("bigint").alias("total_repeats"),
        F.coalesce(F.sum(F.when(is_t, F.col("r90"))), F.lit(0)).cast("bigint").alias("repeats_90d"),
        F.count(F.when(F.col("kind") == "s", F.lit(1))).alias("stores_affected"),
        F.min_by("k1", t_order).alias("top_trade"),
        F.min_by("n", t_order).alias("top_trade_repeats"),
        F.min_by("stores", t_order).alias("top_trade_stores"),
        F.min_by("k1", c_order).alias("top_code_trade"),
        F.min_by("k2", c_order).alias("top_code"),
        F.min_by("n", c_order).alias("top_code_count"),
    )
    return _kpi_tail(out)


def _kpi_tail(out: DataFrame) -> DataFrame:
    return out.select("*", pct("repeats_90d", "total_repeats").alias("pct_90d"),
                      F.coalesce(strip_first("top_trade", "FM - "), F.lit("N/A")).alias("top_trade_label"))


def trade_bands(by_trade: DataFrame, k: int | None = None) -> DataFrame:
    """V11 — M1 per trade: 0–90, 91–180 and 181–365 day bands (from cumulative counts); the first ``k`` trades, or all."""
    out = by_trade.select(
        "trade", strip_label_prefixes("trade", LABEL_PREFIXES).alias("label"), "total_repeats",
        F.col("repeats_90d").alias("band_0_90"),
        (F.col("repeats_180d") - F.col("repeats_90d")).alias("band_91_180"),
        (F.col("repeats_365d") - F.col("repeats_180d")).alias("band_181_365"),
    )
    return top_k(out, [F.col("total_repeats").desc(), F.col("trade").asc()], k)


def trade_band_totals(by_trade: DataFrame) -> DataFrame:
    """V11 — the three bands summed over trades, with each band's share (one row)."""
    t = by_trade.agg(
        F.coalesce(F.sum("repeats_90d"), F.lit(0)).cast("bigint").alias("band_0_90"),
        F.coalesce(F.sum(F.col("repeats_180d") - F.col("repeats_90d")), F.lit(0)).cast("bigint").alias("band_91_180"),
        F.coalesce(F.sum(F.col("repeats_365d") - F.col("repeats_180d")), F.lit(0)).cast("bigint").alias("band_181_365"))
    total = F.col("band_0_90") + F.col("band_91_180") + F.col("band_181_365")
    return t.select("*", pct("band_0_90", total).alias("pct_0_90"), pct("band_91_180", total).alias("pct_91_180"),
                    pct("band_181_365", total).alias("pct_181_365"))


def trade_codes(codes: DataFrame, trade: str | None = None, first: int | None = None) -> DataFrame:
    """V12 — codes of one trade, or of all, with the 90-day share and priority (M4); the ``first`` of them if asked."""
    base = codes.filter(F.col("trade") == F.lit(trade)) if trade else codes
    base = base.withColumn("label", strip_label_prefixes("trade", LABEL_PREFIXES))
    base = base.withColumn("pct_90d", pct("within_90d", "repeat_count"))
    base = base.withColumn("priority", band_at_least("pct_90d", *PRIORITY_BAND))
    return top_k(base, [F.col("repeat_count").desc(), F.col("trade").asc(), F.col("problem_code").asc()], first)


def trade_summary(by_trade: DataFrame) -> DataFrame:
    """V13 — every trade with its counts, gap score (M2) and band (M3)."""
    s = gap_score("repeats_90d", "total_repeats")
    return by_trade.select("trade", strip_label_prefixes("trade", LABEL_PREFIXES).alias("label"), "total_repeats",
                           "stores_affected", "assets_affected", "repeats_90d", "repeats_180d", "repeats_365d",
                           s.alias("gap_score"), band_at_least(s, *GAP_BAND).alias("gap_band"),
                           F.least(s, F.lit(100)).alias("bar_width")) \
        .orderBy(F.col("total_repeats").desc(), F.col("trade").asc())


def options(df: DataFrame, column: str) -> DataFrame:
    """A drop-down list: the distinct values of a column with their labels, sorted; no blanks."""
    return df.select(F.col(column).alias("value")).filter((F.col("value") != "") & F.col("value").isNotNull()).distinct() \
        .select("value", strip_label_prefixes("value", LABEL_PREFIXES).alias("label")).orderBy("value")


def trade_chart(by_trade: DataFrame, k: int) -> DataFrame:
    """T5 + M1 — the first ``k`` trades with the 0–90 and 91–180 day bands (overview chart)."""
    out = by_trade.select("trade", strip_label_prefixes("trade").alias("label"), "total_repeats",
                          F.col("repeats_90d").alias("band_0_90"),
                          (F.col("repeats_180d") - F.col("repeats_90d")).alias("band_91_180"))
    return top_k(out, [F.col("total_repeats").desc(), F.col("trade").asc()], k)


def problem_chart(codes: DataFrame, k: int, width: int = 28) -> DataFrame:
    """T5 — the first ``k`` problem codes with a label cut to ``width`` characters."""
    out = codes.select("trade", "problem_code", shorten("problem_code", width).alias("label"), "repeat_count")
    return top_k(out, [F.col("repeat_count").desc(), F.col("trade").asc(), F.col("problem_code").asc()], k)


def trade_badges(n: int = 3) -> Column:
    """The first ``n`` entries of ``top_trades``, trimmed, without their prefixes."""
    parts = F.filter(F.transform(F.split(F.coalesce("top_trades", F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.array_join(F.transform(F.slice(parts, 1, n), lambda x: strip_label_prefixes(x, LABEL_PREFIXES)), ", ").alias("trade_badges")


def top_stores(hotspots: DataFrame, k: int, badges: int = 3) -> DataFrame:
    """T5 — the first ``k`` hotspot stores: director, number of trades, first trades as badges."""
    out = hotspots.select("store_nbr", "city", "state", first_non_empty("fm_director", "sr_director").alias("director"),
                          "total_repeats", "trades_affected", "repeats_90d", trade_badges(badges))
    return top_k(out, [F.col("total_repeats").desc(), F.col("store_nbr").asc()], k)


STORE_SEARCH = ["store_nbr", "city", "state", "fm_director", "sr_director", "banner"]
STORE_SORT = ("total_repeats", "repeats_90d", "repeats_180d", "trades_affected")


def store_filtered(hotspots: DataFrame, q: str = "", state: str = "") -> DataFrame:
    f = hotspots.filter(F.col("state") == F.lit(state)) if state else hotspots
    return f.filter(contains_text(STORE_SEARCH, q))


def store_order(sort_key: str = "total_repeats") -> list[Key]:
    if sort_key not in STORE_SORT:
        raise ValueError(f"sort_key must be one of {STORE_SORT}")
    return [Key(sort_key, True), *([Key("total_repeats", True)] if sort_key != "total_repeats" else []), Key("store_nbr")]


def store_rows(hotspots: DataFrame, q: str = "", state: str = "") -> DataFrame:
    """V14 unpaged — search and state filter; adds the first trades and the severity (M6)."""
    return store_filtered(hotspots, q, state).select("*", trade_badges(), band_above("repeats_90d", *STORE_BAND).alias("severity"))


def store_list(hotspots: DataFrame, q: str = "", state: str = "", sort_key: str = "total_repeats",
               page_no: int = 0, size: int = 50) -> DataFrame:
    """V14 — search, state filter, sort by a measure (desc), severity (M6), one page."""
    f = store_rows(hotspots, q, state).orderBy(*[k.column() for k in store_order(sort_key)])
    return page(f, page_no, size)


def store_page(hotspots: DataFrame, size: int = 50, after: tuple | None = None, before: tuple | None = None,
               q: str = "", state: str = "", sort_key: str = "total_repeats") -> DataFrame:
    """V14 by cursor."""
    return cursor_page(store_rows(hotspots, q, state), store_order(sort_key), size, after, before)


def store_chart(hotspots: DataFrame, q: str = "", state: str = "", sort_key: str = "total_repeats",
                k: int | None = None) -> DataFrame:
    """T5 — the first ``k`` stores of the store list, labelled '#store city', with 90-day repeats."""
    if sort_key not in STORE_SORT:
        raise ValueError(f"sort_key must be one of {STORE_SORT}")
    f = store_filtered(hotspots, q, state).select(
        "store_nbr", F.concat(F.lit("#"), F.col("store_nbr").cast("string"), F.lit(" "),
                              F.coalesce("city", F.lit(""))).alias("label"),
        "repeats_90d", F.col(sort_key).alias("_k"), F.col("total_repeats").alias("_t"))
    out = top_k(f, [F.col("_k").desc(), F.col("_t").desc(), F.col("store_nbr").asc()], k)
    return out.drop("_k", "_t")


def store_count(hotspots: DataFrame, q: str = "", state: str = "") -> DataFrame:
    return store_filtered(hotspots, q, state).agg(F.count(F.lit(1)).alias("stores"))


def month_totals(trend: DataFrame) -> DataFrame:
    """V15 — repeats per month summed over trades (A17)."""
    return trend.groupBy("month").agg(F.sum("total_repeats").alias("total_repeats")).orderBy("month")


TREND_PARTS = 256


def _first_items(each: DataFrame, items: Column, k: int, *keys: Column) -> DataFrame:
    """Per key the months and the first ``k`` items of ``each``."""
    first = F.slice(F.array_sort(items, lambda a, b: F.when(a["rank"] != b["rank"], F.sign(a["rank"] - b["rank"]).cast("int"))
                                 .when(a["trade"] < b["trade"], -1).when(a["trade"] > b["trade"], 1).otherwise(0)), 1, k)
    return each.groupBy(*keys).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("months")))).alias("months"), first.alias("items"))


def top_trend_parts(trend: DataFrame, k: int) -> DataFrame:
    """The months and the first ``k`` trades of each of ``TREND_PARTS`` parts of the trades."""
    each = trend.groupBy("trade").agg(
        F.sum("total_repeats").alias("tot"), F.map_from_entries(F.collect_list(F.struct("month", "total_repeats"))).alias("by_month"))
    item = F.struct((-F.col("tot")).alias("rank"), "trade", "by_month")
    return _first_items(each.withColumn("months", F.map_keys("by_month")), F.collect_list(item), k,
                        F.pmod(F.xxhash64("trade"), F.lit(TREND_PARTS)).alias("part"))


def top_trend(trend: DataFrame, k: int = 5) -> DataFrame:
    """V16 — dense month × top-k-trade grid of repeats, 0 where a trade has no row.

    The trend is folded to a row per trade, these to the months and first ``k`` trades
    of each part, and those to one row, which holds no more than ``TREND_PARTS`` × k
    trades and is exploded into the grid: the trend is read once and nothing is joined.
    A trade has at most a value per month.
    """
    one = _first_items(top_trend_parts(trend, k), F.flatten(F.collect_list("items")), k)
    grid = one.select(F.explode("months").alias("month"), "items").select("month", F.explode("items").alias("x"))
    return grid.select("month", F.col("x.trade").alias("trade"), strip_label_prefixes(F.col("x.trade"), LABEL_PREFIXES).alias("label"),
                       F.coalesce(F.try_element_at("x.by_month", "month"), F.lit(0)).cast("bigint").alias("total_repeats"),
                       (-F.col("x.rank")).alias("trade_total")) \
        .orderBy("month", F.col("trade_total").desc(), "trade")


def trend_table(trend: DataFrame, trade: str | None = None, limit: int | None = None) -> DataFrame:
    """V17 — rows by month (latest first), optionally one trade; the first ``limit``, or all."""
    f = trend.filter(F.col("trade") == F.lit(trade)) if trade else trend
    f = f.withColumn("label", strip_label_prefixes("trade", LABEL_PREFIXES))
    return top_k(f, [F.col("month").desc(), F.col("total_repeats").desc(), F.col("trade").asc()], limit)


# ── V10: gap finder over the (enriched) detail ──────────────────────────────

GAP_SEARCH = ["store_nbr", "city", "state", "trade", "problem_code", "asset_tag", "tech_name", "provider",
              "fm_director"]
GAP_SORT_TEXT = ("call_date", "prev_call_date", "trade", "problem_code", "asset_tag", "city", "state",
                 "tech_name", "fm_director")
GAP_SORT_NUM = ("days_between", "store_nbr", "tracking_nbr")


def gap_columns() -> list:
    """The searched columns of a detail without a provider, for an index of it."""
    return [F.lit("") if c == "provider" else c for c in GAP_SEARCH]


def gap_filtered(detail: DataFrame, q: str = "", trade: str = "", state: str = "", director: str = "",
                 urgency: int = 0) -> DataFrame:
    d = detail.withColumn("provider", F.lit("")) if "provider" not in detail.columns else detail
    cond = F.lit(True)
    if trade:
        cond = cond & (F.col("trade") == F.lit(trade))
    if state:
        cond = cond & (F.col("state") == F.lit(state))
    if director:
        cond = cond & either_equals("fm_director", "sr_director", director)
    if urgency:
        cond = cond & (F.coalesce("days_between", F.lit(0)) <= F.lit(urgency))
    return d.filter(cond & contains_text(GAP_SEARCH, q)).drop("provider")


def gap_order(sort_key: str = "call_date", descending: bool = True) -> list[Key]:
    """The order of the gap finder: the chosen key, then the latest call, then the work order."""
    if sort_key not in GAP_SORT_NUM + GAP_SORT_TEXT:
        raise ValueError(f"unknown sort key {sort_key!r}")
    rest = [Key("call_date", True), Key("tracking_nbr", True)]
    return [Key("sort_value", descending), *rest]


def gap_rows(detail: DataFrame, q: str = "", trade: str = "", state: str = "", director: str = "",
             urgency: int = 0, sort_key: str = "call_date", descending: bool = True) -> DataFrame:
    """V10 unpaged — filter and search the enriched repeat detail; adds the urgency band (M5) and ``sort_value``."""
    gap_order(sort_key, descending)
    f = gap_filtered(detail, q, trade, state, director, urgency)
    if sort_key in GAP_SORT_NUM:
        key = F.coalesce(F.col(sort_key), F.lit(0)) if sort_key == "days_between" else F.col(sort_key)
    else:
        key = F.coalesce(F.col(sort_key).cast("string"), F.lit(""))
    return f.withColumns({"urgency": urgency_band("days_between"), "sort_value": key})


def gap_finder(detail: DataFrame, q: str = "", trade: str = "", state: str = "", director: str = "",
               urgency: int = 0, sort_key: str = "call_date", descending: bool = True,
               page_no: int = 0, size: int = 50) -> DataFrame:
    """V10 — filter, search, sort and page the enriched repeat detail; adds the urgency band (M5)."""
    f = gap_rows(detail, q, trade, state, director, urgency, sort_key, descending)
    f = f.orderBy(*[k.column() for k in gap_order(sort_key, descending)]).drop("sort_value")
    return page(f, page_no, size)


def gap_page(detail: DataFrame, size: int = 50, after: tuple | None = None, before: tuple | None = None, **chosen) -> DataFrame:
    """V10 by cursor: the rows behind ``after`` or just before ``before``, with ``sort_value`` (see ``ordering.cursor``).

    ``chosen`` are the filters, search and sort of :func:`gap_rows`.
    """
    order = gap_order(**{k: v for k, v in chosen.items() if k in ("sort_key", "descending")})
    return cursor_page(gap_rows(detail, **chosen), order, size, after, before)


def gap_count(detail: DataFrame, **filters) -> DataFrame:
    return gap_filtered(detail, **filters).agg(F.count(F.lit(1)).alias("repeat_wos"))


# ── V18–V20 ─────────────────────────────────────────────────────────────────

def extract_order(extract: DataFrame) -> list[Key]:
    """All columns, and the row number where the extract has one (``files.ingest_extract``)."""
    return [Key(c) for c in [c for c in extract.columns if c != ROW] + [c for c in extract.columns if c == ROW]]


def extract_search(extract: DataFrame, q: str = "", page_no: int = 0, size: int = 100) -> DataFrame:
    """V18 — any-column search over an extract whose columns are known only at run time, one page.

    Rows are ordered by all columns so that pages are stable.
    """
    if not extract.columns:  # an empty file has no header
        return extract
    f = extract.filter(any_column_contains([c for c in extract.columns if c != ROW], q))
    return page(f.orderBy(*[k.column() for k in extract_order(extract)]), page_no, size)


def extract_page(extract: DataFrame, q: str = "", size: int = 100, after: tuple | None = None, before: tuple | None = None) -> DataFrame:
    """V18 by cursor, over an extract with row numbers."""
    if ROW not in extract.columns:
        raise ValueError("equal rows cannot be told apart: ingest the extract first")
    f = extract.filter(any_column_contains([c for c in extract.columns if c != ROW], q))
    return cursor_page(f, extract_order(extract), size, after, before)


def asset_counts_exploded(pairs: DataFrame) -> DataFrame:
    """V19 — one row per (group, asset) from the native asset array of ``repeat_pairs_30d``."""
    keys = ["store_nbr", "problem_type_desc", "problem_code_desc", "sc_trade_name", "category_name"]
    return pairs.select(*keys, F.explode("assets").alias("a")).select(*keys, "a.*")


def recent_work_orders(pairs: DataFrame) -> DataFrame:
    """F16 — the tracking numbers and descriptions of each group back to rows, from the native array of ``repeat_pairs_30d``."""
    keys = ["store_nbr", "problem_type_desc", "problem_code_desc", "sc_trade_name", "category_name"]
    rows = pairs.select(*keys, F.explode("recent").alias("x")).select(*keys, "x.*")
    return rows.withColumn("description", F.trim("description")).filter(F.trim("tracking_nbr") != "")


def asset_counts_from_text(pairs: DataFrame) -> DataFrame:
    """V19 on the export form: parse 'desc~tag~count,..' back to rows.

    The reader's rules: split on ',' then '~', trim each part, skip entries
    with an empty name, an empty tag is no tag, the count is an integer (0 if
    absent).  Equals :func:`asset_counts_exploded` when names hold no ',' / '~'.
    """
    keys = ["store_nbr", "problem_type_desc", "problem_code_desc", "sc_trade_name", "category_name"]
    items = F.split(F.trim(F.coalesce("asset_counts_str", F.lit(""))), ",")
    e = pairs.select(*keys, F.posexplode(items).alias("pos", "item"))
    parts = F.split("item", "~")
    e = e.select(*keys, "pos", F.trim(F.get(parts, 0)).alias("equipment_desc"),
                 blank_to_null(F.get(parts, 1)).alias("equipment_tagid"),
                 F.coalesce(F.trim(F.get(parts, 2)).try_cast("bigint"), F.lit(0).cast("bigint")).alias("wo_count"))
    e = e.filter(F.col("equipment_desc").isNotNull() & (F.col("equipment_desc") != ""))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("pos"))
    return e.select(*keys, rank.alias("rank"), "equipment_desc", "equipment_tagid", "wo_count")


def gap_filter_options(detail: DataFrame) -> DataFrame:
    """The gap finder's drop-down lists: (field, value, label) sorted.

    Trades are labelled without their 'FM - ' / 'PM - ' prefix; the director
    list takes the first non-empty of fm_director and sr_director.
    """
    items = F.array(
        F.struct(F.lit("trade").alias("field"), F.col("trade").alias("value"),
                 strip_label_prefixes("trade", LABEL_PREFIXES).alias("label")),
        F.struct(F.lit("state").alias("field"), F.col("state").alias("value"), F.col("state").alias("label")),
        F.struct(F.lit("director").alias("field"), first_non_empty("fm_director", "sr_director").alias("value"),
                 first_non_empty("fm_director", "sr_director").alias("label")))
    e = detail.select(F.explode(items).alias("x")).select("x.*")
    return e.filter(F.col("value").isNotNull() & (F.col("value") != "")).distinct().orderBy("field", "value")


def name_search(groups: DataFrame, q: str, limit: int | None = None) -> DataFrame:
    """V20 — type-ahead over the four organisation levels: distinct (level, name) containing q; the first ``limit``, or all."""
    items = F.array(*[F.struct(F.lit(k).alias("level"), F.col(k).alias("name")) for k in ORG_FILTERS])
    e = groups.select(F.explode(items).alias("x")).select("x.*")
    out = e.filter(F.col("name").isNotNull() & (F.col("name") != "") &
                   (F.instr(F.lower("name"), (q or "").lower()) > 0)).distinct()
    return top_k(out, [F.col("level").asc(), F.col("name").asc()], limit)
