"""Registry of the queries run by the driver: key -> (spark, sf_dir) -> DataFrame.

Parameters are fixed here; the fixture inputs are rebuilt from the driver
tables of ``sf_dir`` on every call (all lazy).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recurwork.operators import repeats
from recurwork.operators.lag import previous_date
from recurwork.plans import reports, selection, trend_sets, views
from recurwork.session import checkpoint_dir, written
from recurwork.sources import text_index
from recurwork.sources.fixtures import AS_OF, fx_recurring, fx_workorder_dim, fx_workorders

# The fixture history spans 1995-01 .. 2001-08; 100 months reaches all of it,
# so the views run over the whole table; 3 months is the production default.
PAIRS_LOOKBACK_MONTHS = 100


def _r(spark, d):
    return fx_recurring(spark, d)


def _w(spark, d):
    return fx_workorder_dim(spark, d)


def q_repeats_by_trade(spark: SparkSession, d: str) -> DataFrame:
    return reports.repeats_by_trade(_r(spark, d), AS_OF)


def q_problem_codes(spark: SparkSession, d: str) -> DataFrame:
    return reports.problem_codes(_r(spark, d), AS_OF)


def q_store_hotspots(spark: SparkSession, d: str) -> DataFrame:
    return reports.store_hotspots(_r(spark, d), _w(spark, d), AS_OF)


def q_monthly_trend(spark: SparkSession, d: str) -> DataFrame:
    return reports.monthly_trend(_r(spark, d), AS_OF)


def q_repeat_detail(spark: SparkSession, d: str) -> DataFrame:
    return reports.repeat_detail(_r(spark, d), AS_OF)


def q_tech_repeats(spark: SparkSession, d: str) -> DataFrame:
    return reports.tech_repeats(_r(spark, d), _w(spark, d), AS_OF)


def _s(spark, d):
    return fx_workorders(spark, d)


def work_order_gaps(spark: SparkSession, d: str) -> DataFrame:
    """W1, W2 row by row: days since the previous work order of the same store, type and code."""
    orders = repeats.work_orders(_s(spark, d), AS_OF, PAIRS_LOOKBACK_MONTHS)
    rows = previous_date(orders, repeats.KEY, "completion_date", "tracking_nbr", "prev_completion")
    return rows.select(*repeats.KEY, "tracking_nbr", "completion_date", "prev_completion",
                       F.datediff("completion_date", "prev_completion").alias("days_since_prev"))


def pairs(spark: SparkSession, d: str, **kw) -> DataFrame:
    """The repeat pairs in two reads of S: the measures and surviving rows are written when this is called."""
    kw.setdefault("lookback_months", PAIRS_LOOKBACK_MONTHS)
    return repeats.in_two_reads(written, _s(spark, d), _w(spark, d), AS_OF, **kw)


def _groups(spark, d):
    """The groups for views that read no list and no asset: only the measures are written, and S is read a second time for W."""
    return views.repeat_groups(pairs(spark, d, sort=False, rows=False))


def _measured_groups(spark, d):
    """The groups for views that read measures only: lazy, as S is read once."""
    return views.repeat_groups(repeats.repeat_pairs_30d(_s(spark, d), _w(spark, d), AS_OF, PAIRS_LOOKBACK_MONTHS, sort=False))


def _whole_groups(spark, d):
    return views.repeat_groups(pairs(spark, d, sort=False))


# Fixed view parameters of the registered queries (values present in the fixtures).
ORG_FILTER = {"sr": "MIDDLE EAST"}
FACET_FILTER = {"sr": "MIDDLE EAST", "prob": "1-URGENT"}
SLICE_STORE = 3
GAP_FILTER = {"director": "ASIA", "urgency": 60}
GAP_SEARCH = {"q": "tech 1"}
SEARCH_PARTS = 16  # parts of a searchable table; text_index.parts_for gives the number for a table's size


def _trade(spark, d):
    return reports.repeats_by_trade(_r(spark, d), AS_OF)


def _trend(spark, d):
    # the views re-aggregate or re-sort the trend: its own ORDER BY would be wasted
    return reports.monthly_trend_groups(_r(spark, d), AS_OF)


def _hotspots(spark, d):
    return reports.store_hotspots(_r(spark, d), _w(spark, d), AS_OF)


def _codes(spark, d):
    return reports.problem_code_groups(_r(spark, d), AS_OF)  # the views sort it themselves


def _detail_enriched(spark, d):
    return reports.repeat_detail(_r(spark, d), AS_OF, w=_w(spark, d))


def _sets(spark, d):
    """The trend as sets, written when this is called, as the refresh does."""
    return written(trend_sets.trend_sets(_r(spark, d), AS_OF), "trend-sets")


def _index(spark, d):
    """The index of the groups, written when this is called, as the refresh does."""
    return written(selection.group_index(_groups(spark, d)), "group-index")


def _searchable(df: DataFrame, columns, cluster, q: str) -> DataFrame:
    """The rows of ``df`` that can hold ``q``, by an index that is written when this is called."""
    at = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/searchable-{uuid.uuid4().hex}"
    return text_index.narrowed(df.sparkSession, text_index.write_searchable(df, at, columns, SEARCH_PARTS, cluster), q)


def _gaps_with(spark, d, q):
    return _searchable(_detail_enriched(spark, d), views.gap_columns(), ["tech_name", "store_nbr"], q)


def _stores_with(spark, d, q):
    return _searchable(_hotspots(spark, d), views.STORE_SEARCH, ["state", "city"], q)


def _extract_with(spark, d, q):
    extract = as_text(reports.tech_repeats(_r(spark, d), _w(spark, d), AS_OF))
    return _searchable(extract, extract.columns, ["tech_name"], q)


VIEW_QUERIES = {
    "kpi_overview": lambda s, d: views.kpi_overview(_r(s, d), AS_OF),
    "repeat_groups": lambda s, d: _whole_groups(s, d),
    "by_problem": lambda s, d: views.by_problem(_measured_groups(s, d)),
    "by_store": lambda s, d: views.by_store(_groups(s, d)),
    "by_director": lambda s, d: views.by_director(_groups(s, d)),
    "repeat_detail_view": lambda s, d: views.repeat_detail_view(_whole_groups(s, d), ORG_FILTER),
    "filtered_kpis": lambda s, d: views.filtered_kpis(_groups(s, d), ORG_FILTER),
    "by_store_filtered": lambda s, d: views.by_store_filtered(_groups(s, d), ORG_FILTER),
    "by_director_filtered": lambda s, d: views.by_director_filtered(_groups(s, d), ORG_FILTER),
    "by_problem_filtered": lambda s, d: views.by_problem_filtered(_groups(s, d), FACET_FILTER),
    "facets": lambda s, d: views.facets(_groups(s, d), FACET_FILTER),
    "store_slice": lambda s, d: views.store_slice(_whole_groups(s, d), SLICE_STORE),
    "store_slice_summary": lambda s, d: views.store_slice_summary(_groups(s, d), SLICE_STORE),
    "gap_finder": lambda s, d: views.gap_finder(_detail_enriched(s, d), sort_key="days_between",
                                                descending=False, page_no=1, **GAP_FILTER),
    "gap_finder_search": lambda s, d: views.gap_finder(_detail_enriched(s, d), **GAP_SEARCH),
    "gap_count": lambda s, d: views.gap_count(_detail_enriched(s, d), **GAP_SEARCH),
    "by_problem_sorted": lambda s, d: views.by_problem(_measured_groups(s, d), "rate", False),
    "by_store_sorted": lambda s, d: views.by_store(_groups(s, d), "total_nte", True),
    "by_director_sorted": lambda s, d: views.by_director(_groups(s, d), "store_count", False),
    "by_store_filtered_sorted": lambda s, d: views.by_store_filtered(_groups(s, d), ORG_FILTER, sort_field="rm", descending=False),
    "by_director_filtered_sorted": lambda s, d: views.by_director_filtered(_groups(s, d), ORG_FILTER, sort_field="top_problem", descending=False),
    "repeat_detail_view_sorted": lambda s, d: views.repeat_detail_view(_whole_groups(s, d), ORG_FILTER, sort_field="lc", descending=False),
    "gap_finder_state_trade": lambda s, d: views.gap_finder(_detail_enriched(s, d), state="EUROPE", trade="FM - FURNITURE", size=100),
    "store_list_state": lambda s, d: views.store_list(_hotspots(s, d), state="EUROPE"),
    "trade_options": lambda s, d: views.options(_trade(s, d), "trade"),
    "store_state_options": lambda s, d: views.options(_hotspots(s, d), "state"),
    "trend_trade_options": lambda s, d: views.options(_trend(s, d), "trade"),
    "trade_bands_first": lambda s, d: views.trade_bands(_trade(s, d), 6),
    "trade_bands": lambda s, d: views.trade_bands(_trade(s, d)),
    "trade_band_totals": lambda s, d: views.trade_band_totals(_trade(s, d)),
    "trade_codes": lambda s, d: views.trade_codes(_codes(s, d)),
    "trade_codes_one": lambda s, d: views.trade_codes(_codes(s, d), "FM - AUTOMOBILE"),
    "trade_summary": lambda s, d: views.trade_summary(_trade(s, d)),
    "store_list": lambda s, d: views.store_list(_hotspots(s, d), sort_key="repeats_90d"),
    "store_list_search": lambda s, d: views.store_list(_hotspots(s, d), q="nation_1", page_no=0, size=20),
    "store_count": lambda s, d: views.store_count(_hotspots(s, d), q="nation_1"),
    "month_totals": lambda s, d: views.month_totals(_trend(s, d)),
    "top5_trend": lambda s, d: views.top_trend(_trend(s, d), 5),
    "trend_table": lambda s, d: views.trend_table(_trend(s, d)),
    "trend_table_one": lambda s, d: views.trend_table(_trend(s, d), "FM - MACHINERY"),
    "extract_search": lambda s, d: views.extract_search(
        as_text(reports.tech_repeats(_r(s, d), _w(s, d), AS_OF)), "tech 1"),
    "gap_finder_search_indexed": lambda s, d: views.gap_finder(_gaps_with(s, d, "tech 1"), **GAP_SEARCH),
    "gap_count_indexed": lambda s, d: views.gap_count(_gaps_with(s, d, "tech 1"), **GAP_SEARCH),
    "store_list_search_indexed": lambda s, d: views.store_list(_stores_with(s, d, "nation_1"), q="nation_1", page_no=0, size=20),
    "extract_search_indexed": lambda s, d: views.extract_search(_extract_with(s, d, "tech 1"), "tech 1"),
    "asset_counts_exploded": lambda s, d: views.asset_counts_exploded(pairs(s, d, keep_arrays=True, sort=False)),
    "recent_work_orders": lambda s, d: views.recent_work_orders(pairs(s, d, keep_arrays=True, sort=False)),
    "trend_by_month": lambda s, d: trend_sets.roll_up(_sets(s, d), "month"),
    "trend_by_quarter": lambda s, d: trend_sets.roll_up(_sets(s, d), "quarter"),
    "trend_by_quarter_and_trade": lambda s, d: trend_sets.roll_up(_sets(s, d), "quarter", by_trade=True),
    "trend_by_trade": lambda s, d: trend_sets.roll_up(_sets(s, d), None, by_trade=True),
    "trend_total": lambda s, d: trend_sets.roll_up(_sets(s, d), None),
    "facets_indexed": lambda s, d: selection.facets_indexed(_index(s, d), FACET_FILTER),
    "filtered_kpis_indexed": lambda s, d: selection.kpis_indexed(_index(s, d), ORG_FILTER),
    "by_problem_filtered_indexed": lambda s, d: selection.problems_indexed(
        _index(s, d), views.by_problem(_measured_groups(s, d)), FACET_FILTER),
    "name_search": lambda s, d: views.name_search(_groups(s, d), "manager"),
    "asset_counts_parsed": lambda s, d: views.asset_counts_from_text(pairs(s, d, sort=False)),
    "gap_filter_options": lambda s, d: views.gap_filter_options(_detail_enriched(s, d)),
    "by_problem_on_filtered": lambda s, d: views.by_problem_on_filtered(_groups(s, d), FACET_FILTER),
    "trade_chart": lambda s, d: views.trade_chart(_trade(s, d), 10),
    "problem_chart": lambda s, d: views.problem_chart(_codes(s, d), 10),
    "top_stores": lambda s, d: views.top_stores(_hotspots(s, d), 10),
    "store_chart": lambda s, d: views.store_chart(_hotspots(s, d), sort_key="repeats_90d", k=20),
}


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text — the shape of a BI CSV extract."""
    return df.select(*[df[c].cast("string").alias(c) for c in df.columns])


QUERIES = {
    "repeats_by_trade": q_repeats_by_trade,
    "problem_codes": q_problem_codes,
    "store_hotspots": q_store_hotspots,
    "monthly_trend": q_monthly_trend,
    "repeat_detail": q_repeat_detail,
    "tech_repeats": q_tech_repeats,
    "repeat_pairs_30d": lambda s, d: pairs(s, d, lookback_months=3),
    "repeat_pairs_6m": lambda s, d: pairs(s, d, lookback_months=6),
    "repeat_pairs_all": lambda s, d: pairs(s, d),
    "work_order_gaps_all": work_order_gaps,
    **VIEW_QUERIES,
}
