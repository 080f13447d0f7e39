"""Batch refresh: compute and write every result as a new version.

Every report is one Spark job that writes Parquet under ``out_dir``; views are
derived from the *written* tables, which cuts the lineage (a lost executor later
costs a re-read, not a recomputation).  A failed step leaves all last good versions
in place.  Filtered and searched views stay on-demand functions over the tables.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from recurwork import schemas
from recurwork.operators.dimension import dedupe_dim
from recurwork.operators.repeats import group_measures, repeat_pairs_30d, surviving_rows, work_orders
from recurwork.plans import reports, selection, trend_sets, views
from recurwork.sources import files, layout

#: The tables that readers export (V3–V6).
CSV_EXPORTS = ("by_problem", "by_store", "by_director", "repeat_detail_view")


def refresh(spark: SparkSession, s: DataFrame, w: DataFrame, r: DataFrame, out_dir: str, as_of,
            lookback_days: int = 365, lookback_months: int = 3, json_export: bool = False, csv_export: bool = False,
            buckets: int | None = None) -> dict[str, str]:
    """Write every report and unfiltered view, all rows; returns name -> path of the version written.

    W is reduced to a row per work order once, and the measures and rows of the
    surviving repeat groups are written once for what reads them; all are versions in
    ``out_dir``.  With ``buckets`` (see ``layout.buckets_for``) W and the year of R are
    also laid out by work order, and the reports join them without moving either.
    ``json_export`` and ``csv_export`` add those forms of every result, CSV of the
    tables that are exported for readers (S9).
    """
    paths: dict[str, str] = {}

    def put(name: str, df: DataFrame) -> DataFrame:
        paths[name] = files.write_result(df, os.path.join(out_dir, name))
        return export(name, files.load_result(spark, os.path.join(out_dir, name), df.schema))  # lineage cut: later steps read the written table

    def export(name: str, back: DataFrame) -> DataFrame:
        if json_export:
            files.export_json(back, os.path.join(out_dir, "json", name))
        if csv_export and name in CSV_EXPORTS:
            files.export_csv(back, os.path.join(out_dir, "csv", name))
        return back

    def by_work_order(df: DataFrame, name: str) -> DataFrame:
        return layout.open_bucketed(spark, layout.write_bucketed(df, os.path.join(out_dir, "layout"), buckets, name=name))

    w = put("work_order_dim", dedupe_dim(w))
    if buckets:
        w, r = by_work_order(w, "work_order_dim"), by_work_order(reports.recent(r, as_of, lookback_days), "recurring")
    trade = put("repeats_by_trade", reports.repeats_by_trade(r, as_of, lookback_days))
    put("problem_codes", reports.problem_codes(r, as_of, lookback_days))
    put("store_hotspots", reports.store_hotspots(r, w, as_of, lookback_days, w_unique=True))
    trend = put("monthly_trend", reports.monthly_trend(r, as_of, lookback_days))
    sets = put("trend_sets", trend_sets.trend_sets(r, as_of, lookback_days))
    for of in ("month", "quarter", "year"):
        put(f"trend_by_{of}", trend_sets.roll_up(sets, of))
    put("repeat_detail", reports.repeat_detail(r, as_of, lookback_days, w=w, w_unique=True))
    put("tech_repeats", reports.tech_repeats(r, w, as_of, lookback_days, w_unique=True))

    orders = work_orders(s, as_of, lookback_months)
    measures = put("repeat_measures", group_measures(orders))
    survivors = put("repeat_rows", surviving_rows(orders, measures))
    at = os.path.join(out_dir, "repeat_pairs_30d")
    paths["repeat_pairs_30d"] = files.write_or_keep(
        spark, lambda: repeat_pairs_30d(s, w, as_of, lookback_months, keep_arrays=True, w_unique=True, measures=measures, survivors=survivors),
        schemas.REPEAT_PAIRS, at)
    pairs = export("repeat_pairs_30d", spark.read.parquet(paths["repeat_pairs_30d"]))
    groups = views.repeat_groups(pairs)
    put("repeat_groups", groups)
    put("by_problem", views.by_problem(groups))
    put("by_store", views.by_store(groups))
    put("by_director", views.by_director(groups))
    put("repeat_detail_view", views.repeat_detail_view(groups, require_org_filter=False))
    put("facets", selection.facets_indexed(put("group_index", selection.group_index(groups)), {}))
    put("asset_counts_exploded", views.asset_counts_exploded(pairs))
    put("recent_work_orders", views.recent_work_orders(pairs))

    put("kpi_overview", views.kpi_overview(r, as_of, lookback_days))
    put("trade_bands", views.trade_bands(trade))
    put("trade_summary", views.trade_summary(trade))
    put("month_totals", views.month_totals(trend))
    put("top5_trend", views.top_trend(trend, 5))
    return paths


def main(argv: list[str] | None = None) -> None:
    """``spark-submit --py-files recurwork.zip recurwork/plans/refresh.py --workorders .. --dim .. --recurring .. --out ..``.

    Uses the session the cluster provides (its ``spark.checkpoint.dir`` must
    name a shared folder); ``--as-of`` defaults to today.
    """
    import argparse
    import datetime as dt

    from recurwork.session import checkpoint_dir
    from recurwork.sources.tables import scan_recurring, scan_workorder_dim, scan_workorders

    ap = argparse.ArgumentParser(description="Recompute and overwrite every repeat-work result.")
    ap.add_argument("--workorders", required=True, help="raw work-order fact S (parquet)")
    ap.add_argument("--dim", required=True, help="work-order dimension W (parquet)")
    ap.add_argument("--recurring", required=True, help="recurring-repeat fact R (parquet)")
    ap.add_argument("--out", required=True, help="output folder (one parquet folder per result)")
    ap.add_argument("--as-of", default=dt.date.today().isoformat())
    ap.add_argument("--lookback-days", type=int, default=365)
    ap.add_argument("--lookback-months", type=int, default=3)
    ap.add_argument("--json", action="store_true", help="also export every result as JSON lines")
    ap.add_argument("--csv", action="store_true", help="also export the repeat tables as CSV")
    ap.add_argument("--buckets", type=int, help="lay W and R out in so many buckets by work order")
    a = ap.parse_args(argv)

    spark = SparkSession.builder.appName("recurwork-refresh").getOrCreate()
    checkpoint_dir(spark)
    paths = refresh(spark, scan_workorders(spark, a.workorders), scan_workorder_dim(spark, a.dim),
                    scan_recurring(spark, a.recurring), a.out, dt.date.fromisoformat(a.as_of),
                    a.lookback_days, a.lookback_months, a.json, a.csv, a.buckets)
    for name, p in paths.items():
        print(f"{name}\t{p}")


if __name__ == "__main__":
    main()
