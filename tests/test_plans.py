"""Plan checks: no Python in the plan, pushdown and pruning, bounded top-N and lists."""

import os
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from helpers import SMALL
from recurwork.operators import repeats
from recurwork.plans import catalog, views
from recurwork.plans.catalog import QUERIES
from recurwork.session import written
from recurwork.sources.fixtures import AS_OF, fx_workorder_dim, fx_workorders


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    """Whole plans: what the pair queries write on the way is planned with the rest."""
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(catalog, "written", lambda df, name: df)
        return {k: plan_of(fn(spark, SMALL)) for k, fn in QUERIES.items()}


def test_no_python_udf_anywhere(plans):
    for k, p in plans.items():
        for node in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
            assert node not in p, (k, node)


def test_no_cartesian_products(plans):
    for k, p in plans.items():
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, k


def test_scans_are_pruned_and_filtered(spark):
    p = plan_of(QUERIES["repeats_by_trade"](spark, SMALL))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in p \
        or "o_comment" not in p
    assert "o_comment" not in p and "o_clerk" not in p
    assert "PushedFilters: [IsNotNull(o_custkey)]" in p


def test_a_first_k_is_take_ordered_and_no_range_sort_feeds_it(plans):
    for k in ("trade_bands_first", "trade_chart", "problem_chart", "top_stores", "store_chart", "store_list", "gap_finder"):
        assert "TakeOrderedAndProject" in plans[k] or "CollectLimit" in plans[k], k
        assert "rangepartitioning" not in plans[k], k


def test_bounded_lists_use_window_group_limit(plans):
    # the 20/3 latest per group and the 6 busiest assets are cut before the shuffle
    assert plans["repeat_pairs_30d"].count("WindowGroupLimit") >= 4


R_KEYS = ("repeats_by_trade", "problem_codes", "store_hotspots", "monthly_trend", "repeat_detail", "kpi_overview", "trade_summary",
          "trade_codes", "top5_trend", "month_totals")
W_KEYS = ("tech_repeats", "store_list", "top_stores", "gap_finder", "gap_finder_search", "gap_count")


def test_r_is_read_once(plans):
    # the fixture R reads orders once, the fixture W once more
    for k in R_KEYS + W_KEYS:
        want = 2 if k in W_KEYS + ("store_hotspots",) else 1
        assert plans[k].count("o_orderdate") and scans(plans[k], "orders") == want, k


def scans(plan: str, table: str) -> int:
    return len(re.findall(rf"FileScan parquet [^\n]*/{table}\.parquet", plan))


@pytest.fixture(scope="module")
def fact(spark):
    """S as one table of its own, so that its scans can be counted."""
    path = os.path.join(tempfile.mkdtemp(prefix="recurwork-plans-"), "s.parquet")
    odd = F.when(F.col("tracking_nbr") % 5 > 0, F.col("category_name"))  # groups without a category too
    fx_workorders(spark, SMALL).withColumn("category_name", odd).write.parquet(path)
    return spark.read.parquet(path), fx_workorder_dim(spark, SMALL)


def test_lists_assets_and_w_follow_the_surviving_groups(spark, fact):
    """Each of them reads S through an inner join with the keys of the measures."""
    p = spark_plan(repeats.repeat_pairs_30d(*fact, AS_OF, 100))
    assert p.count("Join Inner") >= 3 and p.count("collect_set") >= 2  # organisation and lists; assets need the keys alone


def test_pairs_read_s_twice_at_most_and_views_that_need_measures_once(spark, fact):
    steps = []

    def write(df, name):
        steps.append(plan_of(df))
        return written(df, name)

    df = repeats.in_two_reads(write, *fact, AS_OF, 100)
    assert len(steps) == 2 and sum(scans(p, "s") for p in [*steps, plan_of(df)]) == 2 and scans(plan_of(df), "s") == 0
    same = repeats.repeat_pairs_30d(*fact, AS_OF, 100)
    assert [tuple(r) for r in df.collect()] == [tuple(r) for r in same.collect()] and df.count() > 20

    steps.clear()
    groups = views.repeat_groups(repeats.in_two_reads(write, *fact, AS_OF, 100, rows=False, sort=False))
    for view in (views.by_store(groups), views.by_store_filtered(groups, {"sr": "ASIA"}), views.store_slice_summary(groups, 3), views.name_search(groups, "a"),
                 views.by_director(groups), views.filtered_kpis(groups, {"sr": "ASIA"}), views.facets(groups, {})):
        assert sum(scans(p, "s") for p in [*steps, plan_of(view)]) == 2
    lazy = views.by_problem(views.repeat_groups(repeats.repeat_pairs_30d(*fact, AS_OF, 100, sort=False)))
    assert scans(plan_of(lazy), "s") == 1


def spark_plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_no_operator_runs_a_job_when_called(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "building plans")
    try:
        for k in ("by_problem", "gap_finder", "top5_trend", "kpi_overview"):
            QUERIES[k](spark, SMALL)
        views.store_slice(views.repeat_groups(repeats.repeat_pairs_30d(fx_workorders(spark, SMALL), fx_workorder_dim(spark, SMALL), AS_OF)), 3)
        # reading a Parquet footer for the schema is the only job a plan may need
        assert all("parquet" in (stage.name if (stage := tracker.getStageInfo(s)) else "parquet")
                   for j in tracker.getJobIdsForGroup("lazy") for s in tracker.getJobInfo(j).stageIds)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_cluster_conf_sizes_partitions():
    from recurwork.session import cluster_conf
    c = cluster_conf(8000, 100 << 40)
    assert int(c["spark.sql.shuffle.partitions"]) == 416000  # 409,600 rounded up to whole waves
    assert int(c["spark.sql.shuffle.partitions"]) % 8000 == 0
    assert int(cluster_conf(8, 1 << 20)["spark.sql.shuffle.partitions"]) == 24


def test_w_gets_a_runtime_bloom_filter_at_scale(spark):
    """With scale-sized thresholds, Spark pre-filters W by the work orders' keys before shuffling it."""
    from recurwork.operators.dimension import enrich
    from recurwork.operators.repeats import work_orders
    from recurwork.sources.fixtures import AS_OF, fx_workorder_dim, fx_workorders
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1",
            "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        p = plan_of(enrich(work_orders(fx_workorders(spark, SMALL), AS_OF, 3), fx_workorder_dim(spark, SMALL), ["fm_director"]))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "might_contain" in p and "bloom_filter_agg" in p
