"""Invariants over the sf0.01 fixture results (§5.3 of the survey)."""

import pytest
from pyspark.sql import functions as F

from helpers import MEDIUM
from recurwork.plans import catalog, reports, views
from recurwork.sources.fixtures import AS_OF


@pytest.fixture(scope="module")
def r(spark):
    return catalog._r(spark, MEDIUM)


@pytest.fixture(scope="module")
def groups(spark):
    return catalog._groups(spark, MEDIUM).cache()


def test_cumulative_flags_and_bands(r):
    t = reports.repeats_by_trade(r, AS_OF, limit=None)
    assert t.filter(~((F.col("repeats_90d") <= F.col("repeats_180d")) &
                      (F.col("repeats_180d") <= F.col("repeats_365d")) &
                      (F.col("repeats_90d") >= 0))).count() == 0
    b = views.trade_bands(t)
    bad = b.join(t, "trade").filter(F.col("band_0_90") + F.col("band_91_180") + F.col("band_181_365")
                                    != F.col("repeats_365d"))
    assert bad.count() == 0


def test_group_dates_and_counts(groups):
    assert groups.filter(F.col("fc") > F.col("lc")).count() == 0
    assert groups.filter(F.col("r30") > F.col("cnt")).count() == 0
    assert groups.filter(F.col("r30") < 2).count() == 0


def test_roll_ups_agree(groups):
    total = groups.agg(F.sum("r30")).first()[0]
    assert views.by_problem(groups).agg(F.sum("repeat_count")).first()[0] == total
    assert views.by_director(groups).agg(F.sum("repeat_incidents")).first()[0] == total
    assert views.by_store(groups).agg(F.sum("repeat_incidents")).first()[0] == total
    k = views.filtered_kpis(groups, {}, require_org_filter=False).first()
    assert k.repeat_incidents == total and k.pairs == groups.count()


def test_pages_concatenate_to_the_whole(spark):
    d = catalog._detail_enriched(spark, MEDIUM)
    full = views.gap_finder(d, director="ASIA", size=100000).collect()
    pages = []
    for p in range(0, len(full) // 50 + 1):
        pages += views.gap_finder(d, director="ASIA", page_no=p, size=50).collect()
    assert pages == full
    n = views.gap_count(d, director="ASIA").first().repeat_wos
    assert n == len(full)


def test_facets_contain_selection_and_values_pass_other_filters(groups):
    sel = {"sr": "MIDDLE EAST", "dir": "NATION_9"}
    f = views.facets(groups, sel).collect()
    got = {(r.field, r.value) for r in f}
    assert ("sr", "MIDDLE EAST") in got and ("dir", "NATION_9") in got
    probs = {v for k, v in got if k == "prob"}
    want = {r.prob for r in groups.filter((F.col("sr") == "MIDDLE EAST") & (F.col("dir") == "NATION_9")).collect()}
    assert probs == want


def test_top_trend_grid_is_dense(spark):
    t = reports.monthly_trend(catalog._r(spark, MEDIUM), AS_OF)
    g = views.top_trend(t, 3)
    months = t.select("month").distinct().count()
    assert g.count() == months * 3
    assert g.groupBy("month").count().filter(F.col("count") != 3).count() == 0


def test_declared_unique_dimension_gives_the_same_results(spark):
    from recurwork.operators.repeats import repeat_pairs_30d
    from recurwork.sources.fixtures import fx_workorder_dim, fx_workorders
    r, w = catalog._r(spark, MEDIUM), fx_workorder_dim(spark, MEDIUM)
    for fn in (reports.store_hotspots, reports.tech_repeats):
        assert sorted(fn(r, w, AS_OF, w_unique=True).collect()) == sorted(fn(r, w, AS_OF).collect())
    s = fx_workorders(spark, MEDIUM)
    a = repeat_pairs_30d(s, w, AS_OF, 100, w_unique=True)
    assert sorted(a.collect(), key=str) == sorted(repeat_pairs_30d(s, w, AS_OF, 100).collect(), key=str)
    # no de-duplication of W (a row_number() = 1 group limit) left in the plan
    assert "row_number(), 1," not in a._jdf.queryExecution().executedPlan().toString()
