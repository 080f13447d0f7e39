"""The index of the groups: equal to the views on random filters, and a selection reads nothing but the index."""

import random
import tempfile

import pytest

from helpers import MEDIUM
from recurwork.plans import selection, views
from recurwork.plans.catalog import _groups

COLUMNS = "sn int, prob string, pcd string, trade string, cat string, cnt bigint, nte double, r30 bigint, sr string, dir string, rm string, fsm string"


def made(spark, n, seed):
    rng = random.Random(seed)
    name = lambda p, k: rng.choice([None, "", "Unassigned", "Unassigned 2", *[f"{p}{i}" for i in range(k)]])
    data = [(rng.randrange(40), name("P", 6), name("C", 3), "FM - A", name("K", 2), rng.randrange(2, 9), 1.0, rng.randrange(5),
             name("S", 3), name("D", 9), name("R", 20), name("F", 70)) for _ in range(n)]
    return spark.createDataFrame(data, COLUMNS).repartition(3)


@pytest.fixture(scope="module", params=["fixture", "made"])
def tables(spark, request):
    at = tempfile.mkdtemp(prefix="recurwork-index-")
    (_groups(spark, MEDIUM) if request.param == "fixture" else made(spark, 3000, 1)).write.parquet(f"{at}/groups")
    groups = spark.read.parquet(f"{at}/groups")
    selection.group_index(groups).write.parquet(f"{at}/index")
    return groups, spark.read.parquet(f"{at}/index")


def filters(groups, n):
    rng, seen = random.Random(n), [x.asDict() for x in groups.select(*views.FACET_FIELDS).collect()]
    for i in range(n):
        row = rng.choice(seen)
        picked = rng.sample(views.FACET_FIELDS, i % 4)
        yield {f: (row[f] if rng.random() < 0.8 else rng.choice([rng.choice(seen)[f], "Unassigned X", "none"])) for f in picked}


def rows(df):
    return sorted(map(str, df.collect()))


def test_facets_equal_the_view(tables):
    groups, index = tables
    for f in filters(groups, 9):
        assert rows(selection.facets_indexed(index, f)) == rows(views.facets(groups, f)), f


def test_kpis_equal_the_view(tables):
    groups, index = tables
    for i, f in enumerate(filters(groups, 9)):
        got, want = (v(t, f, i % 2 == 0) for v, t in ((selection.kpis_indexed, index), (views.filtered_kpis, groups)))
        assert rows(got) == rows(want), f


def test_problems_equal_the_view(tables):
    groups, index = tables
    by_problem = views.by_problem(groups)
    for f in [*filters(groups, 4), {"sr": groups.filter("sr <> ''").first().sr}]:
        got = selection.problems_indexed(index, by_problem, f)
        assert rows(got) == rows(views.by_problem_filtered(groups, f).select(*got.columns)), f


def test_hits_count_the_groups(tables):
    groups, index = tables
    sr = groups.filter("sr <> ''").first().sr
    got = {x.value: x.groups for x in selection.hits(index, {"sr": sr}, of=("dir",)).collect()}
    want = {x["dir"]: x["count"] for x in groups.filter(groups.sr == sr).groupBy("dir").count().collect()}
    assert got == want


def test_blocks_are_bounded_and_hold_every_group(tables):
    groups, index = tables
    got = index.selectExpr("sum(bit_count(members)) n", "max(size(items)) m", "count(*) b", "count(distinct block) d").first()
    assert got.n == groups.count() and got.m <= 64 * 7 and got.b == got.d


def test_no_groups(spark):
    none = spark.createDataFrame([], COLUMNS)
    index = selection.group_index(none)
    assert index.collect() == [] and selection.facets_indexed(index, {"sr": "S1"}).collect() == []
    assert rows(selection.kpis_indexed(index, {"sr": "S1"})) == rows(views.filtered_kpis(none, {"sr": "S1"}))


def test_a_selection_skips_blocks_and_joins_nothing(tables):
    _, index = tables
    plan = selection.kpis_indexed(index, {"sr": "S1"})._jdf.queryExecution().executedPlan().toString()
    assert "least.sr" in plan.split("PushedFilters")[1].split("ReadSchema")[0] and "Join" not in plan and "Python" not in plan
