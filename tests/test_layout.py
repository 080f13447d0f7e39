"""W and the facts in buckets by work order: the joins move neither side, the rows stay the same."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from helpers import MEDIUM, dim, r_df, rec, w_df
from recurwork.operators.dimension import dedupe_dim, enrich
from recurwork.plans import reports
from recurwork.sources import layout
from recurwork.sources.fixtures import AS_OF, fx_recurring, fx_workorder_dim


@pytest.fixture(scope="module")
def tables(spark):
    folder = tempfile.mkdtemp(prefix="recurwork-buckets-")
    r, w = fx_recurring(spark, MEDIUM), fx_workorder_dim(spark, MEDIUM)
    at = [layout.write_bucketed(df, folder, 8, name=n) for n, df in (("r", r), ("w", dedupe_dim(w)))]
    return r, w, *(layout.open_bucketed(spark, a) for a in at)


@pytest.fixture
def no_broadcast(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def below_join(text):
    """The lines of a plan from the join on down."""
    lines = text.splitlines()
    at = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    return "\n".join(lines[at:])


def test_enrichment_moves_neither_side(tables, no_broadcast):
    _, _, r, w = tables
    p = plan(enrich(r, w, ["fm_director"], dedupe=False))
    assert "SortMergeJoin" in p and "Exchange" not in p and p.count("Bucketed: true") == 2


REPORTS = {
    "hotspots": lambda r, w, unique: reports.store_hotspots(r, w, AS_OF, w_unique=unique),
    "technicians": lambda r, w, unique: reports.tech_repeats(r, w, AS_OF, w_unique=unique),
    "detail": lambda r, w, unique: reports.repeat_detail(r, AS_OF, w=w, w_unique=unique),
}


@pytest.mark.parametrize("name", REPORTS)
def test_reports_over_buckets(tables, no_broadcast, name):
    r, w, br, bw = tables
    got, want = REPORTS[name](br, bw, True), REPORTS[name](r, w, False)
    assert "Exchange" not in below_join(plan(got)) and "Exchange" in below_join(plan(want))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() > 0


def test_another_session_declares_the_buckets_again(spark, no_broadcast):
    folder = tempfile.mkdtemp(prefix="recurwork-buckets-")
    at = layout.write_bucketed(w_df(spark, [dim(i) for i in range(50)]), folder, 4)
    other = spark.newSession()
    got = layout.open_bucketed(other, at)
    assert "Bucketed: true" in plan(got.groupBy("tracking_nbr").agg(F.max("store_city"))) and got.count() == 50
    assert got.schema == w_df(spark, []).schema or got.columns == w_df(spark, []).columns
    with pytest.raises(ValueError):
        layout.open_bucketed(spark, folder)


def test_rows_without_a_key_stay_in_a_left_join(spark, no_broadcast):
    folder = tempfile.mkdtemp(prefix="recurwork-buckets-")
    facts = r_df(spark, [rec(1, "2001-02-01", 5), rec(2, "2001-02-01", 5)]).withColumn("tracking_nbr", F.when(F.col("tracking_nbr") == 1, 1))
    a, b = (layout.open_bucketed(spark, layout.write_bucketed(x, folder, 2, name=n)) for n, x in (("f", facts), ("w", w_df(spark, [dim(1, city="Here")]))))
    got = {(x.tracking_nbr, x.store_city) for x in enrich(a, b, ["store_city"], dedupe=False).collect()}
    assert got == {(1, "Here"), (None, None)}


def test_older_folders_go(spark):
    folder = tempfile.mkdtemp(prefix="recurwork-buckets-")
    w = w_df(spark, [dim(1)])
    last = [layout.write_bucketed(w, folder, 1, name="w") for _ in range(3)][1:]
    other = layout.write_bucketed(w, folder, 1, name="x")
    assert sorted(os.listdir(folder)) == sorted(map(os.path.basename, [*last, other]))


def test_sizes():
    assert [layout.buckets_for(n) for n in (0, 1, 256 << 20, (256 << 20) + 1, 100 << 40)] == [1, 1, 1, 2, 1 << 19]
