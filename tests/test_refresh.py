"""Batch refresh writes every result; the views read the written pair table."""

import os
import tempfile

import pytest

from helpers import MEDIUM
from recurwork.plans import refresh as rf
from recurwork.sources.fixtures import AS_OF, fx_recurring, fx_workorder_dim, fx_workorders


def test_refresh_writes_every_result(spark):
    out = tempfile.mkdtemp(prefix="recurwork-refresh-")
    paths = rf.refresh(spark, fx_workorders(spark, MEDIUM), fx_workorder_dim(spark, MEDIUM),
                       fx_recurring(spark, MEDIUM), out, AS_OF, lookback_months=100)
    assert set(paths) >= {"repeats_by_trade", "repeat_pairs_30d", "repeat_groups", "facets", "kpi_overview"}
    for name, p in paths.items():
        assert os.path.isdir(p), name
    pairs = spark.read.parquet(paths["repeat_pairs_30d"]).count()
    assert pairs > 100 and spark.read.parquet(paths["repeat_groups"]).count() == pairs
    assert spark.read.parquet(paths["repeats_by_trade"]).count() == 8


def test_refresh_over_buckets_gives_the_same_and_exports(spark):
    s, w, r = fx_workorders(spark, MEDIUM), fx_workorder_dim(spark, MEDIUM), fx_recurring(spark, MEDIUM)
    outs = [tempfile.mkdtemp(prefix="recurwork-refresh-") for _ in range(2)]
    a, b = (rf.refresh(spark, s, w, r, o, AS_OF, lookback_months=100, **kw) for o, kw in zip(outs, ({"csv_export": True}, {"buckets": 4})))
    assert a.keys() == b.keys()
    for name in ("store_hotspots", "tech_repeats", "repeat_detail", "repeat_pairs_30d", "by_store"):
        x, y = (sorted(map(str, spark.read.parquet(p[name]).collect())) for p in (a, b))
        assert x == y and x, name
    for name in rf.CSV_EXPORTS:
        assert spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f"{outs[0]}/csv/{name}").count() == spark.read.parquet(a[name]).count()
    assert len(os.listdir(f"{outs[1]}/layout")) == 2


def test_failed_refresh_leaves_the_last_good_rows(spark):
    from pyspark.sql import functions as F

    from recurwork import schemas
    from recurwork.sources import files
    out = tempfile.mkdtemp(prefix="recurwork-refresh-")
    s, w, r = fx_workorders(spark, MEDIUM), fx_workorder_dim(spark, MEDIUM), fx_recurring(spark, MEDIUM)
    rf.refresh(spark, s, w, r, out, AS_OF)
    good = files.load_result(spark, os.path.join(out, "repeat_pairs_30d"), schemas.REPEAT_PAIRS).count()
    broken = s.withColumn("problem_desc", F.raise_error(F.lit("source unavailable")).cast("string"))
    with pytest.raises(Exception, match="source unavailable"):
        rf.refresh(spark, broken, w, r, out, AS_OF)
    assert good > 0
    assert files.load_result(spark, os.path.join(out, "repeat_pairs_30d"), schemas.REPEAT_PAIRS).count() == good
