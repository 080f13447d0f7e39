"""Month-partitioned facts: the lookbacks prune directories and results do not change."""

import os
import re
import tempfile

from helpers import MEDIUM
from recurwork.operators.repeats import repeat_pairs_30d
from recurwork.plans import reports
from recurwork.sources.fixtures import AS_OF, fx_recurring, fx_workorder_dim, fx_workorders
from recurwork.sources.tables import scan_recurring, scan_workorders, write_by_month


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_month_partitions_prune_and_keep_results(spark):
    base = tempfile.mkdtemp(prefix="recurwork-part-")
    sp, rp = os.path.join(base, "s"), os.path.join(base, "r")
    write_by_month(fx_workorders(spark, MEDIUM), sp, "completion_date")
    write_by_month(fx_recurring(spark, MEDIUM), rp, "call_date")
    s, r = scan_workorders(spark, sp), scan_recurring(spark, rp)
    w = fx_workorder_dim(spark, MEDIUM)

    got = reports.repeats_by_trade(r, AS_OF)
    assert re.search(r"PartitionFilters: \[isnotnull\(call_month#\d+\), \(call_month#\d+ >= 2000-08\)\]", _plan(got))
    assert sorted(got.collect()) == sorted(reports.repeats_by_trade(fx_recurring(spark, MEDIUM), AS_OF).collect())

    a = repeat_pairs_30d(s, w, AS_OF, 6, sort=False)
    assert re.search(r"\(completion_month#\d+ >= 2001-02\)", _plan(a))
    b = repeat_pairs_30d(fx_workorders(spark, MEDIUM), w, AS_OF, 6, sort=False)
    assert sorted(a.collect(), key=str) == sorted(b.collect(), key=str)
