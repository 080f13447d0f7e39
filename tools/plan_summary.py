"""Summarise the physical plan of every registered query as a table.

usage: python tools/plan_summary.py [sf_dir]

Counts the operators that matter at scale in each query's physical plan
(before AQE re-planning): shuffles by kind, broadcasts, join strategies,
aggregate implementations, windows and group limits, and whether filters
reached the parquet scans.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NODES = [
    ("hash shuffles", r"Exchange hashpartitioning"),
    ("range shuffles", r"Exchange rangepartitioning"),
    ("single-partition", r"Exchange SinglePartition"),
    ("broadcasts", r"BroadcastExchange"),
    ("SMJ", r"SortMergeJoin"),
    ("BHJ", r"BroadcastHashJoin"),
    ("hash agg", r"HashAggregate"),
    ("sort agg", r"SortAggregate"),
    ("object agg", r"ObjectHashAggregate"),
    ("windows", r"\bWindow \["),
    ("group limits", r"WindowGroupLimit"),
    ("top-k", r"TakeOrderedAndProject"),
    ("subqueries", r"Subquery subquery"),
]


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from recurwork.session import build_session
    from recurwork.plans.catalog import QUERIES
    spark = build_session("local[8]", 8)
    head = ["query"] + [n for n, _ in NODES] + ["pushed filters", "python"]
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tools/plan_summary.py {sf_dir}` (plans before AQE re-planning; at this size AQE")
    print("turns several sort-merge joins into broadcasts).  Partial/final pairs count twice.\n")
    print("| " + " | ".join(head) + " |")
    print("|" + " --- |" * len(head))
    for key, fn in QUERIES.items():
        p = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        counts = [str(len(re.findall(rx, p))) for _, rx in NODES]
        pushed = "yes" if re.search(r"PushedFilters: \[[^\]]", p) else "-"
        py = "yes" if re.search(r"PythonUDF|ArrowEvalPython|BatchEvalPython", p) else "no"
        print("| " + " | ".join([key] + counts + [pushed, py]) + " |")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
