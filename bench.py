"""Benchmark: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each run builds the query (including any eager checkpoint) and executes it
end to end through the ``noop`` sink (full plan, no driver collect).  After a
short global warm-up (JIT), every query reports the median of $BENCH_REPS
runs.  Prints ONE JSON line:
  {"metric": "total_median_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

WARMUP = ("repeats_by_trade", "repeat_pairs_30d", "gap_finder")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]
    from recurwork.session import build_session
    from recurwork.plans.catalog import QUERIES

    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "16g")})

    def run(fn) -> float:
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for key in WARMUP:
        run(QUERIES[key])
    times: dict[str, float] = {}
    for key, fn in QUERIES.items():
        if only and key not in only:
            continue
        times[key] = round(statistics.median(run(fn) for _ in range(reps)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_median_sec", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus, "reps": reps}
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
