"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (sum of per-query medians), "unit",
"queries": {name: median sec}, "cold": {name: first-run sec}, "sf", ...}.
Each query is evaluated in full (a no-op sink, nothing collected).  Per query
the first run is discarded (reported as ``cold``: it includes code generation
for the plan's shapes) and the median of $BENCH_RUNS (default 3) further runs
is reported.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

HEADLINE = ["hang_rates", "histogram_rates", "prune_stacks_cumulative", "dates_table"]


def _run(spark, fn, sf_dir) -> float:
    t0 = time.time()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.time() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = max(1, int(os.environ.get("BENCH_RUNS", "3")))
    names = sys.argv[1:] or HEADLINE
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from hangscope.plans.registry import REGISTRY
    from hangscope.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus))
    times, cold = {}, {}
    for name in names:
        cold[name] = round(_run(spark, REGISTRY[name], sf_dir), 3)
        times[name] = round(statistics.median(_run(spark, REGISTRY[name], sf_dir) for _ in range(runs)), 3)
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "cold": cold, "runs": runs,
                      "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
