"""Benchmark the headline queries.

Runs each headline query of the registry on $BENCH_SF_DIR (default
/root/testdata/sf0.1) with local[$BENCH_CPUS] and prints one JSON line:
{"metric": ..., "value": total seconds, "unit": "sec", "queries": {...}, "sf": ...}

Every query is executed in full through the ``noop`` sink (all stages run,
nothing is collected); each is run three times (plan building included) and
the fastest run is reported, so JVM warm-up is not billed to the first query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from ashgrid.catalog import HEADLINE, QUERIES
    from ashgrid.session import local_session

    # BENCH_EVENT_LOG=<scratch dir> records stage/task timings in Spark's event log
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2, app="ashgrid-bench",
                          event_log_dir=os.environ.get("BENCH_EVENT_LOG") or None)
    only = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]
    names = only or list(HEADLINE)
    times: dict[str, float] = {}
    for name in names:
        best = None
        for _ in range(runs):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
