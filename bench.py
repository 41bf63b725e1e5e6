"""Benchmark: run the registered queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is executed completely with a ``noop`` write (all rows computed,
nothing collected to the driver). Prints one JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (8),
BENCH_RUNS (runs per query, median reported; default 1), BENCH_QUERIES
(comma list; default all).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rackpulse.plans import QUERIES  # noqa: E402
from rackpulse.session import clear_staged, get_spark  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = max(1, int(os.environ.get("BENCH_RUNS", "1")))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    names = only or sorted(QUERIES)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    spark = get_spark(cpus)
    # warm the JVM once (class loading, codegen caches) on the flagship
    QUERIES["aligned_metrics"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in names:
        samples = []
        try:
            for _ in range(runs):
                t0 = time.perf_counter()
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                samples.append(time.perf_counter() - t0)
            times[name] = round(statistics.median(samples), 3)
        except Exception as e:  # noqa: BLE001
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": sf, "cpus": cpus, "runs": runs, "n_queries": len(times)}
    if errors:
        out["errors"] = errors
    clear_staged(spark)
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
