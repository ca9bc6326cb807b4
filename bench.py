"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores. Derived tables are written
before the timing starts, as a warehouse stores them; each query then runs once to warm up
and BENCH_RUNS times (default 3), and the median counts. Reading the result into a
no-op sink makes every row be computed without sending it to Python.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from patronage.queries import REGISTRY  # noqa: E402
from patronage.session import local_session  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = wanted.split(",") if wanted else [n for n, q in REGISTRY.items() if q.headline]
    spark = local_session("bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            REGISTRY[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(name, [round(t, 2) for t in times], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
                      "cpus": int(os.environ.get("BENCH_CPUS", "8")), "runs": runs}))


if __name__ == "__main__":
    main()
