"""Times every registered query: one warm-up, then the median of three full evaluations.

Prints one JSON line. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` set the data and the cores;
query names as arguments limit the run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tierkit.session import local_session  # noqa: E402
from tierkit.workload import QUERIES  # noqa: E402

RUNS = 3


def evaluate(spark, query, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main(names: list[str]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names or QUERIES:
        evaluate(spark, QUERIES[name], folder)
        seconds[name] = round(statistics.median(evaluate(spark, QUERIES[name], folder) for _ in range(RUNS)), 3)
    print(
        json.dumps({
            "metric": "total_seconds_all_queries",
            "value": round(sum(seconds.values()), 3),
            "unit": "sec",
            "queries": seconds,
            "sf": os.path.basename(folder).removeprefix("sf"),
            "cores": int(cores),
            "spark": spark.version,
        }),
        flush=True,
    )


if __name__ == "__main__":
    main(sys.argv[1:])
