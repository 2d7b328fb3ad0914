"""Time the registered queries and print one JSON line.

Each query runs once to warm up, then three times; its median counts.
"""

from __future__ import annotations

import json
import os
import shutil
import statistics
import sys
import tempfile
import time

from sparkpipe.plans.queries import QUERIES
from sparkpipe.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def run(spark, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    work = tempfile.mkdtemp(prefix="sparkpipe-bench-")
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        {
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "16g",
            "spark.checkpoint.dir": work,
        },
        "ERROR",
    )
    names = sys.argv[1:] or list(QUERIES)
    timings = {}
    for name in names:
        run(spark, name)
        timings[name] = round(statistics.median(run(spark, name) for _ in range(RUNS)), 3)
        print(f"{name} {timings[name]}", file=sys.stderr, flush=True)
    spark.stop()
    shutil.rmtree(work, ignore_errors=True)
    sf = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total median time of all queries",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )


if __name__ == "__main__":
    main()
