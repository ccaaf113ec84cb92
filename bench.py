"""Times every registered query and prints one JSON line.

The data folder is BENCH_SF_DIR (default sf0.1) and the cores are BENCH_CPUS (default 8). Results go
to the no-op sink, so all rows and columns are computed and none are collected.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from bookpipe.queries import QUERIES
from bookpipe.session import build_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def run(spark, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    scratch = tempfile.mkdtemp(prefix="bench-")
    spark = build_session("bookpipe-bench", **{
        "spark.master": f"local[{CPUS}]",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": CPUS,
        "spark.sql.warehouse.dir": f"{scratch}/warehouse",
        "spark.checkpoint.dir": f"{scratch}/shared",
    })
    spark.sparkContext.setLogLevel("ERROR")
    # One untimed query starts the JVM's readers and code generation.
    run(spark, "popular_authors_review_count")
    times = {}
    for name in QUERIES:
        times[name] = round(run(spark, name), 3)
        print(f"{name}: {times[name]}", file=sys.stderr)
    spark.stop()
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
