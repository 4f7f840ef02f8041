"""Times every registered query on one table folder and prints one JSON line.

BENCH_SF_DIR: folder with the tables (default /root/testdata/sf0.1); BENCH_CPUS: local threads;
BENCH_QUERIES: names to run, comma-separated (default all).
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from marketlake.session import build_session

import registry

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))


def timed(spark, name: str) -> float:
    start = time.perf_counter()
    registry.QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session(
        "marketlake-bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="bench-"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(registry.QUERIES)
    timed(spark, "star_enriched")  # starts the JVM's compilers; not counted
    seconds = {name: round(timed(spark, name), 3) for name in names}
    spark.stop()
    print(json.dumps({
        "metric": "total wall time of all registered queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(os.path.normpath(FOLDER)).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
