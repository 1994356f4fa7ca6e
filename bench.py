"""Time all queries on the tables, the feed and the ingest job, and print one JSON line.

BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
"""

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from stoplines.plans.ingest import run_ingest  # noqa: E402
from stoplines.plans.table_feed import table_feed  # noqa: E402
from stoplines.plans.table_queries import QUERIES, Tables  # noqa: E402
from stoplines.storage import drop_scratch, scratch_dir  # noqa: E402

def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = Tables(spark, folder)
    seconds = {}

    def run(name: str) -> None:
        QUERIES[name](tables).write.format("noop").mode("overwrite").save()

    def timed(name: str, what) -> None:
        start = time.perf_counter()
        what()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)

    run("keep_first")  # start the JVM's compilers and the executors' threads
    timed("feed", lambda: table_feed(spark, folder))  # input of the archive queries
    feed = table_feed(spark, folder)
    sources = [f"{feed}/{part}" for part in ("stations", "timetables", "timetable_changes")]
    timed("ingest", lambda: run_ingest(spark, *sources, scratch_dir(spark, "bench-snapshot")))
    run("ingest_days")  # the snapshot that the ingest queries read is not timed again
    for name in QUERIES:
        timed(name, lambda name=name: run(name))
    drop_scratch(spark)
    print(json.dumps({
        "metric": "queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": folder.rsplit("/sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
