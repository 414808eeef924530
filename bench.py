"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Every query is written to the noop sink; the reported time is the fastest of three runs.
"""

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from chunkloom.plans.catalog import QUERIES

HEADLINE = [
    "workspace_index", "record_scan", "markdown_sections", "go_symbols", "python_symbols",
    "fanout_mixed", "dedup_snapshot", "dedup_sequence", "dedup_with_deletes", "tombstones",
    "chunk_upsert", "log_replay", "vector_points", "memory_append", "fanout_counts",
    "embed_chunks", "file_quarantine", "flow_stats", "job_rollup", "dedup_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("chunkloom-bench")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for key in sys.argv[1:] or HEADLINE:
        runs = []
        for _ in range(3):
            start = time.perf_counter()
            QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[key] = round(min(runs), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall-clock",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
