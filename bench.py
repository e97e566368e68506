"""Times the headline queries at ``$BENCH_SF_DIR`` and prints one JSON line.

Each query is planned and run in full, its result going to Spark's ``noop`` sink; the figure is the
fastest of ``$BENCH_RUNS`` runs (default 3) after one that warms up the JVM.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from workload import QUERIES

HEADLINE = (
    "difficulty_avg",
    "difficulty_null_is_hard",
    "duration_minutes",
    "total_minutes",
    "list_mentions_term",
    "rows_mentioning_term",
    "split_count",
    "date_parts",
    "parse_date",
    "delta_filter",
    "watermark_max",
    "json_explicit_schema",
    "parquet_partitioned_roundtrip",
    "parquet_append",
    "csv_report_single_file",
    "history_latest_active",
    "history_advance",
    "cleanse_full",
    "difficulty_report",
    "ingest_full",
    "ingest_delta",
    "ingest_then_report",
)


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-bench-"))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    timed = {}
    for name in HEADLINE:
        seconds(spark, name, sf_dir)
        timed[name] = round(min(seconds(spark, name, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(timed.values()), 3),
        "unit": "sec",
        "queries": timed,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
