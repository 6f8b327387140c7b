"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from strata.queries import QUERIES  # noqa: E402

# Queries that write, or run a stream, time that work; the others are run into a sink without output.
HEADLINE = (
    "bronze_parse", "array_to_object_rows", "bronze_roundtrip", "silver_cast_float", "silver_full_spec",
    "silver_partitioned_read", "silver_rerun", "deduplicate_latest", "unique_key_violations_rows", "hourly_plan",
    "request_validate", "run_latest_state", "run_transitions", "run_reconcile", "artifact_scan",
    "gold_bars_hourly", "gold_denormalised", "gold_sql_file", "stream_bronze_rows", "stream_silver_rows",
)


def make_spark() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="strata-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("strata-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.checkpoint.dir", f"file://{scratch}/shared")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = make_spark()
    QUERIES["bronze_parse"](spark, sf_dir).limit(1).collect()
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_seconds", "value": total, "unit": "sec", "queries": times, "sf": Path(sf_dir).name}))
    spark.stop()


if __name__ == "__main__":
    main()
