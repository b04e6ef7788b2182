"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from gableframe.plans.catalog import QUERIES

HEADLINE = (
    "temporal_split",
    "clean_listings",
    "cleaning_audit",
    "freq_apply",
    "target_apply",
    "feature_frame",
    "baseline_report",
    "exact_sample",
    "ridge_full",
    "random_forest",
    "gbt",
    "file_scoring",
    "request_contract",
    "request_scoring",
    "stream_score",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["temporal_split"](spark, folder).write.format("noop").mode("overwrite").save()  # warm-up
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
