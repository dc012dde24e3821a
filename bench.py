"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from ledgerlake.catalog import QUERIES

HEADLINE = (
    "gold_fraud_analysis",
    "gold_user_behavior_summary",
    "fraud_alert_list",
    "top5_spenders",
    "tx_stats",
    "dedup_transactions",
    "silver_transactions",
    "conform_transactions",
    "merge_upsert",
    "merge_newer_wins",
    "merge_insert_only",
    "cdc_apply_deletes",
    "decode_permissive",
    "clean_transactions",
    "recent_tx_10",
    "sequential_ids",
    "customer_profile",
    "dq_summary",
    "silver_upsert_batch",
    "compact",
    "sorted_layout",
    "stream_upsert",
    "stream_equals_batch",
    "silver_to_gold",
)


def session(cpus: str) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def seconds(spark: SparkSession, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS") or str(os.cpu_count()))
    spark.sparkContext.setLogLevel("OFF")
    # the first run of each query pays for class loading and code generation
    for name in HEADLINE:
        seconds(spark, name, folder)
    times = {name: round(seconds(spark, name, folder), 3) for name in HEADLINE}
    line = {
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
