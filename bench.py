"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from cdcflow.plans.all_queries import QUERIES  # noqa: E402

HEADLINE = [
    "emit_after_images",
    "capture_from_properties",
    "latest_offsets",
    "resolve_table_ids",
    "row_to_named_cells",
    "effective_image",
    "keyset_page",
    "offset_page",
    "snapshot_handoff",
    "word_count",
    "running_word_count",
    "flatten_nested_json",
    "decode_integers",
    "decode_decimals",
    "decode_datetimes",
    "decode_table_columns",
    "decode_mixed_cells",
    "keyed_agg",
    "join_inner",
    "dynamic_filter",
    "data_quality",
    "stream_word_count",
    "stream_emit",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_type").count().collect()  # start-up
    times = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": float(sf)}))
    spark.stop()


if __name__ == "__main__":
    main()
