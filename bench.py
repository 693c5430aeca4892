"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]: all once to warm up, then the median of three runs each."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from registry import all_queries  # noqa: E402

HEADLINE = (
    "cdc_delta", "cdc_delta_composite", "cdc_op_counts", "scd2_close", "scd2_apply", "scd2_advance", "scd2_pk_violations", "conform_stg",
    "dq_validate_file", "dq_reject_filter", "dq_checks_run", "dq_duplicate_groups", "dq_log_report",
    "hub_load_incremental", "hub_load_composite", "link_load_incremental", "link_min_keys", "sat_load_changed",
    "sat_load_hot_key", "sat_latest", "bv_link_load", "vault_link_orphans", "model_hubs", "model_links", "dict_fk",
    "profile_histogram", "profile_value_counts", "profile_describe",
)
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = all_queries(), {}

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in HEADLINE:
        run(name)
    for name in HEADLINE:
        seconds[name] = round(statistics.median(run(name) for _ in range(RUNS)), 3)
    print(json.dumps({
        "metric": "headline_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
