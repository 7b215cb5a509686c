"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set the input
and the local cores. Each time covers building and fully computing the result.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from edops.plans.catalog import QUERIES

HEADLINE = [
    "fixed_width_bronze", "clean_visits", "duplicate_visits", "dq_report", "cohort_rollup",
    "cohort_fallback", "expected_wait", "event_validation", "quarantine", "dq_streaming",
    "late_events", "dedupe_events", "episodes", "active_state", "state_merge",
    "current_ed_state", "ed_kpis", "ed_load_15min", "bi_active_patients", "bi_data_quality",
    "export_manifest", "csv_bronze_vitalsign", "run_metrics", "stream_state",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("edops-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    result = {
        "metric": "total wall-clock of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "rows": {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in ("lineitem", "events", "orders")},
        "spark": {"cores": cpus, "shuffle_partitions": cpus},
    }
    print(json.dumps(result), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
