"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local threads and
``BENCH_RUNS`` the timed runs per query (median), after one warm-up run.
Queries that train models take one timed run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from feedmill.session import build_session
from workloads.catalog import ENTRIES

HEADLINE = [
    "csv_scan", "json_roundtrip", "loan_silver", "marketing_silver", "marketing_silver_from_csv",
    "balance_hist", "price_hist", "count_by_two", "count_by_outcome", "class_balance", "class_weight",
    "feed_chunks", "hot_key_ordinals", "ordered_cap", "ordered_cap_narrowed", "holdout_split",
    "category_index", "category_index_wide", "feature_scaled", "loan_gold", "marketing_gold",
    "metrics_class", "metrics_auc", "model_report", "grade_risk", "asset_bands", "job_groups",
    "education_outcome", "chart_rows", "fan_out_mart", "stream_ingest", "bronze_to_report",
]
TRAINING = ["forest_report", "logit_cv_report"]


def timed(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    ENTRIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        timed(spark, name, sf_dir)
        seconds[name] = round(statistics.median(timed(spark, name, sf_dir) for _ in range(runs)), 3)
        print(f"{name:30s} {seconds[name]:8.3f}", file=sys.stderr, flush=True)
    for name in TRAINING:
        seconds[name] = round(timed(spark, name, sf_dir), 3)
        print(f"{name:30s} {seconds[name]:8.3f}", file=sys.stderr, flush=True)
    report = {
        "metric": "headline query seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
