"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores.
Every query runs once to warm up, then BENCH_RUNS times (default 2) for the median;
its rows are written to the no-op sink, so that all are computed and none collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from linkrisk.catalog import QUERIES  # noqa: E402
from linkrisk.session import build_session  # noqa: E402

HEADLINE = [
    "exclude_scanned",
    "balanced_sample",
    "balanced_sample_lines",
    "sample_exact",
    "class_quota_rank",
    "assign_batches",
    "first_seen_dedupe",
    "dense_id_1based",
    "read_url_feed",
    "upsert_table",
    "scan_features_table",
    "process_batch",
    "stratified_split",
    "fully_balanced_split",
    "stratified_kfold",
    "column_medians_lines",
    "zscore",
    "prepare_data",
    "compare_models",
    "roc_auc_lines",
    "classification_report",
    "extract_urls_from_domains",
    "explode_domain_urls",
    "resolve_attempts",
    "batch_outcome_counts",
    "incremental_scan",
    "scan_round",
    "gaussian_nb_score",
    "knn",
    "logistic_regression",
    "batch_score",
]
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = os.environ.get("BENCH_QUERIES")
    settings = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = build_session("bench", f"local[{cpus}]", **settings)
    spark.sparkContext.setLogLevel("OFF")
    seconds = {}
    for name in only.split(",") if only else HEADLINE:
        times = []
        for _ in range(RUNS + 1):
            start = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.time() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
