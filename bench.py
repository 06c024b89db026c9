"""Time the queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and print one JSON line.

Each query runs once to warm up and $BENCH_RUNS times (default 3) measured; the
median counts. A run builds the query and writes the whole result to the no-op sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from tidemark.session import SETTINGS  # noqa: E402
from tidemark.workload.queries import QUERIES  # noqa: E402

HEADLINE = [
    "q_schema_enforce", "q_clickstream_silver", "q_loan_dpd", "q_attr_clean", "q_currency_clean", "q_label_store",
    "q_default_rate", "q_p97_cap", "q_fin_features", "q_engagement_pivot", "q_risk_store", "q_training_set",
    "q_stratified_split", "q_stratified_folds", "q_standardise", "q_exact_deciles", "q_score_summary", "q_auc_gini",
    "q_auc_by_split", "q_psi_two_sample", "q_psi_equal_width", "q_csi_features", "q_baseline_table",
    "q_psi_vs_baseline", "q_drift_flags", "q_perf_breach", "q_metrics_last_wins", "q_train_gate",
    "q_profile_nulls", "q_profile_top", "q_profile_hist",
]


def session(cpus: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("tidemark-bench")
    for key, value in {
        **SETTINGS, "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": os.environ.get("BENCH_MEMORY", "5g"),
    }.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES")
    spark = session(cpus)
    times = {}
    for name in names.split(",") if names else HEADLINE:
        spent = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            spent.append(time.perf_counter() - start)
        times[name] = round(statistics.median(spent[1:]), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "sum of median query times", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus), "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
