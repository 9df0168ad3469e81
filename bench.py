"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the number of local cores. Each query
runs once to warm up and then ``BENCH_REPEATS`` times; the best time counts. Results are written to
a no-op sink, so every row is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

from rtml.session import get_spark
from rtml.suite import QUERIES

HEADLINE = [
    "ecci_features", "tfd_features", "eta_features", "customer_rfm", "canned_group_avg",
    "canned_top_merchants", "guarded_sql_result", "grid_search_sort_page", "json_flatten_known",
    "timestamp_parts", "haversine_baseline", "label_dictionary", "apply_dictionary_zero",
    "standard_scale", "running_scale", "class_weights", "stratified_split", "kfold_counts",
    "cluster_feature_counts", "cluster_top_values", "describe_numeric", "bucket_histogram",
    "session_ids", "session_funnel", "running_accuracy_every_100", "rolling_mae_1000",
    "time_rolling_mae_5m", "block_rolling_auc", "class_metrics", "classification_report", "roc_auc",
    "threshold_table", "prob_losses", "regression_metrics", "d2_scores", "inertia",
    "silhouette_by_cluster", "correlation_matrix", "mutual_information", "token_frequency",
    "word_dispersion", "run_leaderboard", "counter_rate_5m", "alert_intervals",
    "stream_ingest_roundtrip",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = get_spark("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                      spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        best = None
        for attempt in range(repeats + 1):
            started = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            spent = time.perf_counter() - started
            if attempt and (best is None or spent < best):
                best = spent
        times[name] = round(best, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
