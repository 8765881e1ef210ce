"""Time the headline queries and print one JSON line.

Every query is written to the no-op sink, so all rows and columns are computed. Column
and aggregate work: median of three runs after a warm-up. Model training: the better of two
runs after a warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from fitloom.plans.catalog import QUERIES
from fitloom.session import available_cores, build_session

REPEATED = [
    "calendar_features",
    "log_roundtrip",
    "strip_text_line_ends",
    "join_inner_labels",
    "lookup_map",
    "column_concat_keyed",
    "select_by_cardinality",
    "median_per_column",
    "mode_per_column",
    "metric_logloss",
    "metric_auc",
    "metric_rmsle",
    "split_hash",
    "split_exact",
    "standard_scale",
    "impute_median",
    "ordinal_encode",
    "one_hot",
    "frequency_encode_train_only",
    "encode_mixed",
    "csv_multifile",
    "synthetic_table",
]
TRAINED = ["fit_predict_forest", "fit_predict_regression", "two_target_learner"]


def seconds(spark, folder: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session("bench", available_cores())
    times = {}
    for name in REPEATED:
        seconds(spark, folder, name)
        times[name] = round(statistics.median(seconds(spark, folder, name) for _ in range(3)), 3)
    for name in TRAINED:
        seconds(spark, folder, name)
        times[name] = round(min(seconds(spark, folder, name) for _ in range(2)), 3)
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cores": available_cores(),
        "spark": spark.version,
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
