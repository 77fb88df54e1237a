"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line.

Each query runs in full into a no-op sink; the first, untimed query warms the session up.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from paywatch.session import local_session  # noqa: E402
from registry.queries import QUERIES  # noqa: E402

HEADLINE = [
    "clean_transactions", "enrich_accounts", "rolling_counts", "rolling_amounts", "similar_amounts",
    "counterparty_novelty", "unique_receivers", "to_txn_gap", "transaction_features",
    "transaction_features_spread", "validation_report", "numeric_stats", "percentiles_exact",
    "dedupe_keys", "time_split", "stratified_sample", "natural_rate_test", "backtest_windows",
    "time_series_folds", "impute_median", "correlation_pairs", "model_benchmark", "threshold_grid",
    "alert_budget", "topk_pct", "backtest_metrics", "transaction_features_hot", "column_medians", "score_gbt",
    "score_forest", "score_logreg", "tune_random_search", "feature_importance", "stress_test", "predictions_output",
]


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    QUERIES["rolling_counts"](spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": Path(folder).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
