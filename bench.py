"""Time the headline queries and print one JSON line.

Each query gets one warm-up run on the smallest tables, so that start-up and code generation
are not counted, then one timed run that writes to the no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from winback import build_session  # noqa: E402
from winback.plans.registry import QUERIES  # noqa: E402

HEADLINE = [
    "churn_labels",
    "logistics_features",
    "monetary_features",
    "review_features",
    "customer_features",
    "stratified_split",
    "scaled_features",
    "metrics_fixed",
    "roc_points_fixed",
    "prob_chart",
    "high_risk_leads",
    "risk_tier_counts",
    "lr_coefficients",
    "lr_leads",
    "churn_by_spend_service",
    "feature_drift_psi",
    "delivery_windows",
    "features_from_csv",
    "tree_stumps",
    "exported_leads",
    "churn_run_leads",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    smallest = str(Path(folder).parent / "sf0.001")
    warm_folder = smallest if Path(smallest).is_dir() else folder
    spark = build_session(
        "winback-bench",
        f"local[{cpus}]",
        **{
            "spark.driver.memory": "12g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in wanted:
        QUERIES[name](spark, warm_folder).write.format("noop").mode("overwrite").save()
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    result = {
        "metric": "total time of headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
