"""Customer-retention analytics on Spark."""

from winback.operators.charts import (
    coefficient_chart,
    confusion_matrix_table,
    probability_chart,
    probability_density,
    probability_histogram,
    probability_stats,
    roc_curve_table,
    top_risk_factors,
)
from winback.operators.evaluate import churn_probability, evaluate_models, evaluate_predictions, roc_auc, roc_chart, roc_points
from winback.operators.features import FEATURES, build_features
from winback.operators.labels import churn_rate_report, generate_churn_labels
from winback.operators.leads import generate_leads, tier_counts, top_leads, with_risk_tier
from winback.operators.models import get_model_coefficients, train_baseline_models
from winback.operators.prepare import ModelInput, RobustScale, split_and_scale
from winback.plans.churn_run import ChurnRun, run_churn
from winback.session import build_session
from winback.sources import (
    ShopTables,
    load_and_clean_data,
    load_tables,
    load_warehouse,
    save_tables,
    write_leads,
)

__all__ = [
    "ChurnRun",
    "FEATURES",
    "ModelInput",
    "RobustScale",
    "ShopTables",
    "build_features",
    "build_session",
    "churn_probability",
    "churn_rate_report",
    "coefficient_chart",
    "confusion_matrix_table",
    "evaluate_models",
    "evaluate_predictions",
    "generate_churn_labels",
    "generate_leads",
    "get_model_coefficients",
    "load_and_clean_data",
    "load_tables",
    "load_warehouse",
    "probability_chart",
    "probability_density",
    "probability_histogram",
    "probability_stats",
    "roc_auc",
    "roc_chart",
    "roc_curve_table",
    "roc_points",
    "run_churn",
    "save_tables",
    "split_and_scale",
    "tier_counts",
    "top_leads",
    "top_risk_factors",
    "train_baseline_models",
    "with_risk_tier",
    "write_leads",
]
