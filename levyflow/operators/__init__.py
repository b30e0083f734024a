"""DataFrame steps, parametric in their column names."""

from levyflow.operators.features import (
    Scaling,
    assemble,
    drop_invalid,
    feature_stats,
    fit_scaling,
    invalid_counts,
    label_frequencies,
    label_stats,
    moments,
    standardize,
    vector_columns,
    without,
)
from levyflow.operators.metrics import (
    classification_metrics,
    compare_to_base,
    confusion_table,
    majority_metrics,
    regression_metrics,
    stack_runs,
)
from levyflow.operators.ranking import dedupe_by, latest_by, top_k
from levyflow.operators.resampling import classification_draws, draw_weight, intervals, regression_draws, resampled
from levyflow.operators.splitting import key_bucket, random_split, train_test_split
from levyflow.operators.summaries import row_counts, summarize

__all__ = [
    "Scaling",
    "assemble",
    "classification_draws",
    "classification_metrics",
    "compare_to_base",
    "confusion_table",
    "dedupe_by",
    "draw_weight",
    "drop_invalid",
    "feature_stats",
    "fit_scaling",
    "intervals",
    "invalid_counts",
    "key_bucket",
    "label_frequencies",
    "label_stats",
    "latest_by",
    "majority_metrics",
    "moments",
    "random_split",
    "regression_draws",
    "regression_metrics",
    "resampled",
    "row_counts",
    "stack_runs",
    "standardize",
    "summarize",
    "top_k",
    "train_test_split",
    "vector_columns",
    "without",
]
