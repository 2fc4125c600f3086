"""Per-series forecasting: frames, splits, folds and scores are DataFrame operators;
only the least-squares fit of one series runs in Python, inside Spark tasks."""

from tidemark.forecast.events import Event, event_features, event_table_features, events_table
from tidemark.forecast.fit import forecast
from tidemark.forecast.frame import frame_of, future_frame, model_frame, shift_regressors, split_by_time
from tidemark.forecast.grid import DEFAULT_GRID, Config, with_configs
from tidemark.forecast.score import best_config, cv_scores, forecast_errors, forecast_metrics, with_errors
from tidemark.forecast.folds import fold_sizes, with_folds
from tidemark.forecast.validate import cross_validate, cv_summary

__all__ = [
    "Config",
    "DEFAULT_GRID",
    "Event",
    "best_config",
    "cross_validate",
    "cv_scores",
    "cv_summary",
    "event_features",
    "event_table_features",
    "events_table",
    "fold_sizes",
    "forecast",
    "forecast_errors",
    "forecast_metrics",
    "frame_of",
    "future_frame",
    "model_frame",
    "shift_regressors",
    "split_by_time",
    "with_configs",
    "with_errors",
    "with_folds",
]
