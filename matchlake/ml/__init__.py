"""Outcome model: features, random forest, evaluation and scoring."""

from matchlake.ml.evaluation import confusion, evaluate, importances
from matchlake.ml.forest import FEATURES, feature_rows, fit_forest, fit_tasks, load_model, save_model, split
from matchlake.ml.pairings import score_pairings
from matchlake.ml.scoring import score, with_forecast

__all__ = [
    "FEATURES",
    "confusion",
    "evaluate",
    "feature_rows",
    "fit_forest",
    "fit_tasks",
    "importances",
    "load_model",
    "save_model",
    "score",
    "score_pairings",
    "split",
    "with_forecast",
]
