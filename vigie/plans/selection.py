"""Threshold selection and evaluation on a scored validation set (the
reference's threshold-selection workflow): pick the two alert thresholds by
F-beta sweep or by precision/recall conditions, then evaluate at each."""

from __future__ import annotations

from pyspark.sql import DataFrame

from vigie.operators.metrics import evaluate_dict, pr_curve
from vigie.operators.thresholds import thresholds_from_conditions, thresholds_from_fbeta


def select_alert_thresholds(scored: DataFrame, method: str = "fbeta", beta_F1: float = 0.5,
                            beta_F2: float = 2.0, n_thr: int = 1000, min_precision_F1: float = 0.93,
                            min_recall_F2: float = 0.63, score: str = "score",
                            outcome: str = "outcome") -> dict:
    """{"t_f1", "t_f2", "eval_f1", "eval_f2"}; ``method`` is "fbeta" or "conditions"."""
    if method == "fbeta":
        row = thresholds_from_fbeta(scored, beta_F1, beta_F2, n_thr, score=score, outcome=outcome).first()
    elif method == "conditions":
        row = thresholds_from_conditions(pr_curve(scored, score, outcome), min_precision_F1, min_recall_F2).first()
    else:
        raise ValueError("method must be 'fbeta' or 'conditions'")
    out = {"t_f1": row["t_f1"], "t_f2": row["t_f2"]}
    if out["t_f1"] is not None:
        out["eval_f1"] = evaluate_dict(scored, beta_F1, out["t_f1"], score, outcome)
    if out["t_f2"] is not None:
        out["eval_f2"] = evaluate_dict(scored, beta_F2, out["t_f2"], score, outcome)
    return out
