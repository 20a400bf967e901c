"""Alert-threshold selection.

* ``fbeta_sweep``: F-beta of ``score >= t`` for every t of a grid (default
  ``linspace(0, 1, 1000)``).  Scores are scored once and bucketed on the grid
  (``Bucketizer``, left-closed, i.e. ``>=``); counts per bucket (at most grid
  size + 1 rows) give every threshold's confusion counts by suffix sums.
* ``thresholds_from_fbeta``: arg-max per beta, ties to the lowest threshold.
* ``thresholds_from_conditions``: lowest threshold meeting a precision, and
  the recall-side threshold as the reference computes it (``mode="reference"``)
  or the highest threshold meeting the recall (``mode="strict"``).
* ``recall_gradient``: first difference of recall over threshold along the
  curve, with type-1 / type-2 errors.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigie.operators.metrics import fbeta_expr, precision_expr, recall_expr
from vigie.operators.ranking import previous_row


def default_grid(n_thr: int = 1000) -> list[float]:
    return [float(t) for t in np.linspace(0, 1, n_thr)]


def fbeta_sweep(df: DataFrame, betas: Sequence[float] = (0.5, 2.0), n_thr: int = 1000,
                thresh: Sequence[float] | None = None, score: str = "score",
                outcome: str = "outcome") -> DataFrame:
    """One row per grid point: threshold, position, tp, fp, fn and f<beta> columns."""
    grid = default_grid(n_thr) if thresh is None else [float(t) for t in thresh]
    if min(grid) < 0 or max(grid) > 1:
        raise ValueError(f"grid outside the range of a probability: {min(grid)} to {max(grid)}")
    points = sorted(set(grid))
    splits = [float("-inf")] + points + [float("inf")]
    y = F.col(outcome).cast("boolean")
    bucketed = Bucketizer(splits=splits, inputCol=score, outputCol="__b", handleInvalid="keep") \
        .transform(df.select(F.col(score).cast("double").alias(score), y.alias("__y")))
    # bucket k >= 1 holds scores in [points[k-1], points[k]); score >= points[j] <=> k >= j + 1
    per_bucket = bucketed.groupBy("__b").agg(
        F.sum(F.when(F.col("__y"), 1).otherwise(0)).cast("long").alias("pos"),
        F.sum(F.when(F.col("__y"), 0).otherwise(1)).cast("long").alias("neg"))
    spark = df.sparkSession
    grid_df = spark.createDataFrame(
        [(i, t, float(points.index(t) + 1)) for i, t in enumerate(grid)],
        "position int, threshold double, __b double")
    # at most len(grid) + 2 rows on both sides: bounded by the grid size.
    suffix = Window.orderBy(F.col("__b").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    buckets = spark.createDataFrame([(float(k),) for k in range(len(splits) - 1)], "__b double") \
        .join(per_bucket, "__b", "left").na.fill(0, ["pos", "neg"])
    cum = buckets.select("__b", F.sum("pos").over(suffix).alias("tp"), F.sum("neg").over(suffix).alias("fp"),
                         F.sum("pos").over(Window.partitionBy()).alias("n_pos"))
    out = grid_df.join(F.broadcast(cum), "__b").select(
        "position", "threshold", "tp", "fp", (F.col("n_pos") - F.col("tp")).alias("fn"))
    p, r = precision_expr(), recall_expr()
    return out.select("*", *[fbeta_expr(b, p, r).alias(_label(b)) for b in dict.fromkeys(betas)])


def _label(beta: float) -> str:
    return "f" + f"{beta:g}".replace(".", "_")


def thresholds_from_fbeta(df: DataFrame, beta_F1: float = 0.5, beta_F2: float = 2.0, n_thr: int = 1000,
                          thresh: Sequence[float] | None = None, score: str = "score",
                          outcome: str = "outcome") -> DataFrame:
    """A11 + A16: one row (t_f1, fbeta_f1, t_f2, fbeta_f2); ties -> first grid position."""
    sweep = fbeta_sweep(df, (beta_F1, beta_F2), n_thr, thresh, score, outcome)
    l1, l2 = _label(beta_F1), _label(beta_F2)
    best = lambda lab: F.max_by(F.struct("threshold", F.col(lab).alias("f")),
                                F.struct(F.col(lab), -F.col("position")))
    row = sweep.agg(best(l1).alias("b1"), best(l2).alias("b2"))
    return row.select(F.col("b1.threshold").alias("t_f1"), F.col("b1.f").alias("fbeta_f1"),
                      F.col("b2.threshold").alias("t_f2"), F.col("b2.f").alias("fbeta_f2"))


def thresholds_from_conditions(curve: DataFrame, min_precision_F1: float = 0.93,
                               min_recall_F2: float = 0.63, mode: str = "reference") -> DataFrame:
    """A12 on a ``pr_curve`` frame (thresholds increasing, final row threshold null).

    F1: lowest threshold whose precision reaches the target; null when only the
    final point (precision 1) does; the lowest threshold when nothing does.

    F2, ``mode="reference"``: let t* be the highest threshold, other than the
    lowest one, whose recall reaches the target; the result is the next lower
    threshold below t*.  When no such t* exists the highest threshold is
    returned, and when the target is <= 0 (the final point qualifies) as well.
    ``mode="strict"``: the highest threshold with recall >= target (null if none).
    """
    if mode not in ("reference", "strict"):
        raise ValueError("mode must be 'reference' or 'strict'")
    p_ok = F.col("precision") >= F.lit(float(min_precision_F1))
    r_ok = F.col("recall") >= F.lit(float(min_recall_F2))
    real = F.col("threshold").isNotNull()
    # one aggregation; recall does not increase with the threshold, so the
    # thresholds meeting the recall form a prefix [t_min .. r_hit].
    st = curve.agg(
        F.min(F.when(real & p_ok, F.col("threshold"))).alias("p_hit"),
        F.max(F.when(~real & p_ok, F.lit(1)).otherwise(0)).alias("final_p_ok"),
        F.min(F.when(real, F.col("threshold"))).alias("t_min"),
        F.max(F.when(real, F.col("threshold"))).alias("t_max"),
        F.max(F.when(real & r_ok, F.col("threshold"))).alias("r_hit"),
    )
    t_f1 = F.when(F.col("p_hit").isNotNull(), F.col("p_hit")) \
        .when(F.col("final_p_ok") == 1, F.lit(None).cast("double")).otherwise(F.col("t_min"))
    if mode == "strict":
        return st.select(t_f1.alias("t_f1"), F.col("r_hit").alias("t_f2"))
    if float(min_recall_F2) <= 0.0:
        return st.select(t_f1.alias("t_f1"), F.col("t_max").alias("t_f2"))
    # the next lower threshold below r_hit
    hit = st.select("r_hit").scalar()
    below = curve.agg(F.max(F.when(real & (F.col("threshold") < hit), F.col("threshold")))).scalar()
    none = F.col("r_hit").isNull() | (F.col("r_hit") <= F.col("t_min"))
    return st.select(t_f1.alias("t_f1"), F.when(none, F.col("t_max")).otherwise(below).alias("t_f2"))


def recall_gradient(curve: DataFrame) -> DataFrame:
    """W4 + X14: per curve threshold (not the lowest): type-1 and type-2 errors
    and (recall - previous recall) / (threshold - previous threshold)."""
    real = curve.filter(F.col("threshold").isNotNull())
    prev = previous_row(real, "threshold", ["recall"])
    return prev.filter(F.col("prev_threshold").isNotNull()).select(
        "threshold", "precision", "recall",
        (F.lit(1.0) - F.col("precision")).alias("type1_error"),
        (F.lit(1.0) - F.col("recall")).alias("type2_error"),
        ((F.col("recall") - F.col("prev_recall")) / (F.col("threshold") - F.col("prev_threshold")))
        .alias("recall_gradient"),
    )


def steepest_recall_drop(gradient: DataFrame, skip_highest: int = 0) -> DataFrame:
    """Threshold where recall falls fastest (arg-min of the gradient), optionally
    ignoring the ``skip_highest`` highest thresholds; one row
    (threshold, precision, recall, recall_gradient)."""
    g = gradient
    if skip_highest > 0:
        # the k highest thresholds: a top-k on a (distinct) threshold column
        top = g.orderBy(F.col("threshold").desc()).limit(skip_highest).select("threshold")
        g = g.join(top, "threshold", "left_anti")
    best = F.min_by(F.struct("threshold", "precision", "recall", "recall_gradient"),
                    F.struct(F.col("recall_gradient"), F.col("threshold")))
    return g.agg(best.alias("b")).select("b.*")
