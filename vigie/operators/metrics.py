"""Evaluation of scores against outcomes.

Input: a DataFrame with a boolean ``outcome`` and a double ``score``.  The curve
metrics read it once, into a written table of distinct scores with their
counts; running totals over that table in descending order come from
``ranking.running_sums`` (bucketed by score quantiles, never a single-partition
window over the rows).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigie.functions.features import check_flag_thresholds, round_to
from vigie.operators.ranking import running_sums
from vigie.session import written_table


def _is_pos(outcome: str) -> Column:
    return F.col(outcome).cast("boolean")


def _count_if(cond: Column) -> Column:
    """Rows where ``cond`` holds (0, not null, on an empty input)."""
    return F.count(F.when(cond, F.lit(1)))


def confusion(df: DataFrame, thresh: float = 0.5, score: str = "score",
              outcome: str = "outcome") -> DataFrame:
    """One row (tn, fp, fn, tp); predicted positive when ``score >= thresh``."""
    pred = F.col(score) >= F.lit(float(thresh))
    y = _is_pos(outcome)
    return df.agg(
        _count_if(~y & ~pred).alias("tn"),
        _count_if(~y & pred).alias("fp"),
        _count_if(y & ~pred).alias("fn"),
        _count_if(y & pred).alias("tp"),
    )


def _safe_ratio(num: Column, den: Column) -> Column:
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def precision_expr(tp="tp", fp="fp") -> Column:
    return _safe_ratio(F.col(tp), F.col(tp) + F.col(fp))


def recall_expr(tp="tp", fn="fn") -> Column:
    return _safe_ratio(F.col(tp), F.col(tp) + F.col(fn))


def fbeta_expr(beta: float, precision: Column, recall: Column) -> Column:
    """(1+b^2) P R / (b^2 P + R), 0 when undefined."""
    b2 = float(beta) ** 2
    return _safe_ratio((1.0 + b2) * precision * recall, b2 * precision + recall)


def with_classification_metrics(counts: DataFrame, beta: float) -> DataFrame:
    """Precision, recall, F-beta and balanced accuracy from (tn, fp, fn, tp)."""
    p, r = precision_expr(), recall_expr()
    specificity = _safe_ratio(F.col("tn"), F.col("tn") + F.col("fp"))
    return counts.select(
        "*",
        p.alias("precision"),
        r.alias("recall"),
        fbeta_expr(beta, p, r).alias("fbeta"),
        ((r + specificity) / 2.0).alias("balanced_accuracy"),
    )


def score_counts(df: DataFrame, score: str = "score", outcome: str = "outcome", keys: Sequence[str] = ()) -> DataFrame:
    """(keys.., threshold, tp_at, fp_at): distinct scores with their positive / negative counts (ties collapsed).

    Rows without a score (null or NaN) or without an outcome take no part.
    """
    y, s = _is_pos(outcome), F.col(score).cast("double")
    return df.where(s.isNotNull() & ~F.isnan(s) & y.isNotNull()).groupBy(*keys, s.alias("threshold")).agg(
        _count_if(y).alias("tp_at"), _count_if(~y).alias("fp_at"))


def score_table(df: DataFrame, score: str = "score", outcome: str = "outcome") -> DataFrame:
    """``score_counts`` written once: whatever is derived from it re-reads this small table, not the input."""
    return written_table(score_counts(df, score, outcome), "scores")


def _cumulative(table: DataFrame) -> DataFrame:
    """Per distinct score s: tps/fps = counts of positives/negatives with score >= s."""
    cum = running_sums(table, "threshold", ["tp_at", "fp_at"], descending=True)
    return cum.withColumnRenamed("cum_tp_at", "tps").withColumnRenamed("cum_fp_at", "fps")


def cumulative_curve(df: DataFrame, score: str = "score", outcome: str = "outcome") -> DataFrame:
    """``_cumulative`` of the score table of ``df``."""
    return _cumulative(score_table(df, score, outcome))


def average_precision_of(table: DataFrame) -> DataFrame:
    """A8 on a table of distinct scores and counts."""
    n_pos = table.agg(F.coalesce(F.sum("tp_at"), F.lit(0))).scalar()
    term = (F.col("tp_at") / n_pos) * (F.col("tps") / (F.col("tps") + F.col("fps")))
    return _cumulative(table).agg(F.coalesce(F.sum(F.when(n_pos > 0, term)), F.lit(0.0)).alias("average_precision"))


def average_precision(df: DataFrame, score: str = "score", outcome: str = "outcome") -> DataFrame:
    """Step-wise area under the precision-recall curve,
    sum over distinct thresholds of (R_n - R_(n-1)) * P_n."""
    return average_precision_of(score_table(df, score, outcome))


def pr_curve(df: DataFrame, score: str = "score", outcome: str = "outcome") -> DataFrame:
    """A10: (threshold, precision, recall) for thresholds from the highest one
    that still has full recall upwards, plus the final point (null, 1, 0)."""
    return curve_of(score_table(df, score, outcome))


def curve_of(table: DataFrame) -> DataFrame:
    """A10 on a table of distinct scores and counts (``score_table``, ``curves.curve_table``)."""
    # The highest threshold at which every positive is already counted is the
    # lowest score of a positive.
    whole = table.agg(F.sum("tp_at").alias("n_pos"), F.min(F.when(F.col("tp_at") > 0, F.col("threshold"))).alias("cut"))
    n_pos, cut = whole.select("n_pos").scalar(), whole.select("cut").scalar()
    curve = _cumulative(table).filter(F.col("threshold") >= cut).select(
        "threshold",
        F.coalesce(F.try_divide(F.col("tps").cast("double"), (F.col("tps") + F.col("fps")).cast("double")),
                   F.lit(0.0)).alias("precision"),
        F.try_divide(F.col("tps").cast("double"), n_pos.cast("double")).alias("recall"),
    )
    last = table.sparkSession.createDataFrame([(None, 1.0, 0.0)], "threshold double, precision double, recall double")
    return curve.unionByName(last)


def evaluate(df: DataFrame, beta: float, thresh: float = 0.5, score: str = "score",
             outcome: str = "outcome") -> DataFrame:
    """One row with aucpr, balanced_accuracy, tn, fp, fn, tp, f<beta>,
    precision, recall; the input is read once, for the score table."""
    return evaluate_table(score_table(df, score, outcome), beta, thresh)


def evaluate_table(table: DataFrame, beta: float, thresh: float = 0.5) -> DataFrame:
    """A9 on a table of distinct scores and counts."""
    above = F.col("threshold") >= F.lit(float(thresh))
    count = lambda c, cond: F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0)).cast("long")
    counts = table.agg(count("fp_at", ~above).alias("tn"), count("fp_at", above).alias("fp"),
                       count("tp_at", ~above).alias("fn"), count("tp_at", above).alias("tp"))
    m = with_classification_metrics(counts, beta)
    ap = average_precision_of(table).scalar()
    label = f"f{beta:g}".replace(".", "_")
    return m.select(
        ap.alias("aucpr"), "balanced_accuracy", "tn", "fp", "fn", "tp",
        F.col("fbeta").alias(label), "precision", "recall")


def evaluate_dict(df: DataFrame, beta: float, thresh: float = 0.5, score: str = "score",
                  outcome: str = "outcome") -> dict:
    """``evaluate`` collected as the reference's dictionary (one small row)."""
    row = evaluate(df, beta, thresh, score, outcome).first().asDict()
    label = f"f{beta:g}".replace(".", "_")
    return {
        "aucpr": row["aucpr"],
        "balanced_accuracy": row["balanced_accuracy"],
        "confusion_matrix": {k: row[k] for k in ("tn", "fp", "fn", "tp")},
        f"f{beta}": row[label],
        "precision": row["precision"],
        "recall": row["recall"],
    }


def class_balance(df: DataFrame, outcome: str = "outcome") -> DataFrame:
    """A5: rows per outcome and their share in percent."""
    counts = df.groupBy(outcome).agg(F.count(F.lit(1)).alias("n_rows"))
    total = F.sum("n_rows").over(Window.partitionBy())  # one row per outcome
    return counts.select(outcome, "n_rows", (F.col("n_rows") * 100.0 / total).alias("percent"))


def alert_counts(df: DataFrame, t_f1: float, t_f2: float, score: str = "predicted_probability") -> DataFrame:
    """A4: red (> t_f1) and orange (> t_f2 but not red) counts and shares (2 decimals)."""
    check_flag_thresholds(t_f1, t_f2)
    p = F.col(score)
    agg = df.agg(
        F.count(F.lit(1)).alias("n_total"),
        _count_if(p > F.lit(float(t_f1))).alias("n_red"),
        _count_if(p > F.lit(float(t_f2))).alias("n_above_f2"),
    )
    return agg.select(
        "n_total", "n_red",
        (F.col("n_above_f2") - F.col("n_red")).alias("n_orange"),
        round_to(F.col("n_red") / F.col("n_total") * 100.0, 2).alias("pct_red"),
        round_to((F.col("n_above_f2") - F.col("n_red")) / F.col("n_total") * 100.0, 2).alias("pct_orange"),
    )
