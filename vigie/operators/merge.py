"""Merging several models' scores by priority (J3) and alert lists.

``merge_models`` replaces the reference's chain of m-1 full outer joins by one
union and one aggregation on siret: each input row carries its model's
priority and the first non-null probability wins.  One shuffle whatever m;
a siret has at most m rows, so no group can grow with the data.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigie.functions.features import assign_flag


def merge_models(models: Sequence[DataFrame], key: str = "siret",
                 value: str = "predicted_probability") -> DataFrame:
    """``(siret, predicted_probability)``; for each siret the probability of
    the first model of the list that has a non-null one (sirets whose every
    probability is null are kept with null).  A siret that occurs twice in one
    model is an error when the result is computed: neither score could be
    preferred.  A single model is returned as is.
    """
    models = list(models)
    if not models:
        raise ValueError("no model to merge")
    if len(models) == 1:
        return models[0]
    tagged = None
    for priority, m in enumerate(models):
        part = m.select(F.col(key), F.col(value).cast("double").alias(value),
                        F.lit(priority).alias("__priority"))
        tagged = part if tagged is None else tagged.unionByName(part)
    p = F.col(value)
    merged = tagged.groupBy(key).agg(
        F.min_by(p, F.when(p.isNotNull(), F.col("__priority"))).alias(value),
        (F.count(F.lit(1)) > F.count_distinct("__priority")).alias("__twice"))
    twice = F.raise_error(F.concat(F.lit(f"{key} occurs twice in one model: "), F.col(key).cast("string")))
    # a filter: unlike a column it stays in every plan, also of a count
    return merged.where(F.when(F.col("__twice"), twice.cast("boolean")).otherwise(F.lit(True))).select(key, value)


def flag_scores(df: DataFrame, t_rouge: float, t_orange: float,
                value: str = "predicted_probability", out: str = "alert") -> DataFrame:
    """X6 on a column: 'Alerte seuil F1' / 'Alerte seuil F2' / "Pas d'alerte"."""
    return df.withColumn(out, assign_flag(value, t_rouge, t_orange))


def score_list(df: DataFrame, periode: str, batch: str, algo: str, t_rouge: float, t_orange: float,
               value: str = "predicted_probability") -> DataFrame:
    """P17/S11 records ``{siret, periode, score, batch, algo, alert}``."""
    return flag_scores(df, t_rouge, t_orange, value).select(
        "siret",
        F.lit(periode).alias("periode"),
        F.col(value).alias("score"),
        F.lit(batch).alias("batch"),
        F.lit(algo).alias("algo"),
        "alert",
    )
