"""Firm-level leakage control (J1, F18) and siren-grouped folds.

Firms (sirens) are the unit: a firm seen in training never appears in testing.
Folds: the distinct training sirens are ordered by a seeded md5 and cut into k
parts of sizes differing by at most one (larger parts first, as ``ntile``).
The global rank behind the cut is computed with ``ranking.global_rank``
(uniform hash buckets + offsets), so no step runs in a single task.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigie.operators.ranking import global_rank, n_buckets, ntile_from_rank
from vigie.session import written_table
from vigie.sources.panel import hash_unit


def distinct_sirens(df: DataFrame) -> DataFrame:
    """distinct firms (an aggregation, never collected)."""
    return df.select("siren").distinct()


def exclude_train_firms(test: DataFrame, train: DataFrame) -> DataFrame:
    """Test rows whose firm does not occur in ``train`` (null siren kept)."""
    return test.join(distinct_sirens(train), "siren", "left_anti")


def _check_fold_args(train: DataFrame, test: DataFrame, num_folds) -> None:
    if "siren" not in train.columns or "siren" not in test.columns:
        raise ValueError("both sets need the firm id, column siren")
    # "fewer rows than folds" only needs up to k rows of each set
    k = math.ceil(num_folds) if isinstance(num_folds, (int, float)) and num_folds > 0 else 0
    if train.limit(k).count() < num_folds or test.limit(k).count() < num_folds:
        raise ValueError(f"{num_folds} folds, but one of the sets has fewer rows")
    if isinstance(num_folds, bool) or not isinstance(num_folds, int) or num_folds <= 0:
        raise ValueError(f"number of folds: {num_folds!r} is not a whole number above 0")


def siren_folds(train: DataFrame, test: DataFrame, num_folds: int, seed: int = 0,
                check: bool = True) -> DataFrame:
    """``(siren, fold)`` for every distinct training siren, fold in 0..k-1."""
    if check:
        _check_fold_args(train, test, num_folds)
    sirens = distinct_sirens(train).filter(F.col("siren").isNotNull())
    sirens = written_table(sirens.withColumn("__h", hash_unit(F.col("siren"), F.lit(str(seed)))), "sirens")
    # the total enters the tile arithmetic several times: one number, fetched once
    n = sirens.count()
    # uniform hash ranges, as many as the firms need
    ranked = global_rank(sirens, [F.col("__h"), F.col("siren")],
                         F.floor(F.col("__h") * n_buckets(n)), out="__rank")
    folds = ranked.select("siren", ntile_from_rank(F.col("__rank"), F.lit(n), num_folds).alias("fold"))
    return written_table(folds, "folds")  # every fold's sets read this table


def with_fold(df: DataFrame, folds: DataFrame) -> DataFrame:
    """``df`` with the fold of its firm (null for a firm in no fold): one join for all folds."""
    return df.join(folds, "siren", "left")


def fold_sets(train: DataFrame, test: DataFrame, folds: DataFrame, fold: int) -> tuple[DataFrame, DataFrame]:
    """(train_on, test_on) of one fold: training rows of firms outside the
    fold, test rows of firms inside it (test firms unknown to training are in
    no fold).  Sets that already carry the fold (``with_fold``) are only
    filtered; the fold column does not stay."""
    of = lambda df: df if "fold" in df.columns else with_fold(df, folds)
    inside = F.coalesce(F.col("fold") == fold, F.lit(False))
    return of(train).where(~inside).drop("fold"), of(test).where(inside).drop("fold")


def fold_sizes(train: DataFrame, test: DataFrame, folds: DataFrame, num_folds: int) -> DataFrame:
    """Rows of every fold's train_on / test_on, from two aggregations."""
    spark = train.sparkSession
    all_folds = spark.range(num_folds).select(F.col("id").cast("long").alias("fold"))
    tr = train.join(folds, "siren").groupBy("fold").agg(F.count(F.lit(1)).alias("n_train_in"))
    te = test.join(folds, "siren").groupBy("fold").agg(F.count(F.lit(1)).alias("n_test_on"))
    n_train = train.agg(F.count(F.lit(1))).scalar()
    return (all_folds.join(tr, "fold", "left").join(te, "fold", "left")
            .select("fold",
                    (n_train - F.coalesce("n_train_in", F.lit(0))).alias("n_train_on"),
                    F.coalesce("n_test_on", F.lit(0)).cast("long").alias("n_test_on")))
