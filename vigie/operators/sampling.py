"""Seeded row sample (O5) and train/test split.

"Random" here is the md5 of (siret, periode, seed): reproducible across runs,
partitionings and engines (the DuckDB oracle computes the same numbers).  The
split is a per-row predicate: no shuffle, no sort, exact fractions only in
expectation (as ``randomSplit``), but deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigie.operators.dataset import top_n
from vigie.sources.panel import hash_unit


def row_hash(seed: int, keys: tuple[str, ...] = ("siret", "periode")) -> Column:
    return hash_unit(*[F.col(k).cast("string") for k in keys], F.lit(str(seed)))


def sample_rows(df: DataFrame, n: int, seed: int = 0,
                keys: tuple[str, ...] = ("siret", "periode")) -> DataFrame:
    """``n`` rows in seeded hash order (exact for any n, see ``top_n``)."""
    tmp = "__sample_order"
    out = top_n(df.withColumn(tmp, row_hash(seed, keys)), n, score=tmp, ties=keys, descending=False)
    return out.drop(tmp)


def split_column(train_fraction: float = 0.67, seed: int = 42,
                 keys: tuple[str, ...] = ("siret", "periode")) -> Column:
    """'train' when the row hash is below ``train_fraction``, else 'test'."""
    return F.when(row_hash(seed, keys) < F.lit(float(train_fraction)), "train").otherwise("test")


def split_train_test(df: DataFrame, train_fraction: float = 0.67, seed: int = 42,
                     keys: tuple[str, ...] = ("siret", "periode")) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a seeded per-row hash."""
    h = row_hash(seed, keys)
    return df.filter(h < F.lit(float(train_fraction))), df.filter(h >= F.lit(float(train_fraction)))
