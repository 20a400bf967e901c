"""Distributed global ranks and running sums.

A window with no ``partitionBy`` (or partitioned by a key that may hold a third
of the data) runs in one task.  These helpers split the ordering into ranges
("buckets") that are a monotone function of the sort key, compute per-bucket
totals (a table with at most a few thousand rows), turn them into offsets, and
finish with an ordinary window *inside* each bucket.  Every bucket is a bounded
slice, so the work spreads over the cluster whatever the key distribution.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_TARGET_ROWS_PER_BUCKET = 200_000


def n_buckets(n_rows: int) -> int:
    """Buckets of about _TARGET_ROWS_PER_BUCKET rows each."""
    return max(1, math.ceil(n_rows / _TARGET_ROWS_PER_BUCKET))


def _bucket_by_quantiles(df: DataFrame, order_col: str, n_buckets: int, out: str) -> DataFrame:
    """Bucket = range of ``order_col`` (ties share a bucket), equal-count ranges."""
    probs = [i / n_buckets for i in range(1, n_buckets)]
    cuts = df.approxQuantile(order_col, probs, 1.0 / (4 * n_buckets)) if probs else []
    if not any(c is not None and math.isfinite(c) for c in cuts):
        return df.withColumn(out, F.lit(0.0))  # one bucket
    splits = [float("-inf")] + sorted({c for c in cuts if c is not None and math.isfinite(c)}) + [float("inf")]
    return Bucketizer(splits=splits, inputCol=order_col, outputCol=out,
                      handleInvalid="error").transform(df)


def global_rank(
    df: DataFrame,
    order: list[Column],
    bucket: Column,
    partition_cols: list[str] | None = None,
    out: str = "rank",
) -> DataFrame:
    """1-based ``row_number()`` over ``partition_cols`` ordered by ``order``.

    ``bucket`` must be a non-decreasing function of the first ``order`` key
    (e.g. ``floor(hash * B)`` for a uniform hash order).  The per-(partition,
    bucket) counts form a small table whose running totals give each bucket's
    offset; the final window is partitioned by (partition, bucket).
    """
    parts = list(partition_cols or [])
    b = "__bucket"
    with_b = df.withColumn(b, bucket)
    counts = with_b.groupBy(*parts, b).agg(F.count(F.lit(1)).alias("__n"))
    w_off = (Window.partitionBy(*parts) if parts else Window).orderBy(b)
    offsets = counts.select(
        *parts, b,
        (F.sum("__n").over(w_off.rowsBetween(Window.unboundedPreceding, Window.currentRow))
         - F.col("__n")).alias("__off"),
    )
    # offsets has one row per (partition, bucket): #partitions x #buckets rows.
    joined = with_b.join(offsets, [*parts, b])
    w_in = Window.partitionBy(*parts, b).orderBy(*order)
    return joined.withColumn(out, (F.col("__off") + F.row_number().over(w_in)).cast("long")) \
        .drop(b, "__off")


def ntile_from_rank(rank: Column, total: Column, k: int) -> Column:
    """0-based tile of a 1-based rank: SQL ``ntile(k) - 1`` (larger tiles first)."""
    r0 = rank - 1
    q = F.floor(total / k)
    rem = total - q * k
    big = rem * (q + 1)
    return F.when(r0 < big, F.floor(r0 / (q + 1))).otherwise(
        rem + F.floor((r0 - big) / F.greatest(q, F.lit(1)))).cast("long")


def running_sums(
    df: DataFrame,
    order_col: str,
    sum_cols: list[str],
    descending: bool = True,
    n_rows: int | None = None,
) -> DataFrame:
    """Inclusive running sums of ``sum_cols`` along distinct values of ``order_col``.

    ``df`` must have one row per value of ``order_col`` (group ties first), none
    null or NaN.  Output columns ``cum_<c>``.  Buckets are equal-count ranges
    taken from approximate quantiles, so a dense score region does not overload
    a bucket; a small input is one bucket of the same plan.
    """
    n_rows = n_rows if n_rows is not None else df.count()
    nb = n_buckets(n_rows)
    ordered = F.col(order_col).desc() if descending else F.col(order_col).asc()
    b = "__bucket"
    bucketed = _bucket_by_quantiles(df, order_col, nb, b)
    sign = -1 if descending else 1
    bucketed = bucketed.withColumn(b, F.col(b) * F.lit(float(sign)))
    totals = bucketed.groupBy(b).agg(*[F.sum(c).alias(f"__t_{c}") for c in sum_cols])
    w_off = Window.orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    # one row per bucket, n / _TARGET_ROWS_PER_BUCKET in all
    offsets = totals.select(b, *[F.coalesce(F.sum(f"__t_{c}").over(w_off), F.lit(0)).alias(f"__o_{c}")
                                 for c in sum_cols])
    w_in = Window.partitionBy(b).orderBy(ordered).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = bucketed.join(offsets, b)
    for c in sum_cols:
        out = out.withColumn(f"cum_{c}", F.col(f"__o_{c}") + F.sum(c).over(w_in))
    return out.drop(b, *[f"__o_{c}" for c in sum_cols])


def previous_row(
    df: DataFrame,
    order_col: str,
    value_cols: list[str],
    n_rows: int | None = None,
) -> DataFrame:
    """``lag`` by one row along ascending distinct ``order_col`` values.

    Adds ``prev_<order_col>`` and ``prev_<c>`` (null on the first row).  Inside
    a quantile bucket it is an ordinary ``lag``; the first row of a bucket takes
    the last row of the closest non-empty bucket below, looked up in a table
    of one row per bucket.
    """
    n_rows = n_rows if n_rows is not None else df.count()
    cols = [order_col, *value_cols]
    nb = n_buckets(n_rows)
    b = "__bucket"
    bucketed = _bucket_by_quantiles(df, order_col, nb, b)
    w = Window.partitionBy(b).orderBy(order_col)
    inner = bucketed.select("*", *[F.lag(c).over(w).alias(f"__lag_{c}") for c in cols])
    last = bucketed.groupBy(b).agg(F.max_by(F.struct(*cols), F.col(order_col)).alias("__last"))
    w_b = Window.orderBy(b)
    # one row per bucket
    prev_last = last.select(b, F.lag("__last").over(w_b).alias("__prev"))
    out = inner.join(prev_last, b)
    return out.select(
        *[F.col(c) for c in df.columns],
        *[F.when(F.col(f"__lag_{order_col}").isNull(), F.col(f"__prev.{c}"))
          .otherwise(F.col(f"__lag_{c}")).alias(f"prev_{c}") for c in cols],
    )
