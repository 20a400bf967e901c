"""Curve states that merge.

A state holds, per month and distinct score, the numbers of positives and negatives.
States add up: the curve of any months is that of their summed states, whatever order
they came in, so a new month costs one pass over that month and the scored rows of
earlier months are not read again.  Scores can be rounded to bound a state's rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigie.functions.features import round_to
from vigie.operators.metrics import score_counts

STATE = "periode date, threshold double, tp_at long, fp_at long"


def month_states(df: DataFrame, score: str = "score", outcome: str = "outcome", month: str = "periode",
                 digits: int | None = None) -> DataFrame:
    """(periode, threshold, tp_at, fp_at) of scored rows; a row without score, outcome or month takes no part.

    ``digits``: round scores, so that a month's state has at most 10^digits + 1 rows.
    """
    if digits is not None:
        df = df.withColumn(score, round_to(score, digits))
    first = F.to_date(F.date_trunc("month", F.col(month)))
    return score_counts(df.withColumn("__month", first).where("__month is not null"), score, outcome, ["__month"]) \
        .withColumnRenamed("__month", "periode")


def merge_states(*states: DataFrame) -> DataFrame:
    """The sum of states (rows of one month may be spread over several)."""
    both = reduce(DataFrame.unionByName, states)
    return both.groupBy("periode", "threshold").agg(F.sum("tp_at").alias("tp_at"), F.sum("fp_at").alias("fp_at"))


def curve_table(states: DataFrame, date_min: str | None = None, date_max: str | None = None) -> DataFrame:
    """Distinct scores with their counts over ``date_min <= periode < date_max``: input of the curve metrics.

    The bounds are partition filters on a ``StateStore``.
    """
    if date_min is not None:
        states = states.where(F.col("periode") >= F.lit(date_min).cast("date"))
    if date_max is not None:
        states = states.where(F.col("periode") < F.lit(date_max).cast("date"))
    return states.groupBy("threshold").agg(F.sum("tp_at").alias("tp_at"), F.sum("fp_at").alias("fp_at"))


class StateStore:
    """States by month in a folder of the shared store; a month that is put again is replaced."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def put(self, states: DataFrame) -> None:
        """Replace the months of ``states`` (which must be merged: one row per month and score)."""
        (states.hint("rebalance", "periode").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("periode").parquet(self.path))

    def read(self) -> DataFrame:
        return self.spark.read.schema(STATE).parquet(self.path).select("periode", "threshold", "tp_at", "fp_at")
