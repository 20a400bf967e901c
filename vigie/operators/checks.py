"""Checks whose counts are taken in the pass that writes a table.

``Checks`` puts named counts on DataFrames (``DataFrame.observe``) and hands them out
once the table that derives from them was written.  No scan runs for a check alone,
and a check can't be pruned away with a column that nobody reads.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from vigie.operators.dataset import EmptyDataset
from vigie.session import written_table


class Checks:
    def __init__(self) -> None:
        self._seen: dict[str, tuple[Observation, DataFrame, list[Column]]] = {}

    def on(self, df: DataFrame, name: str, **aggregates: Column) -> DataFrame:
        """``df`` unchanged; its rows and the given aggregates are noted while it is read."""
        noted = [F.count(F.lit(1)).alias("rows"), *[a.alias(n) for n, a in aggregates.items()]]
        observation = Observation(f"{name}-{uuid.uuid4().hex}")
        self._seen[name] = observation, df, noted
        return df.observe(observation, *noted)

    def written(self, df: DataFrame, tag: str) -> tuple[DataFrame, dict[str, dict]]:
        """``df`` as a written table, and what was noted on the way: {name: {"rows": n, ...}}."""
        table = written_table(df, tag)
        return table, {name: self._noted(*x) for name, x in self._seen.items()}

    @staticmethod
    def _noted(observation: Observation, df: DataFrame, aggregates: list[Column]) -> dict:
        try:
            return observation.get
        except Py4JJavaError:
            # Spark left this part of the plan out, having found that nothing can come of it
            return df.agg(*aggregates).first().asDict()


def require_rows(rows: int, what: str) -> None:
    """F15 on a noted count."""
    if not rows:
        raise EmptyDataset(f"no row matches: {what}")
