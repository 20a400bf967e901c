"""Cleaning steps (F10-F14): pure ``DataFrame -> DataFrame`` functions.

pandas keeps a row when a negated predicate meets a missing value; Spark's
three-valued logic would drop it.  Every negated filter is therefore written
``~coalesce(pred, false)`` or as an anti join.
"""

from __future__ import annotations

import logging
from typing import Any, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigie.schema import DEFAULT_DATA_VALUES

log = logging.getLogger(__name__)


def remove_strong_signals(df: DataFrame) -> DataFrame:
    """drop rows already in default (``time_til_outcome <= 0``); null kept."""
    if "time_til_outcome" not in df.columns:
        raise ValueError("strong signals are found by the column time_til_outcome, which is absent")
    return df.filter(~F.coalesce(F.col("time_til_outcome") <= 0, F.lit(False)))


def replace_missing_data(df: DataFrame, defaults_map: dict[str, Any] | None = None) -> DataFrame:
    """fill nulls column by column; columns absent from ``df`` are skipped."""
    defaults = DEFAULT_DATA_VALUES if defaults_map is None else defaults_map
    types = dict(df.dtypes)
    fills = {c: v for c, v in defaults.items() if c in types}
    for c in set(defaults) - set(fills):
        log.debug("Column %s not in dataset", c)
    if not fills:
        return df
    return df.select(*[
        F.coalesce(F.col(c), F.lit(fills[c]).cast(types[c])).alias(c) if c in fills else F.col(c)
        for c in df.columns
    ])


def remove_na(df: DataFrame, ignore: Iterable[str]) -> DataFrame:
    """drop rows with a null (or NaN) in any column outside ``ignore``."""
    ignore = set(ignore)
    subset = [c for c in df.columns if c not in ignore]
    if not subset:
        return df
    return df.na.drop(how="any", subset=subset)


def remove_siren(df: DataFrame, sirens: Any) -> DataFrame:
    """drop rows of the given firms (anti join; a null siren is kept)."""
    if not isinstance(sirens, DataFrame):
        spark = df.sparkSession
        sirens = spark.createDataFrame([(str(s),) for s in sirens], "siren string")
    return df.join(sirens.select("siren").distinct(), "siren", "left_anti")


def remove_administrations(df: DataFrame) -> DataFrame:
    """drop NAF sections O and P (public administration, education); null kept."""
    return df.filter(~F.coalesce(F.col("code_naf").isin("O", "P"), F.lit(False)))
