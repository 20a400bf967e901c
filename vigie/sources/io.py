"""File sources and sinks.

All reads and writes go through Spark's readers/writers, so paths may be on any
shared file system the cluster uses.  CSV cannot hold maps or structs: such
columns are written as JSON text.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigie.functions.features import nan_to_null, pad_id
from vigie.operators.dataset import flatten, normalise_ids
from vigie.schema import panel_type


class EmptyFileError(Exception):
    """A file that must hold data is empty."""


def _complex_to_json(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.MapType, T.StructType, T.ArrayType)):
            cols.append(F.to_json(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def read_extract_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """S3: a prepared extract with a header.  Without a schema every column is
    read as text and panel columns are cast to their panel type, so ids keep
    their leading zeros."""
    if schema is not None:
        return spark.read.csv(path, header=True, schema=schema)
    raw = spark.read.csv(path, header=True, inferSchema=False)
    return raw.select(*[F.col(c).cast(panel_type(c)).alias(c) for c in raw.columns])


def write_extract_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """S4."""
    _complex_to_json(df).write.mode(mode).option("header", True).csv(path)


def read_siret_list(spark: SparkSession, path: str) -> DataFrame:
    """One siret per line, no header, extra columns ignored, ids padded to
    14 characters; ``EmptyFileError`` when the file has no line."""
    df = spark.read.csv(path, header=False, schema="siret string")
    df = df.filter(F.col("siret").isNotNull()).select(pad_id("siret", 14).alias("siret"))
    if df.isEmpty():
        raise EmptyFileError(f"no line in {path}")
    return df


def write_predictions(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """Predictions (and explanation columns) as CSV (JSON text for nested
    columns) or parquet."""
    if fmt == "csv":
        _complex_to_json(df).write.mode(mode).option("header", True).csv(path)
    else:
        df.write.mode(mode).format(fmt).save(path)


def read_predictions(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Earlier prediction files (siren and siret stay text)."""
    if fmt == "csv":
        return spark.read.csv(path, header=True,
                              schema="siren string, siret string, predicted_probability double")
    return spark.read.format(fmt).load(path)


def write_stats(spark: SparkSession, stats: dict[str, Any], path: str) -> None:
    """One JSON document (run parameters and metrics)."""
    text = json.dumps(stats, default=str)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_stats(spark: SparkSession, path: str) -> dict[str, Any]:
    return json.loads(spark.read.text(path).first()["value"])


def export_scores(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Score-list records as JSON lines (one object per siret)."""
    df.write.mode(mode).json(path)


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(
        "siret string, periode string, score double, batch string, algo string, alert string").json(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """A ready feature table (Parquet, or JSON lines for a path ending in .json).

    Records may be flat or nested (``{_id: {...}, value: {...}}``); NaN becomes
    null, ``periode`` a date, and ids keep or regain their leading zeros.
    """
    raw = spark.read.json(path) if path.rstrip("/").endswith(".json") else spark.read.parquet(path)
    df = flatten(raw)
    kinds = dict(df.dtypes)
    df = df.withColumns({c: nan_to_null(c) for c, k in kinds.items() if k in ("double", "float")})
    if "periode" in kinds and kinds["periode"] != "date":
        df = df.withColumn("periode", F.to_date("periode"))
    return normalise_ids(df)
