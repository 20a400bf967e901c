"""Broken input is set aside with its reasons.

Text files are read with every column as text and Spark's corrupt-record column, so no
line is lost and none stops the read.  A line is broken when its number of fields is
wrong, when a value is not of its column's type, or when a rule of the file's kind
fails.  Broken lines keep their text and file; the rest goes on, typed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigie.functions.features import pad_id
from vigie.operators.checks import Checks
from vigie.schema import panel_type

_LINE, _FILE, _REASONS = "__line", "__file", "__reasons"


@dataclass
class Checked:
    """``good``: typed rows; ``broken``: file, line, reasons; the counts were taken in the pass that read the files."""

    good: DataFrame
    broken: DataFrame
    n_good: int
    n_broken: int


def siret_rules(column: str = "siret", width: int = 14) -> dict[str, Column]:
    """Reasons why an id can't be used: {reason: condition}."""
    c = F.trim(F.col(column))
    return {f"{column} is missing": c.isNull() | (c == ""),
            f"{column} is not a number": ~c.rlike("^[0-9]*$"),
            f"{column} is longer than {width}": F.length(c) > width}


def _typed(column: str, kind: T.DataType) -> Column:
    text = F.trim(F.col(column))
    if isinstance(kind, T.StringType):
        return F.col(column)
    if isinstance(kind, T.BooleanType):
        return F.when(F.lower(text) == "true", True).when(F.lower(text) == "false", False)
    return text.try_cast(kind)


def read_checked(spark: SparkSession, path: str, columns: dict[str, T.DataType] | None = None, header: bool = True,
                 rules: dict[str, Column] | None = None, exact: bool = True) -> Checked:
    """Read CSV files; ``columns``: names and types (default: the header's names, with the panel's types).

    ``rules``: {reason: condition on the text columns}; a line is broken where the
    condition holds.  ``exact`` False allows fields beyond ``columns`` (lists).  Empty
    text is null and fits every type.  The lines are read once, into a written table.
    """
    if columns is None:
        columns = {c: panel_type(c) for c in spark.read.csv(path, header=True, inferSchema=False).columns}
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, _LINE]])
    raw = spark.read.csv(path, header=header, schema=schema, mode="PERMISSIVE", columnNameOfCorruptRecord=_LINE, enforceSchema=True)
    raw = raw.select("*", F.col("_metadata.file_path").alias(_FILE))
    values = {c: _typed(c, t) for c, t in columns.items()}
    reasons = []
    if exact:
        reasons.append(F.when(F.col(_LINE).isNotNull(), F.lit("wrong number of fields")))
    for c, t in columns.items():
        reasons.append(F.when((F.trim(F.col(c)) != "") & values[c].isNull(), F.lit(f"{c} is not a {t.simpleString()}")))
    for reason, condition in (rules or {}).items():
        reasons.append(F.when(condition, F.lit(reason)))
    line = F.coalesce(F.col(_LINE), F.to_csv(F.struct(*[F.col(c) for c in columns])))
    rows = raw.select(*[v.alias(c) for c, v in values.items()], line.alias(_LINE), F.col(_FILE), F.array_compact(F.array(*reasons)).alias(_REASONS))
    checks = Checks()
    bad = F.size(_REASONS) > 0
    table, noted = checks.written(checks.on(rows, "lines", broken=F.count(F.when(bad, F.lit(1)))), "checked")
    broken = table.where(bad).select(F.col(_FILE).alias("file"), F.col(_LINE).alias("line"), F.col(_REASONS).alias("reasons"))
    n_broken = noted["lines"]["broken"]
    return Checked(table.where(~bad).select(*columns), broken, noted["lines"]["rows"] - n_broken, n_broken)


def read_extract_checked(spark: SparkSession, path: str) -> Checked:
    """S3: a prepared extract; a line without a usable siret (where there is such a column) is broken."""
    names = spark.read.csv(path, header=True, inferSchema=False).columns
    return read_checked(spark, path, {c: panel_type(c) for c in names}, rules=siret_rules() if "siret" in names else None)


def read_siret_list_checked(spark: SparkSession, path: str) -> Checked:
    """A list of sirets, padded; further fields of a line are ignored."""
    found = read_checked(spark, path, {"siret": T.StringType()}, header=False, rules=siret_rules(), exact=False)
    found.good = found.good.select(pad_id(F.trim(F.col("siret")), 14).alias("siret"))
    return found


def read_predictions_checked(spark: SparkSession, path: str) -> Checked:
    """Earlier predictions; a probability must lie in [0, 1] or be empty."""
    columns = {"siren": T.StringType(), "siret": T.StringType(), "predicted_probability": T.DoubleType()}
    p = F.trim(F.col("predicted_probability")).try_cast("double")
    rules = siret_rules() | {"predicted_probability is not in [0, 1]": ~p.between(0, 1)}
    return read_checked(spark, path, columns, rules=rules)


def write_quarantine(broken: DataFrame, path: str) -> None:
    """Broken lines as JSON lines, added to what the folder holds."""
    broken.write.mode("append").json(path)
