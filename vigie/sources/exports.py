"""Typed exports of the document store.

The store's JSON export wraps values that plain JSON has no type for:
``{"$date": ...}``, ``{"$numberLong": "5"}`` and so on.  ``read_export`` infers the
records' schema, walks it, and replaces every wrapper, at any depth and in arrays, by a
value of its type.  Spark does the rest: the result is an ordinary DataFrame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigie.functions.features import nan_to_null
from vigie.operators.dataset import flatten, normalise_ids

# --- fixed values: the export format's wrappers and what they hold -------------
NUMBERS = {"$numberLong": "bigint", "$numberInt": "int", "$numberDouble": "double", "$numberDecimal": "decimal(38,18)"}
DATE, ID = "$date", "$oid"
# --- end of fixed values -------------------------------------------------------


def _number(text: Column, kind: str) -> Column:
    if kind == "double":
        # Spark's cast knows NaN and Infinity
        return text.cast("string").try_cast("double")
    return text.cast("string").try_cast(kind)


def _moment(value: Column, kind: T.DataType) -> Column:
    """A date: text with a zone, milliseconds since 1970, or either in its own wrapper."""
    if isinstance(kind, T.StructType):
        (inner,) = kind.names
        return F.timestamp_millis(_number(value[inner], "bigint"))
    if isinstance(kind, T.StringType):
        millis = F.when(value.rlike(r"^-?\d+$"), F.timestamp_millis(value.try_cast("bigint")))
        wrapped = F.timestamp_millis(F.get_json_object(value, "$['$numberLong']").try_cast("bigint"))
        return F.coalesce(millis, wrapped, F.try_to_timestamp(value))
    return F.timestamp_millis(value.cast("bigint"))


def _wrapper(kind: T.DataType) -> str | None:
    if isinstance(kind, T.StructType) and len(kind.names) == 1 and (kind.names[0] in NUMBERS or kind.names[0] in (DATE, ID)):
        return kind.names[0]
    return None


def _mixed(kind: T.DataType) -> list[str]:
    """Wrappers of different kinds in one field: records differ (a field that is sometimes a long and sometimes a double)."""
    if isinstance(kind, T.StructType) and len(kind.names) > 1 and all(n in NUMBERS for n in kind.names):
        return list(kind.names)
    return []


def typed(value: Column, kind: T.DataType) -> Column:
    """``value`` without wrappers."""
    name = _wrapper(kind)
    if name == DATE:
        return _moment(value[DATE], kind[DATE].dataType)
    if name == ID:
        return value[ID]
    if name is not None:
        return _number(value[name], NUMBERS[name])
    if several := _mixed(kind):
        return F.coalesce(*[_number(value[n], "double") for n in several])
    if isinstance(kind, T.StructType):
        fields = F.struct(*[typed(value[f.name], f.dataType).alias(f.name) for f in kind.fields])
        return F.when(value.isNotNull(), fields)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: typed(x, kind.elementType))
    if isinstance(kind, T.StringType):
        # records that hold the value both bare and wrapped are inferred as text
        unwrapped = F.coalesce(*[F.get_json_object(value, f"$['{n}']") for n in [*NUMBERS, DATE, ID]])
        return F.when(value.startswith('{"$'), F.coalesce(unwrapped, value)).otherwise(value)
    return value


def unwrapped(df: DataFrame) -> DataFrame:
    """All columns of an export without wrappers."""
    return df.select(*[typed(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


def read_export(spark: SparkSession, path: str, schema: T.StructType | str | None = None, kinds: dict[str, str] | None = None) -> DataFrame:
    """A feature table from the store's export, one record per line, flat or ``{_id: .., value: {..}}``.

    Without ``schema`` one pass over the files infers the records' schema.  Inferring
    can't know the type of a field that is both bare and wrapped; ``kinds`` ({column:
    Spark type}) casts such columns.  ``periode`` becomes a date, NaN null, and ids
    keep or regain their leading zeros, as in ``io.read_features``.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = flatten(unwrapped(reader.json(path)))
    df = df.withColumns({c: F.col(c).try_cast(k) for c, k in (kinds or {}).items() if c in df.columns})
    df = df.withColumns({c: nan_to_null(c) for c, k in df.dtypes if k in ("double", "float")})
    if "periode" in df.columns and dict(df.dtypes)["periode"] != "date":
        moment = F.col("periode")
        if dict(df.dtypes)["periode"] == "timestamp":  # the export's days are those of UTC
            moment = F.to_utc_timestamp(moment, F.current_timezone())
        df = df.withColumn("periode", F.to_date(moment))
    return normalise_ids(df)
