"""Helpers shared by the operators of this package."""

from __future__ import annotations

import functools
import inspect
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigie.session import checkpoint_dir

#: Java pattern of what separates words: space and \t \n \v \f \r.
SPACES = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_path(spark: SparkSession, tag: str) -> str:
    """A fresh path in the folder that driver and executors share."""
    return f"{checkpoint_dir(spark)}/llm-{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (cuts lineage).

    A lost executor costs a re-read of these files, never a recomputation of
    what produced them; the file sizes also give later joins true statistics.
    """
    spark = df.sparkSession
    path = shared_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body(value)``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """Words of a text (maximal runs without white space); null gives an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def text_tag(text: Column) -> Column:
    """128-bit digest that tells the texts of rows with one id apart (null and empty alike)."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The given names, with a suffix where ``df`` already has such a column."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def with_results(df: DataFrame, **cols: Column) -> DataFrame:
    """Add result columns; an input column of the same name is replaced."""
    return df.withColumns(cols)


def private_columns(*named: str) -> Callable:
    """Decorator of an operator on a DataFrame: inside, every input column has a name of its own (__c0, __c1, ..).

    So no input column, in any case, meets a name that the operator uses.  ``named``:
    parameters that hold names of input columns (``drop`` may hold several).  The result
    has the input columns under their names again, without those dropped and those
    named like a result (in any case), then the operator's results.
    """
    def wrap(op: Callable) -> Callable:
        signature = inspect.signature(op)

        @functools.wraps(op)
        def run(df: DataFrame, *args, **kwargs) -> DataFrame:
            call = signature.bind(df, *args, **kwargs)
            call.apply_defaults()
            own = [f"__c{i}" for i in range(len(df.columns))]
            at = {c.lower(): o for c, o in zip(df.columns, own)}
            for p in named:
                call.arguments[p] = at[call.arguments[p].lower()]
            if "drop" in call.arguments:
                call.arguments["drop"] = tuple(at[c.lower()] for c in call.arguments["drop"])
            call.arguments[next(iter(signature.parameters))] = df.toDF(*own)
            out = op(*call.args, **call.kwargs)
            results = [c for c in out.columns if c not in own]
            taken = {c.lower() for c in results}
            back = [F.col(o).alias(c) for c, o in zip(df.columns, own) if o in out.columns and c.lower() not in taken]
            return out.select(*back, *results)

        return run

    return wrap


def counted(df: DataFrame, rows: int) -> DataFrame:
    """A written table, broadcast if its count is within the bound."""
    return F.broadcast(df) if df.count() <= rows else df


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int, rows: int = 1 << 16, size: int = 8 << 20) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of complete groups and the first row of each group, from batches sorted by their first ``keys`` columns.

    A table is given out once ``rows`` rows or ``size`` bytes are there; a group is never cut.
    """
    pending: list[pa.RecordBatch] = []
    count = held = 0

    def starts(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        new[:1] = True
        for col in table.columns[:keys]:
            col = col.combine_chunks()
            new[1:] |= np.asarray(pc.fill_null(pc.not_equal(col[1:], col[:-1]), True))
        return np.flatnonzero(new)

    for batch in batches:
        pending.append(batch)
        count, held = count + batch.num_rows, held + batch.nbytes
        if count < rows and held < size:
            continue
        table = pa.Table.from_batches(pending).combine_chunks()
        at = starts(table)
        if len(at) > 1:
            yield table.slice(0, at[-1]), at[:-1]
            table = table.slice(at[-1])
        pending, count, held = table.to_batches(), table.num_rows, 0
    table = pa.Table.from_batches(pending).combine_chunks() if pending else None
    if table is not None and table.num_rows:
        yield table, starts(table)
