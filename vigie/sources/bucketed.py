"""Tables stored by firm or establishment.

A bucketed table is dealt and sorted by a key once, when it is written.  Joins and
aggregations on that key then read it as it lies: the large side of a join has no
exchange, and two tables with the same buckets are joined without any.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigie.session import checkpoint_dir


def default_buckets(spark: SparkSession) -> int:
    """As many as the session's shuffles have partitions: the other side of a join is then dealt to the buckets."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucketed_table(df: DataFrame, key: str = "siren", buckets: int | None = None, partition: str | None = None,
                   path: str | None = None, name: str | None = None) -> DataFrame:
    """Write ``df`` in ``buckets`` buckets by ``key``, sorted by it, and open it as a table of the session's catalog.

    Rows are dealt before the write, so each bucket is one file (per value of
    ``partition``, whose filters then skip folders).  ``path``: default a fresh
    folder of the shared store.  A key that holds a large share of the rows makes
    a large bucket; leave such a table unbucketed.
    """
    spark = df.sparkSession
    buckets = buckets or default_buckets(spark)
    path = path or f"{checkpoint_dir(spark)}/bucketed/{uuid.uuid4().hex}"
    name = name or f"vigie_{uuid.uuid4().hex}"
    order = [c for c in (partition, key) if c]
    writer = df.repartition(buckets, F.col(key)).sortWithinPartitions(*order).write.format("parquet") \
        .bucketBy(buckets, key).sortBy(key).option("path", path)
    if partition:
        writer = writer.partitionBy(partition)
    writer.saveAsTable(name)
    return spark.table(name)


def open_bucketed(spark: SparkSession, path: str, schema: str, key: str, buckets: int, partition: str | None = None,
                  name: str | None = None) -> DataFrame:
    """Open a folder that ``bucketed_table`` wrote, in another session; all three layout values must be those it was written with."""
    name = name or f"vigie_{uuid.uuid4().hex}"
    by = f"PARTITIONED BY ({partition})" if partition else ""
    place = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet {by} CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{place}'")
    if partition:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)
