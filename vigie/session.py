"""The Spark session and the folder that driver and executors share."""

from __future__ import annotations

import logging
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

_CKPT_CONF = "spark.checkpoint.dir"


def get_spark(app_name: str = "vigie") -> SparkSession:
    """The active session, or one built from what the launcher set.

    Master, partitions and memory come from spark-submit (or the defaults of
    Spark); nothing is set here.
    """
    return SparkSession.getActiveSession() or SparkSession.builder.appName(app_name).getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or the context's checkpoint
    directory).  Without either, a local master gets a fresh private folder; on
    a cluster that is an error, since executors would not see such a folder.
    """
    path = spark.conf.get(_CKPT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"{_CKPT_CONF} is not set; a cluster ({master}) needs a folder that all executors share")
    path = tempfile.mkdtemp(prefix="vigie-ckpt-")
    log.warning("spark.checkpoint.dir unset; using private local folder %s", path)
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def written_table(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later uses and lost executors re-read files."""
    path = f"{checkpoint_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
