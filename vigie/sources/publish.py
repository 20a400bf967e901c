"""Publication of a run's files in two phases.

First the files are written into a folder that nobody is told of; then a manifest,
listing every file with its size and checksum, is written to ``manifests``.  Readers
go through complete manifests only, so a run that was killed half way is invisible,
and so is a manifest that was not written to its end.  A run that is published again
takes the place of its earlier publication at once; files of the earlier one stay.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MANIFEST = "run string, number long, path string, file string, bytes long, crc long, files long"


class Damaged(Exception):
    """Published files differ from their manifest."""


class Publication:
    def __init__(self, spark: SparkSession, out_dir: str):
        self.spark, self.out_dir = spark, out_dir.rstrip("/")

    def stage(self, run: str) -> str:
        """A fresh folder for the files of ``run``."""
        return f"{self.out_dir}/runs/{run}/{uuid.uuid4().hex}"

    def _inventory(self, path: str) -> DataFrame:
        """(file, bytes, crc) of every file below ``path``, names relative to it."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        name = F.substring_index(F.col("path"), path.rstrip("/").rsplit("/", 1)[-1] + "/", -1)
        return files.select(name.alias("file"), F.col("length").alias("bytes"), F.crc32("content").alias("crc"))

    def commit(self, run: str, path: str) -> None:
        """Publish the files below ``path`` as ``run``: readers see all of them from now on."""
        files = self._inventory(path)
        n = files.count()
        if n == 0:
            raise ValueError(f"no file to publish in {path}")
        number = max((r["number"] for r in self._manifests().collect()), default=-1) + 1
        rows = files.select(F.lit(run).alias("run"), F.lit(number).cast("long").alias("number"), F.lit(path).alias("path"),
                            "file", "bytes", "crc", F.lit(n).cast("long").alias("files"))
        # the number of files in every row: a manifest that lacks rows is not complete
        rows.coalesce(1).write.json(f"{self.out_dir}/manifests/{uuid.uuid4().hex}")

    def _rows(self) -> DataFrame:
        try:
            return self.spark.read.schema(_MANIFEST).option("recursiveFileLookup", "true").json(f"{self.out_dir}/manifests")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], _MANIFEST)

    def _manifests(self) -> DataFrame:
        """(run, number, path) of the complete manifests, one row each."""
        per = self._rows().groupBy("run", "number", "path").agg(F.count(F.lit(1)).alias("n"), F.max("files").alias("files"))
        return per.where("n = files").select("run", "number", "path")

    def runs(self) -> dict[str, str]:
        """{run: folder of its latest publication}."""
        return {r["run"]: r["path"] for r in sorted(self._manifests().collect(), key=lambda r: r["number"])}

    def path(self, run: str) -> str:
        there = self.runs()
        if run not in there:
            raise FileNotFoundError(f"no run {run} was published")
        return there[run]

    def verify(self, run: str) -> int:
        """Number of files of a run; ``Damaged`` names those that are missing or differ."""
        path = self.path(run)
        said = self._rows().where((F.col("run") == run) & (F.col("path") == path)).select("file", "bytes", "crc")
        there = self._inventory(path).select(F.col("file").alias("f"), F.col("bytes").alias("b"), F.col("crc").alias("c"))
        same = (F.col("file") == F.col("f")) & (F.col("bytes") == F.col("b")) & (F.col("crc") == F.col("c"))
        bad = [r["file"] for r in said.join(there, same, "left_anti").select("file").limit(20).collect()]
        if bad:
            raise Damaged(f"{run}: {sorted(bad)}")
        return said.count()
