"""From raw documents to encoded training ids, stage by stage.

Every stage is a function (spark, docs, sf_dir) -> DataFrame.  ``run`` writes
each result as Parquet in the shared folder and reads it back as the next
stage's documents, so a lost executor never costs more than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigie.llm import token_files
from vigie.llm.common import read, written
from vigie.llm.decontaminate import keep_clean
from vigie.llm.mixing import sample
from vigie.llm.quality_rules import keep_good
from vigie.llm.simhash import drop_near_duplicates


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: 3-word shingles, 3 bits."""
    return drop_near_duplicates(docs, max_bits=3, k=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth of their words in benchmark windows go."""
    return keep_clean(docs, read(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document stays as often as it is taken."""
    return sample(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids written as blocks; one row per document as read back."""
    return token_files.encode(docs)


STAGES = [
    ("quality rules", quality),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
    ("token-id binary output", token_ids),
]

#: Tokenizer vocabularies cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-").replace("/", "-"))
    return docs
