"""Anonymised synthetic establishments (P7: A1-A3, W1, W2, X12, J4).

For every sector (``code_ape_niveau3``) with more than ``group_size`` rows, the
rows get a seeded random rank inside the sector; ``rank mod group_size`` deals
them round-robin into ``group_size`` groups; each group becomes one mock
establishment: mean of the continuous variables, latest ``periode``, and the
categorical values of the group's first-ranked row.

Scale: the in-sector rank uses ``ranking.global_rank`` with hash buckets, so a
sector holding a third of all rows is ranked by many tasks; the group
aggregation is partial (map-side) for mean, max and ``min_by``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigie.operators.ranking import global_rank, n_buckets
from vigie.session import written_table
from vigie.sources.panel import hash_unit

SECTOR = "code_ape_niveau3"
_ROWS_PER_BUCKET = 200_000
# --- fixed values: first siren of a mock firm, how many there are, and a factor
# without a common divisor with that number, which spreads consecutive ids
_FIRST_SIREN, _SIRENS, _SPREAD = 100_000_000, 900_000_000, 633_910_099
# --- end of fixed values


def mock_siren(number: Column) -> Column:
    """A 9-digit siren of its own for every number below 900 million (then the siren repeats)."""
    spread = F.pmod(F.pmod(number, F.lit(_SIRENS)) * F.lit(_SPREAD), F.lit(_SIRENS))
    return (F.lit(_FIRST_SIREN) + spread).cast("long").cast("string")


def mock_siret(number: Column) -> Column:
    """The siren and a 5-digit number of the establishment: distinct for 9e13 numbers."""
    return F.concat(mock_siren(number), F.lpad(F.floor(number / F.lit(_SIRENS)).cast("string"), 5, "0"))


def build_synthetic_dataset(base: DataFrame, cont_variables: Sequence[str], cat_variables: Sequence[str],
                            group_size: int = 5, seed: int = 0,
                            members_per_group: bool = False) -> DataFrame:
    """Columns: siret, siren, periode, outcome, other categorical, continuous.

    Default (as the reference computes): ``rank mod group_size`` -> each sector
    gives ``group_size`` mock establishments of about n/group_size members.
    ``members_per_group=True`` (as the reference describes): consecutive ranks
    ``(rank-1) div group_size`` -> each mock is made of ``group_size``
    establishments (the last group of a sector may be smaller).
    """
    if "outcome" not in cat_variables:
        raise ValueError("the categorical variables lack outcome")
    cat_rest = [c for c in cat_variables if c != "outcome"]
    # what the steps below need, written once: the input is read one time
    need = dict.fromkeys([SECTOR, "siret", "periode", *cont_variables, *cat_variables])
    base = written_table(base.select(*need), "synthetic-base")
    # A1: sectors with more than group_size counted sirets (null sector excluded)
    sizes = base.filter(F.col(SECTOR).isNotNull()).groupBy(SECTOR).agg(F.count("siret").alias("__n"))
    big = sizes.filter(F.col("__n") > group_size)
    # inner join on the (one row per sector) size table: keeps big sectors only
    # and brings the sector size, from which its number of hash buckets follows.
    models = base.join(big, SECTOR)
    # Seeded random rank inside the sector (1-based), W2: round-robin group
    models = models.withColumn("__h", hash_unit(F.col("siret"), F.col("periode").cast("string"),
                                                F.lit(str(seed))))
    buckets = F.ceil(F.col("__n") / F.lit(_ROWS_PER_BUCKET))
    ranked = global_rank(models, [F.col("__h"), F.col("siret"), F.col("periode")],
                         F.floor(F.col("__h") * buckets), partition_cols=[SECTOR], out="__rank")
    if members_per_group:
        gid = F.floor((F.col("__rank") - 1) / F.lit(group_size)).cast("long")
    else:
        gid = F.pmod(F.col("__rank"), F.lit(group_size))
    ranked = ranked.withColumn("__gid", gid)
    # A2 + A3 in one aggregation (J4 is not needed)
    ref = F.min_by(F.struct(*[F.col(c) for c in cat_variables]), F.col("__rank"))
    groups = ranked.groupBy(SECTOR, "__gid").agg(
        *[F.avg(c).alias(c) for c in cont_variables],
        F.max("periode").alias("periode"),
        ref.alias("__ref"),
    )
    # Unique 14-digit ids, numbered in seeded hash order of the groups
    groups = groups.withColumn("__gh", hash_unit(F.col(SECTOR), F.col("__gid").cast("string"),
                                                 F.lit(str(seed))))
    groups = written_table(groups, "synthetic-groups")
    numbered = global_rank(groups, [F.col("__gh"), F.col(SECTOR), F.col("__gid")],
                           F.floor(F.col("__gh") * n_buckets(groups.count())), out="__id")
    return numbered.select(
        mock_siret(F.col("__id")).alias("siret"),
        mock_siren(F.col("__id")).alias("siren"),
        "periode",
        F.col("__ref.outcome").alias("outcome"),
        *[F.col(f"__ref.{c}").alias(c) for c in cat_rest],
        *[F.col(c) for c in cont_variables],
    )
