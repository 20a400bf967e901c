"""Connected components of an edge table, as Spark joins.

Alternating star contraction: the large star points every larger neighbour of a
node at the smallest label around it, the small star does the same for the
smaller side.  After the last round every edge is (node, smallest node of its
component).  Minimum labels come from aggregations with map-side combine, and
the joins are ordinary shuffle joins that adaptive execution may split, so a
node with very many neighbours is never gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigie.llm.common import written


def _star(directed: DataFrame) -> DataFrame:
    """(u, v) -> (v, smallest of u and its neighbours) for every u."""
    low = directed.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("low"))
    return directed.join(low, "u")


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links -> (node, root): root is the smallest node that can be reached.

    Only nodes that have a link appear.  Self links and repeated links are
    allowed; no links give no rows.
    """
    cur = written(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v").distinct(), "edges")
    seen = None
    while True:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = large.unionByName(cur).where("u <> v").distinct() if seen is None else large.where("u <> v").distinct()
        stars = _star(large)
        small = stars.select(F.col("v").alias("u"), F.col("low").alias("v")) \
            .unionByName(large.groupBy("u").agg(F.min("v").alias("v")))
        cur = written(small.where("u <> v").distinct(), "edges")
        # an unchanged edge set is the fixed point; the digest is one row
        state = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
