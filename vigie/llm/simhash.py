"""SimHash near-duplicates found through pivot distance tables.

Fingerprint: 64-bit majority vote over the XXH64 hashes of a text's word
shingles.  Links: for every *distinct* fingerprint a table row holds its Hamming
distances to ``PIVOTS`` fixed reference fingerprints.  By the triangle
inequality two fingerprints within ``max_bits`` differ by at most ``max_bits``
in every coordinate, so a pair whose largest coordinate difference is greater is
discarded, and the survivors are verified bit by bit.

The table is searched block by block, never all against all: a block holds the
fingerprints that agree on all but ``max_bits`` of ``m`` segments (pigeonhole:
every pair within ``max_bits`` shares at least one block).  Blocks that hold
many distinct fingerprints are cut again with more segments; with the last cut
a block leaves 12 free bits, hence at most 4,096 distinct fingerprints whatever
the input.  No level drops a pair.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from vigie.llm.common import fresh, private_columns, read, written
from vigie.llm.components import components

PIVOTS = 16
#: segments per level of blocks; a block above ``HOT_BLOCK`` fingerprints goes to the next level
LEVELS = (6, 10, 16)
HOT_BLOCK = 400
_CHUNK = 1 << 16


def fingerprint(text: bytes | None, k: int = 3) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text (brute force in memory of one text's words).

    Words: runs without ASCII white space, A-Z lower-cased.  Shingles of ``k``
    words with repeats; fewer words make one shingle; no word gives 0.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.append(np.flatnonzero(np.frombuffer(joined, np.uint8) == 32), len(joined))
    starts = np.append(0, ends[:-1] + 1)
    span = min(k, len(words)) - 1
    starts, ends = starts[:len(words) - span], ends[span:]
    view, h = memoryview(joined), xxhash.xxh64_intdigest
    total = np.zeros(64, np.int64)
    for i in range(0, len(starts), _CHUNK):  # bounded memory for very long texts
        hashes = np.array([h(view[a:b], 42) for a, b in
                           zip(starts[i:i + _CHUNK].tolist(), ends[i:i + _CHUNK].tolist())], ">u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(starts)).tobytes(), "big")


def fingerprint_column(text: Column, k: int = 3) -> Column:
    """SimHash as a signed 64-bit column."""
    @pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, k) for t in texts], np.uint64).view(np.int64))

    return simhash(text.cast("binary"))


def _segments(m: int) -> list[int]:
    """Masks of m nearly equal segments of 64 bits, as signed longs."""
    edges = [64 * i // m for i in range(m + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return masks


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _blocks(fps: DataFrame, m: int, max_bits: int) -> DataFrame:
    """One row per fingerprint and choice of m - max_bits segments: its bits there are the block's key."""
    masks = [_signed(sum(c)) for c in combinations(_segments(m), m - max_bits)]
    keys = F.transform(F.array(*[F.lit(x) for x in masks]), lambda mask: F.col("fp").bitwiseAND(mask))
    return fps.select("*", F.posexplode(keys).alias("cut", "key"))


def _pivot_table(fps: DataFrame, n: int = PIVOTS) -> DataFrame:
    """Distances to n reference fingerprints, eight to a long (one byte each)."""
    rng = np.random.default_rng(8)
    pivots = [int(x) for x in rng.integers(-(1 << 63), (1 << 63) - 1, n, dtype=np.int64)]
    out = []
    for j in range(0, n, 8):
        packed = F.lit(0).cast("long")
        for i, p in enumerate(pivots[j:j + 8]):
            dist = F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))).cast("long")
            packed = packed.bitwiseOR(F.shiftleft(dist, 8 * i))
        out.append(packed.alias(f"d{j // 8}"))
    return fps.select("fp", *out)


def _close(max_bits: int, n: int = PIVOTS) -> Column:
    """Pair test: every pivot coordinate within max_bits, then the bits themselves."""
    test = F.lit(True)
    for j in range(n // 8):
        for i in range(8):
            at = lambda side: F.shiftright(F.col(f"{side}.d{j}"), 8 * i).bitwiseAND(F.lit(255))  # noqa: B023, E731
            test = test & (F.abs(at("a") - at("b")) <= max_bits)
    return test & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits)


def links(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """(a, b), a < b: every pair of distinct fingerprints within ``max_bits`` bits, once.

    ``fps``: one column ``fp`` of distinct signed longs.
    """
    table = written(_pivot_table(fps), "pivots")
    found, todo = None, table
    for level, m in enumerate(LEVELS):
        last = level == len(LEVELS) - 1
        blocks = _blocks(todo, m, max_bits)
        size = blocks.groupBy("cut", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        if not last:
            size = written(size, "blocks")
        searched = size if last else size.where(F.col("n") <= HOT_BLOCK)
        rows = blocks.join(searched.drop("n"), ["cut", "key"])
        pairs = rows.alias("a").join(rows.alias("b"), (F.col("a.cut") == F.col("b.cut")) & (F.col("a.key") == F.col("b.key"))
                                     & (F.col("a.fp") < F.col("b.fp")) & _close(max_bits))
        pairs = written(pairs.select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b")), "links")
        found = pairs if found is None else found.unionByName(pairs)
        if last:
            break
        hot = size.where(F.col("n") > HOT_BLOCK)
        if hot.isEmpty():
            break
        todo = written(blocks.join(hot, ["cut", "key"], "left_semi").select(*table.columns).distinct(), "hot")
    return found.distinct()


def near_duplicates(df: DataFrame, max_bits: int = 3, k: int = 3, text: str = "text",
                    id_col: str = "doc_id", drop: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(tagged, classes): the rows with their fingerprint; fingerprint -> its class.

    ``tagged``: the columns of ``df`` without ``drop`` and a signed long ``fp`` (named ``fp_`` and
    so on where that name is taken), written to the shared folder.
    ``classes``: one row per distinct fingerprint: fp, root (key of its class),
    component_id (smallest id in the class).

    Result for odd input: null and empty texts have fingerprint 0 and are linked
    like any other; a null id counts only in a class without any other id;
    repeated rows share a class; no rows give no rows.
    """
    (fp,) = fresh(df, "fp")
    tagged = written(df.withColumn(fp, fingerprint_column(F.col(text), k)).drop(*drop), "simhash")
    nodes = written(tagged.groupBy(F.col(fp).alias("fp")).agg(F.min(id_col).alias("id")), "fingerprints")
    comp = components(links(nodes.select("fp"), max_bits))
    rooted = nodes.join(comp, nodes["fp"] == comp["node"], "left") \
        .select("fp", "id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    return tagged, written(rooted.join(least, "root").select("fp", "root", "component_id"), "classes")


@private_columns("text", "id_col")
def with_components(df: DataFrame, max_bits: int = 3, k: int = 3, text: str = "text",
                    id_col: str = "doc_id") -> DataFrame:
    """The rows of ``df`` with ``fingerprint`` (16 hexadecimal digits) and ``component_id``.

    Input columns of these two names are replaced.  Odd input: see ``near_duplicates``.
    """
    tagged, classes = near_duplicates(df.drop("fingerprint", "component_id"), max_bits, k, text, id_col)
    fp = tagged.columns[-1]
    hexed = F.lower(F.lpad(F.hex(F.col(fp)), 16, "0")).alias("fingerprint")
    classes = classes.select(F.col("fp").alias("__fp"), "component_id")
    return tagged.join(classes, tagged[fp] == classes["__fp"]).select(*tagged.columns[:-1], hexed, "component_id")


def drop_near_duplicates(df: DataFrame, max_bits: int = 3, k: int = 3, text: str = "text",
                         id_col: str = "doc_id") -> DataFrame:
    """One row of every class stays: the one with the smallest id (one of them if rows repeat it)."""
    own = [f"__c{i}" for i in range(len(df.columns))]
    at = dict(zip(df.columns, own))
    tagged, classes = near_duplicates(df.toDF(*own), max_bits, k, at[text], at[id_col])
    fp, key = tagged.columns[-1], at[id_col]
    narrow = tagged.select(F.col(fp).alias("fp"), F.col(key).alias("id"))
    # which (fingerprint, id) of each class stays: decided on two narrow columns
    first = narrow.join(classes, "fp").where(F.col("id").eqNullSafe(F.col("component_id"))) \
        .groupBy("root").agg(F.min("fp").alias("__fp"), F.min("id").alias("__id"))
    # plain equal keys (a null id as a flag), so that join and duplicate removal share one exchange
    low = F.lit(-(1 << 63))
    keys = lambda f, i: [F.col(f).alias("__k0"), F.coalesce(i, low).alias("__k1"), F.col(i).isNull().alias("__k2")]
    stay = tagged.select("*", *keys(fp, key)).join(first.select(*keys("__fp", "__id")), ["__k0", "__k1", "__k2"], "left_semi")
    return stay.dropDuplicates(["__k0", "__k1", "__k2"]).select(*[F.col(o).alias(c) for c, o in at.items()])


def op8_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 3-word shingles, 3 bits."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    tagged, classes = near_duplicates(docs, drop=("text",))
    return tagged.select("doc_id", "fp").join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
