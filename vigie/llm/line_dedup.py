"""Fuzzy line dedup: MinHash, banding, exact Jaccard, distributed union-find.

Lines are known by a 64-bit hash (n different lines expect n^2 / 2^65 wrong
merges).  All 5-character shingles of a line, whatever its length, give its
minimum hashes by one aggregation (copies of a line fold into it), so a
signature estimates the similarity that is verified.  Lines that share a band of
five minima are candidates.  A candidate pair is verified by the exact Jaccard
similarity of its sets of 5-character shingles, after a test of the sets' sizes.  Verified pairs are links; one
line per component stays, the first by document id and position.

Buckets: every line of a bucket is first compared with the bucket's first line.
Of the other pairs, only those are compared whose lines are not yet in one
component.  In a bucket of up to ``ALL_PAIRS`` lines every such pair is a
candidate; in a larger one those that a bound from sketches of the two shingle
sets does not rule out (``rest``), so a large bucket gives every link that all
its pairs would give.

DataFrame functions only.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigie.llm.common import fresh, let, private_columns, read, text_tag, written
from vigie.llm.components import components

SIMILARITY = 0.8
HASHES = 30
#: products of a shingle's hash; each gives HASHES / MIXES of the orders
MIXES = 6
#: hashes of each band, every hash in three: of pairs at 0.8, 0.99 share a band (at 0.85, 0.998)
BANDS = ((8, 11, 12, 20, 24), (10, 14, 18, 21, 28), (2, 15, 16, 19, 22), (6, 13, 25, 27, 29), (1, 5, 17, 23, 26), (0, 3, 4, 7, 9),
         (5, 16, 18, 26, 27), (0, 10, 12, 14, 17), (1, 3, 9, 11, 25), (4, 6, 15, 20, 29), (2, 8, 19, 23, 28), (7, 13, 21, 22, 24),
         (11, 20, 22, 27, 28), (2, 6, 9, 15, 24), (3, 5, 8, 10, 18), (7, 19, 25, 26, 29), (0, 1, 12, 17, 21), (4, 13, 14, 16, 23))
#: chance pairs agree in some 5 + 8 two-bit ends of the minima; of pairs at 0.8 in a band about 1 in 10^5 has fewer than this
AGREE = 18
ALL_PAIRS = 32
#: 64-bit words of a sketch in ``rest``
WORDS = 16
#: pairs of a large bucket compared in one place
PLACE_PAIRS = 1 << 27
#: a table of numbers is broadcast up to this many rows, by count (some 50 MB)
BROADCAST_ROWS = 1 << 21


def _counted(df: DataFrame) -> DataFrame:
    """A written table of numbers, broadcast if its count is within the bound."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _lines(df: DataFrame, text: str, *more: Column) -> DataFrame:
    """(more.., no, line, id): the lines of every text that hold a character other than white space."""
    # ``more`` is worked out once a text, before its lines become rows
    d = df.select(F.split(F.coalesce(F.col(text), F.lit("")), "\n").alias("lines"), *more)
    d = d.select(*d.columns[1:], F.posexplode("lines").alias("no", "line"))
    d = d.where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    return d.withColumn("id", F.xxhash64("line"))


def _hashes(lines: DataFrame) -> DataFrame:
    """(id, h): the hashes of all shingles with repeats.  Four bytes a character, so a shingle is a slice of bytes."""
    d = lines.select("id", F.encode("line", "UTF-32").alias("u"))
    last = F.greatest((F.octet_length("u") / 4).cast("int") - 5, F.lit(0))
    d = d.select("id", "u", F.explode(F.sequence(F.lit(0), last)).alias("i"))
    return d.select("id", F.xxhash64(F.substring("u", F.col("i") * 4 + 1, F.lit(20))).alias("h"))


def _signatures(lines: DataFrame) -> DataFrame:
    """id -> m0.., the minimum of each of ``HASHES`` orders of its shingles' hashes.

    ``MIXES`` products of the hash are each read in several orders: a value with a fixed mask flipped
    is one to one, so every order has a random first shingle, and masks that differ at the top look
    into different parts of the values.
    """
    rng = np.random.default_rng(5)
    # a mix = the middle bits of the product (below 2^63) with an odd constant
    odd = rng.integers(1 << 30, 1 << 31, MIXES) * 2 + 1
    each = HASHES // MIXES
    masks = [int((j << 31) // each + rng.integers((1 << 31) // each)) for j in range(each) for _ in range(MIXES)]
    d = _hashes(lines).select("id", F.shiftrightunsigned("h", 33).alias("h"))
    d = d.select("id", *[F.shiftright(F.col("h") * F.lit(int(c)), 15).bitwiseAND(F.lit((1 << 31) - 1)).cast("int").alias(f"g{k}")
                         for k, c in enumerate(odd)])
    return d.groupBy("id").agg(*[F.min(F.col(f"g{i % MIXES}").bitwiseXOR(F.lit(x))).alias(f"m{i}") for i, x in enumerate(masks)])


def _agree(a: str, b: str) -> Column:
    """Whether ``AGREE`` of the two-bit ends of two lines agree."""
    bits = F.col(a).bitwiseXOR(F.col(b))
    differ = F.bit_count(bits.bitwiseOR(F.shiftright(bits, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    return differ <= HASHES - AGREE


def _pairs(rows: DataFrame) -> DataFrame:
    """All pairs a < b of ids with the same key whose minima agree; star: a is the key's first."""
    a = rows.select("key", F.col("id").alias("a"), F.col("ends").alias("a_ends"), (F.col("id") == F.col("first")).alias("star"))
    b = rows.select("key", F.col("id").alias("b"), F.col("ends").alias("b_ends"))
    return a.join(b, "key").where("a < b").where(_agree("a_ends", "b_ends")).select("a", "b", "star")


def buckets(signatures: DataFrame) -> DataFrame:
    """(key, id, ends, n, first): the lines of every band that n > 1 lines share; ends: two bits of each minimum."""
    keys = [F.xxhash64(F.lit(i), *[f"m{j}" for j in band]) for i, band in enumerate(BANDS)]
    ends = F.lit(0).cast("long")
    for i in range(HASHES):
        ends = ends.bitwiseOR(F.shiftleft(F.col(f"m{i}").bitwiseAND(F.lit(3)).cast("long"), 2 * i))
    bands = signatures.select("id", ends.alias("ends"), F.explode(F.array(*keys)).alias("key"))
    # most keys occur once: half of the key is enough to drop nearly all of those without moving ids
    half = F.shiftright("key", 32).cast("int")
    often = bands.groupBy(half.alias("half")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("half")
    bands = written(bands.withColumn("half", half).join(_counted(written(often, "halves")), "half", "left_semi")
                    .select("id", "key", "ends"), "bands")
    size = bands.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first")).where("n > 1")
    return written(bands.join(size, "key"), "buckets")


def _near(rows: DataFrame) -> DataFrame:
    """(a, b, star), a < b, distinct: all pairs of the small buckets; in large ones each line with the first.  star: one is a bucket's first."""
    star = rows.where((F.col("n") > ALL_PAIRS) & (F.col("id") > F.col("first")))
    star = star.select(F.col("first").alias("a"), F.col("id").alias("b"), F.lit(True).alias("star"))
    both = _pairs(rows.where(F.col("n") <= ALL_PAIRS)).unionByName(star)
    return both.groupBy("a", "b").agg(F.max("star").alias("star"))


def candidates(signatures: DataFrame) -> DataFrame:
    """(a, b), a < b, distinct: pairs of lines that share a band; in large buckets those of ``_near``."""
    return _near(buckets(signatures)).select("a", "b")


def _sketches(texts: DataFrame) -> DataFrame:
    """id -> d, the number of different shingles, and w0..: in bit b, whether an odd number of them has hash b.

    Each shingle that only one of two lines has turns one bit, so the lines' sketches differ in at
    most as many bits as there are such shingles.
    """
    def bits(hs: Column, k: Column) -> Column:
        here = F.filter(hs, lambda h: F.shiftrightunsigned(h, 6).bitwiseAND(F.lit(WORDS - 1)) == k)
        one = F.lit(1).cast("long")
        return F.aggregate(here, F.lit(0).cast("long"), lambda x, h: x.bitwiseXOR(F.call_function("shiftleft", one, h.bitwiseAND(F.lit(63)).cast("int"))))

    d = texts.select("id", let(F.array_distinct(_shingle_hashes(F.col("line"))), lambda hs: F.struct(
        F.size(hs).alias("d"), F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda k: bits(hs, k)).alias("w"))).alias("s"))
    return d.select("id", "s.d", *[F.col("s.w")[k].alias(f"w{k}") for k in range(WORDS)])


def rest(large: DataFrame, texts: DataFrame, root: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b), a < b, distinct: in each of the buckets ``large`` (key, id), every similar pair of different roots, and some others.

    Lines of d and e shingles are similar if at most (d + e) (1 - s) / (1 + s) shingles are in only
    one of them; a pair whose sketches differ in more bits cannot be.
    The lines of a bucket's largest component are not joined with each other, a
    pair counts in the first of the buckets that hold both, and the pairs of a
    very large bucket are compared in several places.
    """
    s, slack = similarity, 1e-6
    known = large.join(root.withColumnRenamed("node", "id"), "id", "left").select("key", "id", F.coalesce("root", "id").alias("root"))
    group = known.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    group = group.groupBy("key").agg(F.max(F.struct("n", "root")).alias("main"), F.count(F.lit(1)).alias("roots"), F.sum("n").alias("n"))
    compared = (F.col("n") - F.col("main.n")).cast("double") * F.col("n")
    group = group.where("roots > 1").select("key", F.col("main.root").alias("main"), (F.floor(compared / PLACE_PAIRS) + 1).cast("int").alias("parts"))
    known = known.join(group, "key").select("key", "id", "root", (F.col("root") == F.col("main")).alias("inner"), "parts")
    known = written(known, "large-buckets")
    ids = _counted(written(known.groupBy("id").agg(F.collect_list("key").alias("keys")), "large-ids"))
    each = written(known.join(_sketches(texts.join(ids.select("id"), "id", "left_semi")), "id").join(ids, "id"), "large-places")
    part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    x = each.where("not inner").select("key", part.alias("part"), *[F.col(c).alias(f"{c}_x") for c in each.columns if c not in ("key", "parts", "inner")])
    y = each.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    once = (F.col("root_x") != F.col("root")) & (F.col("inner") | (F.col("id_x") < F.col("id")))
    size = F.least("d_x", "d") >= F.greatest("d_x", "d") * s - slack
    bits = sum((F.bit_count(F.col(f"w{k}_x").bitwiseXOR(F.col(f"w{k}"))) for k in range(1, WORDS)), F.bit_count(F.col("w0_x").bitwiseXOR(F.col("w0"))))
    first = F.array_min(F.array_intersect("keys_x", "keys")) == F.col("y.key")
    fits = once & size & (bits <= (F.col("d_x") + F.col("d")) * ((1 - s) / (1 + s)) + slack) & first
    same = (F.col("x.key") == F.col("y.key")) & (F.col("x.part") == F.col("y.part"))
    return x.alias("x").join(y.alias("y"), same & fits).select(F.least("id_x", "id").alias("a"), F.greatest("id_x", "id").alias("b")).distinct()


def _shingle_hashes(line: Column) -> Column:
    """64-bit hashes of all 5-character shingles of a line, with repeats, as an array."""
    last = F.greatest(F.length(line) - 5, F.lit(0))
    return let(F.encode(line, "UTF-32"), lambda u: F.transform(
        F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.substring(u, i * 4 + 1, F.lit(20)))))


def sized(texts: DataFrame) -> DataFrame:
    """(id, line) with d, the number of different shingles."""
    return texts.withColumn("d", F.size(F.array_distinct(_shingle_hashes(F.col("line")))))


def verified(pairs: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs of ``sized`` texts whose sets of 5-character shingles have at least this Jaccard similarity.

    Shingles are compared by 64-bit hashes: two of a pair's n shingles agree by chance once in
    2^65 / n^2 pairs.  A pair whose sizes alone rule the similarity out is not compared.
    """
    s = F.lit(similarity)
    sides = [texts.select(F.col("id").alias(x), F.col("d").alias(f"{x}_d"), F.col("line").alias(f"{x}_line")) for x in "ab"]
    d = pairs.join(sides[0], "a").join(sides[1], "b").where(F.least("a_d", "b_d") >= s * F.greatest("a_d", "b_d"))
    both = F.size(F.array_intersect(_shingle_hashes(F.col("a_line")), _shingle_hashes(F.col("b_line"))))
    d = written(d.select("a", "b", both.alias("i"), (F.col("a_d") + F.col("b_d")).alias("t")), "similarities")
    return d.where(F.col("i") >= s * (F.col("t") - F.col("i"))).select("a", "b")


def _removed(df: DataFrame, text: str, id_col: str, similarity: float) -> DataFrame:
    """(doc, tag, no): the places whose line is kept elsewhere."""
    lines = _lines(df, text, F.col(id_col).cast("long").alias("doc"), text_tag(F.col(text)).alias("tag"))
    places = written(lines.select("doc", "tag", "no", "id"), "places")
    signatures = written(_signatures(lines.select("id", "line")), "signatures")
    rows = buckets(signatures)
    pairs = written(_near(rows), "line-pairs")
    ids = _counted(written(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "line-ids"))
    texts = written(sized(_lines(df, text).select("id", "line").join(ids, "id", "left_semi").distinct()), "line-texts")
    root = _counted(components(verified(pairs.where("star"), texts, similarity)))
    more = pairs.where("not star").select("a", "b")
    large = rows.where(F.col("n") > ALL_PAIRS).select("key", "id")
    if not large.isEmpty():
        more = more.unionByName(rest(large, texts, root, similarity)).distinct()
    sides = [root.select(F.col("node").alias(x), F.col("root").alias(f"{x}_root")) for x in "ab"]
    more = more.join(sides[0], "a", "left").join(sides[1], "b", "left") \
        .select("a", "b", F.coalesce("a_root", "a").alias("a_root"), F.coalesce("b_root", "b").alias("b_root")).where("a_root <> b_root")
    more = written(more, "other-pairs")
    links = verified(more.select("a", "b"), texts, similarity).join(more, ["a", "b"])
    # components of the roots; none of these is a node of ``root``
    joined = _counted(components(links.select(F.col("a_root").alias("a"), F.col("b_root").alias("b"))))
    root = root.join(joined.select(F.col("node").alias("root"), F.col("root").alias("last")), "root", "left") \
        .select("node", F.coalesce("last", "root").alias("root")).unionByName(joined)
    root = _counted(written(root, "line-roots"))
    # a null id comes first
    each = places.join(root, places["id"] == root["node"], "left") \
        .select("doc", "tag", "no", F.coalesce("doc", F.lit(-(1 << 63))).alias("at"), F.coalesce("root", "id").alias("root"))
    keeper = each.groupBy("root", "at").agg(F.min("no").alias("no"), F.count(F.lit(1)).alias("n"))
    keeper = keeper.groupBy("root").agg(F.min("at").alias("first"), F.min_by("no", "at").alias("first_no"), F.sum("n").alias("n"))
    keeper = _counted(written(keeper.where("n > 1").drop("n"), "keepers"))
    later = (F.col("at") > F.col("first")) | ((F.col("at") == F.col("first")) & (F.col("no") > F.col("first_no")))
    return each.join(keeper, "root").where(later).select("doc", "tag", "no")


@private_columns("text", "id_col")
def dedup(df: DataFrame, text: str = "text", id_col: str = "doc_id", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``df`` without the lines kept elsewhere, and removed_lines (positions from 0), n_lines, n_removed.

    Result for odd input: null text stays null, empty text stays empty, lines
    without characters stay; a null id comes before all others; rows with the
    same id are one document (none loses a line to the same place of the other);
    no rows give no rows; input columns named like a result are replaced.
    """
    names = ("removed_lines", "n_lines", "n_removed")
    d = df.drop(*[c for c in names if c in df.columns and c not in (text, id_col)])
    cols = d.columns
    gone = _removed(d, text, id_col, similarity).groupBy("doc", "tag").agg(F.collect_set("no").alias("__no"))
    gone = gone.withColumnsRenamed({"doc": "__doc", "tag": "__tag"})
    k_id, k_tag = fresh(d.withColumns({"__doc": F.lit(0), "__tag": F.lit(0), "__no": F.lit(0)}), "__key", "__hash")
    d = d.select("*", F.col(id_col).cast("long").alias(k_id), text_tag(F.col(text)).alias(k_tag))
    d = d.join(gone, d[k_id].eqNullSafe(gone["__doc"]) & (d[k_tag] == gone["__tag"]), "left")
    lines = F.split(F.col(text), "\n")
    # the positions that stay, as a difference of sets, then their lines in order
    keep = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__no"))
    d = d.withColumn("__lines", lines).withColumn("__keep", keep)
    left = F.array_join(F.transform("__keep", lambda i: F.get("__lines", i)), "\n")
    out = {text: F.when(F.col("__no").isNull(), F.col(text)).otherwise(left),
           "removed_lines": F.coalesce(F.sort_array("__no"), F.array().cast("array<int>")),
           "n_lines": F.coalesce(F.size("__lines"), F.lit(0)).cast("long"),
           "n_removed": F.coalesce(F.size("__no"), F.lit(0)).cast("long")}
    return d.withColumns({k: v for k, v in out.items() if k != text} | {"__left": out[text]}) \
        .select(*[F.col("__left").alias(c) if c == text else F.col(c) for c in cols], *names)


def op5_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with one line per component of similar lines."""
    return dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
