"""Near-duplicate vectors by sorted projection passes.

Each pass orders the vectors of a label lexicographically by ``BITS`` concatenated
random hashes (the signs of random projections) and compares every vector with the
``WINDOW`` that follow it.  Two vectors at cosine 0.98 agree in one sign with
probability 0.936, so they are neighbours in one pass with probability 0.936^b at
least, where 2^b windows hold a label's vectors: with 16 passes 0.99 of the pairs
at the threshold are compared for 10^8 vectors of one label, all but one in a
million for 10^4, and more of closer ones.  Pairs are verified in double precision
and united over all passes.

The sort is one range shuffle for all passes; windows that cross the border of two
partitions are compared in a second, small step.  Equal vectors are one class from
the start.  The window bounds the pairs that a pass looks at, not the links: every
link lies inside a component, so links are counted over the whole component, in
blocks of ``BLOCK`` vectors against each other, as counts (pairs are not written).
Counting is exact and takes the square of a component's *different* vectors; a
task holds two blocks whatever the component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigie.llm.common import fresh, private_columns, read, whole_groups, written
from vigie.llm.components import components

PASSES, BITS, WINDOW = 16, 32, 32
#: vectors of a component that one side of a counting task holds
BLOCK = 1024
#: sorted rows of a partition
PART_ROWS = 1 << 15
_SLICE = 64


@lru_cache(maxsize=4)
def _directions(dim: int) -> np.ndarray:
    return np.random.default_rng([13, dim]).standard_normal((dim, PASSES * BITS))


def _units(vectors: pa.Array) -> np.ndarray:
    """Vectors of one length, scaled to length one in double precision."""
    x = np.asarray(vectors.flatten(), np.float64).reshape(len(vectors), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _with_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cid, label, dim, vec) with the sort keys of all passes."""
    weights = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
    for batch in batches:
        dims = np.asarray(batch.column("dim"))
        for dim in np.unique(dims).tolist():
            rows = batch.filter(pa.array(dims == dim))
            for lo in range(0, rows.num_rows, 2048):  # bounded memory
                part = rows.slice(lo, 2048)
                signs = _units(part.column("vec")) @ _directions(dim) > 0
                keys = signs.reshape(part.num_rows, PASSES, BITS) @ weights
                at = pa.array(np.arange(part.num_rows + 1) * PASSES, pa.int32())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.ListArray.from_arrays(at, pa.array(keys.ravel()))],
                                                 [*part.schema.names, "keys"])


def _lists(rows: pa.Table) -> np.ndarray:
    """A number for each stretch of equal (pass, label, dim)."""
    new = np.zeros(rows.num_rows, np.int64)
    for name in ("pass", "label", "dim"):
        code = np.asarray(rows.column(name).combine_chunks().dictionary_encode().indices)
        new[1:] |= code[1:] != code[:-1]
    return np.cumsum(new)


def _stars(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links among n rows as (row, least row of its component): no more links than rows."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, before[a], low)
        np.minimum.at(root, before[b], low)
        root = root[root]
        if (root == before).all():
            at = np.flatnonzero(root != np.arange(n))
            return at, root[at]


def _window_links(rows: pa.Table, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs among sorted rows at most WINDOW apart, as stars of row numbers."""
    group, dims = _lists(rows), np.asarray(rows.column("dim"))
    vec = rows.column("vec").combine_chunks()
    cuts = np.flatnonzero(np.diff(dims)) + 1
    left, right = [], []
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(dims)]):
        u = _units(vec.slice(lo, hi - lo))
        for s in range(0, hi - lo, _SLICE):
            i, j = np.nonzero(u[s:s + _SLICE] @ u[s:s + _SLICE + WINDOW].T >= cosine)
            ok = (j > i) & (j - i <= WINDOW)
            left.append(i[ok] + lo + s)
            right.append(j[ok] + lo + s)
    a, b = np.concatenate(left), np.concatenate(right)
    same = group[a] == group[b]
    return _stars(rows.num_rows, a[same], b[same])


_FOUND = "a long, b long, border int, side int, pass int, label string, dim int, cid long, vec array<double>"


def _compare(cosine: float):
    """Sorted partitions -> links, and the rows near the borders of the partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, seen, tail = TaskContext.get().partitionId(), 0, None
        names = [x.split()[0] for x in _FOUND.split(", ")]

        def border(rows: pa.Table, number: int, side: int) -> Iterator[pa.RecordBatch]:
            n = rows.num_rows
            cols = [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array([number] * n, pa.int32()), pa.array([side] * n, pa.int32())]
            own = [rows.column(c).combine_chunks() for c in ("pass", "label", "dim", "cid", "vec")]
            yield pa.RecordBatch.from_arrays([*cols, *own], names)

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            if seen < WINDOW:
                yield from border(rows.slice(0, WINDOW - seen), here - 1, 1)
            seen += batch.num_rows
            rows = rows if tail is None else pa.concat_tables([tail, rows])
            cid = np.asarray(rows.column("cid"))
            a, b = _window_links(rows, cosine)
            none = [pa.nulls(len(a), rows.schema.field(c).type) for c in ("pass", "label", "dim", "cid", "vec")]
            yield pa.RecordBatch.from_arrays([pa.array(cid[a]), pa.array(cid[b]), *[pa.nulls(len(a), pa.int32())] * 2, *none], names)
            tail = rows.slice(max(0, rows.num_rows - WINDOW))
        if tail is not None:
            yield from border(tail, here, 0)

    return run


def _across(cosine: float):
    """Rows on both sides of a border -> links."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, first in whole_groups(batches, 1):
            side, dims, cid = (np.asarray(table.column(c)) for c in ("side", "dim", "cid"))
            code = [np.asarray(table.column(c).combine_chunks().dictionary_encode().indices) for c in ("pass", "label", "dim")]
            vec = table.column("vec").combine_chunks()
            for lo, hi in zip(first.tolist(), [*first[1:].tolist(), table.num_rows]):
                at = np.arange(lo, hi)
                for dim in np.unique(dims[at]).tolist():
                    l, r = (at[(side[at] == k) & (dims[at] == dim)] for k in (0, 1))
                    if not len(l) or not len(r):
                        continue
                    near = _units(vec.take(pa.array(l))) @ _units(vec.take(pa.array(r))).T >= cosine
                    for c in code:
                        near &= c[l][:, None] == c[r][None]
                    i, j = np.nonzero(near)
                    yield pa.RecordBatch.from_arrays([pa.array(cid[l[i]]), pa.array(cid[r[j]])], ["a", "b"])

    return run


def _counts(cosine: float):
    """Rows (root, i, j, side, cid, copies, vec) of counting tasks -> (cid, linked copies in the other block)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, first in whole_groups(batches, 3, rows=4 * BLOCK, size=32 << 20):
            side, cid, copies = (np.asarray(table.column(c)) for c in ("block", "cid", "copies"))
            i, j = np.asarray(table.column("i")), np.asarray(table.column("j"))
            vec = table.column("vec").combine_chunks()
            ids, links = [], []
            for lo, hi in zip(first.tolist(), [*first[1:].tolist(), table.num_rows]):
                u, m, c, s = _units(vec.slice(lo, hi - lo)), copies[lo:hi], cid[lo:hi], side[lo:hi]
                if i[lo] == j[lo]:
                    near = u @ u.T >= cosine
                    np.fill_diagonal(near, False)
                    ids.append(c)
                    links.append(near @ m)
                else:
                    x, y = np.flatnonzero(s == i[lo]), np.flatnonzero(s == j[lo])
                    near = u[x] @ u[y].T >= cosine
                    ids += [c[x], c[y]]
                    links += [near @ m[y], m[x] @ near]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.array(np.concatenate(links).astype(np.int64))], ["cid", "links"])

    return run


def _links(classes: DataFrame, cosine: float) -> DataFrame:
    """(a, b) links between classes that connect every component the passes found."""
    keyed = classes.select("cid", "label", "dim", "vec").mapInArrow(
        _with_keys, "cid long, label string, dim int, vec array<double>, keys array<long>")
    order = ["pass", "label", "dim", "key", "cid"]
    rows = keyed.select("label", "dim", "cid", "vec", F.posexplode("keys").alias("pass", "key"))
    parts = max(1, math.ceil(classes.count() * PASSES / PART_ROWS))
    found = written(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_compare(cosine), _FOUND), "passes")
    ends = found.where("border is not null").select("border", "side", "pass", "label", "dim", "cid", "vec")
    across = ends.repartition("border").sortWithinPartitions("border").mapInArrow(_across(cosine), "a long, b long")
    return found.where("a is not null").select("a", "b").unionByName(across)


def _link_counts(members: DataFrame, cosine: float) -> DataFrame:
    """(cid, links): for members (root, cid, copies, vec) of components, the copies of other classes that each links."""
    size = members.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = members.join(size, "root").select("root", "cid", "copies", "vec", F.pmod(F.xxhash64("cid"), blocks).cast("int").alias("block"),
                                              F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    tasks = dealt.select("root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "cid", "copies", "vec")
    tasks = tasks.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j")
    return tasks.mapInArrow(_counts(cosine), "cid long, links long").groupBy("cid").agg(F.sum("links").alias("links"))


@private_columns("vec", "label", "id_col")
def with_duplicates(df: DataFrame, cosine: float = 0.98, vec: str = "embedding", label: str = "label",
                    id_col: str = "vec_id") -> DataFrame:
    """The rows of ``df`` with ``n_links``, ``component_id`` and ``kept``.

    Rows link when their labels are equal, their vectors have one length and
    their cosine is at least ``cosine``.  ``component_id``: smallest id that can
    be reached; ``kept``: the row has that id.  Input columns of these names are
    replaced.

    Odd input: a null label, a null, empty or zero vector, or one with a null or
    non-finite number links with nothing (n_links 0, its own id, kept); equal rows
    link each other; an id on several rows is judged row by row; a null id counts
    only in a component without any other id; no rows give no rows.
    """
    own = [c for c in df.columns if c.lower() not in ("n_links", "component_id", "kept")]
    (cls,) = fresh(df, "cls")
    v = F.col(vec).cast("array<double>")
    whole = F.col(label).isNotNull() & F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    digest = F.md5(F.concat_ws("|", F.col(label).cast("string"), v.cast("string")).cast("binary"))
    rows = df.select(*own, F.when(F.coalesce(whole, F.lit(False)), digest).alias(cls))
    plain = rows.select(F.col(cls).alias("cls"), F.col(label).cast("string").alias("label"), v.alias("vec"), F.col(id_col).alias("id"))
    classes = written(
        plain.where("cls is not null").groupBy("cls").agg(
            F.first("label").alias("label"), F.first("vec").alias("vec"), F.count(F.lit(1)).alias("copies"), F.min("id").alias("low"))
        .withColumn("dim", F.size("vec")).withColumn("cid", F.monotonically_increasing_id()), "vectors")
    comp = components(_links(classes, cosine))  # without the roots themselves
    comp = comp.unionByName(comp.select(F.col("root").alias("node"), "root").distinct())
    members = classes.select("cid", "copies", "vec").join(comp, F.col("cid") == F.col("node")).select("root", "cid", "copies", "vec")
    counts = _link_counts(members, cosine)
    rooted = classes.select("cls", "cid", "copies", "low").join(comp, F.col("cid") == F.col("node"), "left") \
        .join(counts, "cid", "left").select("cls", "low", F.coalesce("root", "cid").alias("root"),
                                            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
    rooted = written(rooted, "linked")
    lows = rooted.groupBy("root").agg(F.min("low").alias("low"))
    judged = rooted.select("cls", "root", "links").join(lows, "root").select(F.col("cls").alias("__cls"), "links", F.col("low").alias("__low"))
    # one row a class; a class with very many rows is on the left side, which adaptive execution may split
    out = rows.join(judged, rows[cls] == judged["__cls"], "left")
    component = F.when(F.col(cls).isNull(), F.col(id_col)).otherwise(F.col("__low"))
    return out.select(*[F.col(c) for c in own], F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col(id_col).eqNullSafe(component).alias("kept"))


def op13_projection_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.98."""
    return with_duplicates(read(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")) \
        .select("vec_id", "n_links", "component_id", "kept")


SQL = """
with recursive v as (select vec_id, label, embedding::double[] as x from embeddings),
ok as (select * from v where label is not null and x is not null and len(list_filter(x, lambda y: y is null or not isfinite(y))) = 0
  and len(list_filter(x, lambda y: y <> 0)) > 0),
pairs as (select a.vec_id as a, b.vec_id as b from ok a join ok b on a.label = b.label and len(a.x) = len(b.x) and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.x, b.x) >= 0.98),
reach as (select vec_id as a, vec_id as b from v union select reach.a, pairs.b from reach join pairs on pairs.a = reach.b),
comp as (select a, min(b) as component_id from reach group by a),
links as (select a, count(*) as n from pairs group by a)
select v.vec_id, coalesce(links.n, 0) as n_links, comp.component_id, v.vec_id = comp.component_id as kept
from v join comp on comp.a = v.vec_id left join links on links.a = v.vec_id
"""
