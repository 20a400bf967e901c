"""Substring dedup by content-defined chunks.

A gear rolling hash over the last 16 bytes decides where a text is cut, so the
cuts move with the content and an insertion changes only the chunks around it.
Chunks are deduplicated by digest across all documents: the document with the
smallest id keeps a chunk, and within a document its first occurrence.  Runs of
repeated chunks of at least ``MIN_WORDS`` words are removed; a stray short
repeat (a common phrase, a licence line) stays.

Only digests travel: one shuffle finds the keeper of each digest (partial
aggregation first, so a chunk that a third of all documents share is a handful
of rows), one join marks the repeats, and texts move once, to be cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigie.llm.common import fresh, private_columns, read, text_tag, written

WINDOW = 16
MIN_BYTES, MAX_BYTES, MASK_BITS = 16, 256, 5
#: words of a run of repeated chunks from which it is removed.  A repeated passage
#: shows without a part of a chunk (some 48 bytes) at either end: with 18 words,
#: about 1 in 30 passages of 51 short words and 1 in 100 of 60 is missed, while
#: common phrases and licence lines (up to some 12 words) stay.
MIN_WORDS = 18

_GEAR = np.random.default_rng(6).integers(0, 1 << 16, 256, dtype=np.uint16)


def gear(data: np.ndarray) -> np.ndarray:
    """Gear hash after each byte: sum of gear[b[i-j]] << j for j < 16, modulo 2^16.

    The sum over 16 bytes is built from sums over 1, 2, 4 and 8 bytes.
    """
    h = _GEAR[data]
    for span in (1, 2, 4, 8):
        h[span:] += h[:-span] << np.uint16(span)
    return h


def cut(texts: list[bytes]) -> list[list[int]]:
    """End offsets of the chunks of each text; never inside a UTF-8 character."""
    pad = b"\0" * WINDOW  # the same history before every text
    data = np.frombuffer(b"".join(pad + t for t in texts) + pad, np.uint8)
    whole = (np.append(data[1:], 0) & 0xC0) != 0x80
    marks = np.flatnonzero((gear(data) >> np.uint16(16 - MASK_BITS) == 0) & whole) + 1
    out, at = [], 0
    for t in texts:
        at += WINDOW
        end, last, ends = at + len(t), at, []
        inside = marks[np.searchsorted(marks, at + MIN_BYTES):np.searchsorted(marks, end)].tolist()
        inside.append(end)
        for m in inside:
            if m - last < MIN_BYTES and m != end:
                continue
            while m - last > MAX_BYTES:
                stop = last + MAX_BYTES
                while stop > last + 1 and not whole[stop - 1]:
                    stop -= 1
                ends.append(stop - at)
                last = stop
            if m > last:
                ends.append(m - at)
                last = m
        out.append(ends)
        at = end
    return out


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) -> one row per text: its chunks as arrays (place = start, length, words in one long)."""
    for batch in batches:
        keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        tags = batch.column(2).to_pylist()
        for i in range(0, len(keys), 256):
            part = [t or b"" for t in texts[i:i + 256]]
            rows = []
            for key, tag, t, ends in zip(keys[i:i + 256], tags[i:i + 256], part, cut(part)):
                data = np.frombuffer(t, np.uint8)
                gap = (data == 32) | ((data >= 9) & (data <= 13))
                first = np.concatenate([[0], np.cumsum(~gap & np.concatenate([[True], gap[:-1]]))]) if len(t) else np.zeros(1, int)
                seen, here, place, again = set(), [], [], []
                start = 0
                for end in ends:
                    digest = xxhash.xxh3_128_intdigest(t[start:end])
                    spot = start << 24 | (end - start) << 12 | int(first[end] - first[start])
                    if digest in seen:
                        again.append(spot)
                    else:
                        seen.add(digest)
                        here.append(digest)
                        place.append(spot)
                    start = end
                rows.append((key, tag, len(t), int(first[-1]), len(ends),
                             [(d & (1 << 64) - 1) - (1 << 63) for d in here], [(d >> 64 & (1 << 32) - 1) - (1 << 31) for d in here], place, again))
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate(_ARROW.types)], schema=_ARROW)


_ARROW = pa.schema([("id", pa.int64()), ("tag", pa.binary()), ("n_bytes", pa.int64()), ("n_words", pa.int64()), ("n_chunks", pa.int64()),
                    ("d0", pa.list_(pa.int64())), ("d1", pa.list_(pa.int32())), ("place", pa.list_(pa.int64())), ("again", pa.list_(pa.int64()))])
_CHUNK_SCHEMA = ("id long, tag binary, n_bytes long, n_words long, n_chunks long, d0 array<bigint>, d1 array<int>, "
                 "place array<bigint>, again array<bigint>")


def _spans(places: list[int]) -> tuple[int, list[tuple[int, int]]]:
    """(repeated chunks, spans to remove): adjacent chunks joined, runs of MIN_WORDS words and more."""
    out, start, end, words = [], 0, 0, 0
    for p in sorted(places) + [1 << 62]:
        a, n, w = p >> 24, p >> 12 & 4095, p & 4095
        if a != end or p == 1 << 62:
            if words >= MIN_WORDS:
                out.append((start, end))
            start, words = a, 0
        end, words = a + n, words + w
    return len(places), out


def _to_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [_spans(p) for p in b.column("places").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column("id"), b.column("tag"), pa.array([n for n, _ in found], pa.int64()),
             pa.array([[{"start": a, "end": z} for a, z in s] for _, s in found],
                      pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
            names=["id", "tag", "n_repeated", "spans"])


def repeats(df: DataFrame, text: str = "text", id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(chunked, marked): one row per row of ``df`` with its sizes; per text with repeats: id, tag, n_repeated, spans.

    ``tag`` is a 128-bit digest of the text: rows that share an id keep their own spans.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("binary").alias("t"),
                     text_tag(F.col(text)).alias("tag"))
    chunked = written(rows.mapInArrow(_chunks, _CHUNK_SCHEMA), "chunks")
    each = chunked.select("id", "tag", F.inline(F.arrays_zip("d0", "d1", "place")))
    order = F.coalesce("id", F.lit(-(1 << 63)))  # a null id comes first
    keeper = each.groupBy("d0", "d1").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first")).where("n > 1").drop("n")
    later = each.join(keeper, ["d0", "d1"]).where(order > F.col("first")).select("id", "tag", "place")
    again = chunked.select("id", "tag", F.explode("again").alias("place"))
    places = later.unionByName(again).groupBy("id", "tag").agg(F.collect_set("place").alias("places"))
    marked = places.mapInArrow(_to_spans, "id long, tag binary, n_repeated long, spans array<struct<start:bigint,end:bigint>>")
    return chunked, marked


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut the spans out of the last column but one (bytes); the last column holds them."""
    for b in batches:
        texts, spans = b.column(b.num_columns - 2).to_pylist(), b.column(b.num_columns - 1).to_pylist()
        out = []
        for t, ss in zip(texts, spans):
            if ss:
                parts, at = [], 0
                for s in ss:
                    parts.append(t[at:s["start"]])
                    at = s["end"]
                t = b"".join([*parts, t[at:]])
            out.append(t)
        cols = [b.column(i) for i in range(b.num_columns - 2)] + [pa.array(out, pa.binary()), b.column(b.num_columns - 1)]
        yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)


@private_columns("text", "id_col")
def dedup(df: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``df`` with repeated runs cut out of the text, and what was cut.

    Adds n_repeated (chunks that another document
    or an earlier place keeps), removed_bytes, has_repeat (something was cut) and
    spans (byte ranges of the original text).  Result for odd input: null text
    stays null, empty text stays empty; a null id comes before all others; rows
    with the same id are one document (none loses a chunk to the other); no rows
    give no rows; input columns named like a result are replaced.
    """
    names = ("n_repeated", "removed_bytes", "has_repeat", "spans")
    d = df.drop(*[c for c in names if c in df.columns and c not in (text, id_col)])
    _, marked = repeats(d, text, id_col)
    cols = d.columns
    k_id, k_tag = fresh(d, "__id", "__tag")
    d = d.select("*", F.col(id_col).cast("long").alias(k_id), text_tag(F.col(text)).alias(k_tag))
    m = marked.select(F.col("id").alias("__mid"), F.col("tag").alias("__mtag"), "n_repeated", "spans")
    d = d.join(m, d[k_id].eqNullSafe(m["__mid"]) & (d[k_tag] == m["__mtag"]), "left")
    rest = [c for c in cols if c != text]
    d = d.select(*rest, F.coalesce("n_repeated", F.lit(0)).cast("long").alias("n_repeated"),
                 F.col(text).cast("binary").alias(text), "spans")
    d = d.mapInArrow(_without, d.schema)
    d = d.withColumn(text, F.col(text).cast("string"))
    d = d.withColumn("spans", F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>")))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return d.select(*cols, "n_repeated", removed.alias("removed_bytes"), (F.size("spans") > 0).alias("has_repeat"), "spans")


def op6_gear_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, repeated passages cut out."""
    return dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
