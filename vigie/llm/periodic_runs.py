"""Periodic runs of words, found through string synchronising sets.

A run is a stretch of consecutive words with smallest period q and at least
max(6, 4 q) words that no neighbouring word extends.  Runs with q below ``SMALL``
are stretches of words equal to the word q places on, found directly.  A longer
period belongs to one dyadic scale, t <= q < 2 t:

* the synchronising set of the scale holds the positions i whose context of 2 t
  words has its least t-word hash, over the t + 1 windows that start in it, at the
  first or the last window.  Membership depends on the context alone, so it recurs
  with the period; windows inside a known run of a period up to t / 4 do not take
  part, so highly periodic regions hold no position (their runs are known from
  smaller scales);
* a run of period q has a position among its first t words, and the next position
  with an equal context is exactly q words on, as 3 t + q <= 4 q.  Consecutive
  positions with equal contexts, t to 2 t - 1 words apart, propose that distance;
* a proposal is extended word by word to both sides, which gives the run.

Everything is one text's words at a time, many texts in one numpy array (longest
first, so the texts that are long enough for a scale are a prefix of it).  No
shuffle: rows stay where they are, a lost executor costs its own rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigie.llm.common import fresh, let, private_columns, read, words_of

MIN_WORDS, MIN_PERIODS = 6, 4
#: periods below are compared directly; also the first scale
SMALL = 4
#: bytes of text that are searched together (a longer text alone)
_CHUNK = 1 << 20
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _stretches(mask: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches of True with at least ``least`` places."""
    edge = np.flatnonzero(np.diff(mask, prepend=False, append=False))
    start, end = edge[::2], edge[1::2]
    long = end - start >= least
    return start[long], end[long]


def _agree(ids: np.ndarray, at: int, d: int, step: int) -> int:
    """Places from ``at`` on, in the direction of ``step``, whose word equals the word d on."""
    total, size = 0, 64
    while True:
        if step > 0:
            lo, hi = at + total, min(at + total + size, len(ids) - d)
        else:
            lo, hi = max(at - total - size + 1, 0), at - total + 1
        if lo >= hi:
            return total
        same = ids[lo:hi] == ids[lo + d:hi + d]
        bad = np.flatnonzero(~same)
        if len(bad):
            return total + int(bad[0] if step > 0 else hi - lo - 1 - bad[-1])
        total, size = total + hi - lo, 2 * size


def find_runs(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """(start, length, period) of every run, in no order.

    ``ids``: the words of all texts as numbers, a number that occurs once after
    each text; ``lengths``: words per text, descending.
    """
    known: list[tuple[int, int, int]] = []  # start, end, period; at least MIN_PERIODS periods
    for q in range(1, SMALL):
        if len(ids) <= q:
            break
        for b, e in zip(*_stretches(ids[:-q] == ids[q:], (MIN_PERIODS - 1) * q)):
            if q == 1 or (ids[b:b + q] != ids[b]).any():  # these periods are primes: else the smallest is 1
                known.append((int(b), int(e) + q, q))
    t, level = SMALL, _mix(ids.astype(np.uint64) + np.uint64(1))
    span, ends = 1, np.cumsum(lengths + 1)
    while len(lengths) and lengths[0] >= MIN_PERIODS * t:
        n = int(ends[np.searchsorted(-lengths, -MIN_PERIODS * t, side="right") - 1])  # words of the long enough texts
        while span < t:
            level = _mix(level[:-span] * np.uint64(0x9E3779B97F4A7C15) + level[span:])
            span *= 2
        h = level[:max(n - t + 1, 0)].copy()
        for b, e, q in known:
            if 4 * q <= t <= e - b and b < len(h):
                h[b:e - t + 1] = _NONE
        least, width = h, 1
        while width < t:  # least[i]: over the windows that start at i .. i + width - 1
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        m = len(least) - 1
        if m < 1:
            break
        least = np.minimum(least[:m], h[t:t + m])  # ... i + t
        chosen = np.flatnonzero((least != _NONE) & ((least == h[:m]) | (least == h[t:t + m])))
        context = level[chosen] * np.uint64(0x9E3779B97F4A7C15) + level[chosen + t]
        order = np.argsort(context, kind="stable")
        at, context = chosen[order], context[order]
        d = at[1:] - at[:-1]
        good = (context[1:] == context[:-1]) & (d >= t) & (d < 2 * t)
        last: dict[int, int] = {}  # period -> end of the last stretch looked at
        pairs = np.unique(np.stack([at[:-1][good], d[good]], axis=1), axis=0)
        for s, q in pairs.tolist():
            if s < last.get(q, -1):
                continue
            right = _agree(ids, s, q, 1)
            left = _agree(ids, s - 1, q, -1) if s else 0
            last[q] = s + right
            if right and left + right >= (MIN_PERIODS - 1) * q:
                known.append((s - left, s + right + q, q))
        t *= 2
    out = np.array(known, np.int64).reshape(-1, 3)
    out[:, 1] -= out[:, 0]
    return out[out[:, 1] >= np.maximum(MIN_WORDS, MIN_PERIODS * out[:, 2])]


def _search(texts: pa.Array) -> pa.StructArray:
    """runs and collapsed text of each text."""
    words = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat, offsets = words.flatten(), words.offsets.to_numpy().astype(np.int64)
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    offsets = np.append(0, np.cumsum(full))[offsets - offsets[0]]
    flat = flat.filter(pa.array(full))
    n, count = np.diff(offsets), len(texts)
    ids = np.asarray(flat.dictionary_encode().indices).astype(np.int64)
    # the texts in one array, longest first, a number of its own after each
    order = np.argsort(-n, kind="stable")
    begin = np.cumsum(n[order] + 1) - (n[order] + 1)  # in the order of length
    place = np.empty(count, np.int64)
    place[order] = begin
    joined = np.empty(len(ids) + count, np.int64)
    joined[begin + n[order]] = len(ids) + np.arange(count)
    to = np.arange(len(ids)) + np.repeat(place - offsets[:-1], n)
    joined[to] = ids
    runs = find_runs(joined, n[order])
    which = order[np.searchsorted(begin, runs[:, 0], side="right") - 1]
    start = runs[:, 0] - place[which]
    by = np.lexsort((runs[:, 2], start, which))
    which, start, length, period = which[by], start[by], runs[by, 1], runs[by, 2]
    keep = np.ones(len(ids), bool)
    for b, e in zip((offsets[which] + start + period).tolist(), (offsets[which] + start + length).tolist()):
        keep[b:e] = False
    kept = np.append(0, np.cumsum(keep))[offsets]
    rest = pa.ListArray.from_arrays(pa.array(kept, pa.int32()), flat if keep.all() else flat.filter(pa.array(keep)))
    per = np.searchsorted(which, np.arange(count + 1))
    found = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"])
    return pa.StructArray.from_arrays(
        [pa.ListArray.from_arrays(pa.array(per, pa.int32()), found), pc.binary_join(rest, " ")], ["runs", "collapsed"])


_TYPE = "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def _chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(first, count) of the texts searched together."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    begin, total = 0, 0
    for i, s in enumerate(size.tolist()):
        if i > begin and total + s > _CHUNK:
            yield begin, i - begin
            begin, total = i, 0
        total += s
    if len(size):
        yield begin, len(size) - begin


@private_columns("text")
def with_runs(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``df`` with ``runs`` and ``collapsed``.

    ``runs``: array of (start, length, period) in words, by start, then period.
    ``collapsed``: the words joined by one space, without those that some run
    contains after that run's first period words.  Input columns of these two
    names are replaced.

    Odd input: null and empty texts have no run and an empty ``collapsed``; a
    text of any length is searched whole; repeated rows are each answered; no
    rows give no rows.
    """
    own = [c for c in df.columns if c.lower() not in ("runs", "collapsed")]
    (tmp,) = fresh(df, "words")
    rows = df.select(*own, F.col(text).cast("string").alias(tmp))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for first, count in _chunks(texts):
                found = _search(texts.slice(first, count))
                part = batch.slice(first, count)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *found.flatten()], [*part.schema.names[:-1], "runs", "collapsed"])

    schema = T.StructType([*rows.schema.fields[:-1], *T.StructType.fromDDL(_TYPE).fields])
    return rows.mapInArrow(search, schema)


def longest_run(runs: Column) -> Column:
    """The run of greatest length (ties: smallest start, then period); null without a run."""
    return F.element_at(F.sort_array(F.transform(runs, lambda r: F.struct(
        (-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length")))), 1)


def planted(text: Column, doc_id: Column) -> Column:
    """The query's text: one document in ten (crc32 of its id) repeats its words from one place on; a null id never."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g, low = F.floor(h / 10), F.lit(0).cast("long")

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = F.when(n > 0, g % n).otherwise(low)
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return let(F.struct(a.alias("a"), p.alias("p")), lambda v: F.array_join(F.transform(words, lambda w, i: F.when(
            i >= v["a"], F.get(words, (v["a"] + (i - v["a"]) % v["p"]).cast("int"))).otherwise(w)), " "))

    return F.when(h % 10 == 0, let(words_of(text), repeated)).otherwise(text)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document: their number, the longest, and digests of all runs and of the collapsed text."""
    docs = read(spark, sf_dir, "documents").select("doc_id", planted(F.col("text"), F.col("doc_id")).alias("text"))
    best, line = F.col("best"), F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return with_runs(docs).withColumn("best", F.when(F.size("runs") > 0, longest_run(F.col("runs")))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.floor(1000 * best["length"] / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(line, lambda s: F.concat(s, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


#: DuckDB: crc32 of the text x (given as ASCII or not) by its table of 256 entries, made from the polynomial.
CRC_TABLE = """crc_table as (select list_transform(range(256), lambda x: list_reduce(range(8), lambda a, i:
  case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end, x)) as tab)"""


def crc_sql(text: str) -> str:
    """DuckDB expression: unsigned crc32 of the UTF-8 bytes of ``text``; ``crc_table`` must be joined."""
    hexed = f"hex(encode({text}))"
    byte = f"(('0x' || substr({hexed}, 2 * i + 1, 2))::bigint)"
    return (f"xor(4294967295, list_reduce(list_transform(range(length({hexed}) // 2), lambda i: {byte}), "
            f"lambda a, b: xor(a >> 8, tab[xor(a & 255, b) + 1]), 4294967295::bigint))")


# The same answers from all equal word pairs, gaps and islands.
SQL = f"""
with {CRC_TABLE},
d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
hashed as (select doc_id, w, len(w) as n, {crc_sql("cast(doc_id as varchar)")} as h from d, crc_table),
cut as (select doc_id, w, n, h, case when n > 0 then (h // 10) % n else 0 end as a from hashed),
planted as (select doc_id, n, case when h % 10 = 0 and n > 0 then
    list_transform(range(n), lambda i: w[1 + case when i >= a then a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) else i end])
  else w end as w from cut),
pos as (select doc_id, n, unnest(w) as word, unnest(range(n)) as i from planted),
eq as (select x.doc_id, y.i - x.i as q, x.i from pos x join pos y
  on x.doc_id = y.doc_id and x.word = y.word and y.i > x.i and 4 * (y.i - x.i) <= x.n),
isl as (select doc_id, q, min(i) as start, count(*) + q as length
  from (select *, i - row_number() over (partition by doc_id, q order by i) as g from eq) group by doc_id, q, g
  having count(*) + q >= greatest(6, 4 * q)),
runs as (select doc_id, start, length, min(q) as period from isl group by doc_id, start, length),
agg as (select doc_id, count(*) as n_runs, arg_min({{'s': start, 'l': length, 'p': period}}, (-length, start, period)) as b,
  string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as lines from runs group by doc_id),
dropped as (select distinct doc_id, unnest(range(start + period, start + length)) as i from runs),
left_over as (select p.doc_id, string_agg(p.word, ' ' order by p.i) as body
  from pos p anti join dropped x on p.doc_id = x.doc_id and p.i = x.i group by p.doc_id)
select p.doc_id, coalesce(n_runs, 0) as n_runs, b.s as start, b.l as length, b.p as period,
  1000 * b.l // b.p as exponent_milli, sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(body, '')) as collapsed_sha256
from planted p left join agg using (doc_id) left join left_over using (doc_id)
"""
