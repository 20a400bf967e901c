"""Spelling variants: words within one edit, grouped by following the commonest neighbour.

Two words are near if one inserted, deleted or replaced code point turns one into
the other.  The vocabulary is searched by dynamic programming over sorted lists:
a word is compared with a sorted list from its first to its last entry, the rows
of the edit matrix (three cells wide, as one edit leaves no other) that belong to
the prefix shared with the entry before are used again, and once every cell of a
row exceeds one edit, all entries that share this prefix are skipped.  Many words
scan their lists in step in numpy.

One list of all words would be one task, so it is split without losing a pair: in
a pair whose shorter word has c code points, the edit falls into one of the
segments that [0, c) is cut into, and everything before and after that segment is
equal.  Words are dealt by (c, segment, equal part), so each list holds what
differs inside the segment only.  Lists above ``GROUP`` words have their segment
cut in halves again, as often as needed; a segment of one code point bounds a list
by the alphabet.  A pair counts in the segment of its first difference, once.

Pairs are never written: a task gives out the number of near words and the
commonest one for each of its words, and these are merged per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigie.llm.common import read, whole_groups, written
from vigie.llm.periodic_runs import CRC_TABLE, crc_sql

#: words of a list; above, its segment is cut again
GROUP = 2048
_FAR = 9


def _matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words, one row each with a zero before and two or more behind, and their lengths."""
    n = np.fromiter(map(len, words), np.int64, len(words))
    out = np.zeros((len(words), int(n.max(initial=0)) + 3), np.uint32)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    out[np.repeat(np.arange(len(words)), n), at + 1] = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    return out, n


def _shared(codes: np.ndarray, n: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Code points at the start that words a and b have in common."""
    width = codes.shape[1] - 2
    same = codes[a, 1:width + 1] == codes[b, 1:width + 1]
    same &= np.arange(width) < np.minimum(n[a], n[b])[:, None]
    return np.where(same.all(axis=1), width, (~same).argmax(axis=1))


def scan(words: list[str], first: np.ndarray, asks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(q, i): every entry i at one edit from entry q of the same list, for each q that ``asks``.

    ``words``: the lists one after the other, each sorted by code points and
    without repeats; ``first``: the first entry of each list.
    """
    codes, n = _matrix(words)
    total, width = len(words), int(n.max(initial=0))
    shared = np.full(total + 1, -1)  # with the entry before; below any depth where a list begins
    shared[1:total] = _shared(codes, n, np.arange(total - 1), np.arange(1, total))
    shared[first] = -1
    skip = np.empty((width + 2, total), np.int64)  # [d, i]: next entry that does not share d code points with i
    place = np.arange(total + 1)
    for d in range(width + 2):
        ahead = np.where(shared < d, place, total)
        skip[d] = np.minimum.accumulate(ahead[::-1])[::-1][1:]
    end = np.append(first[1:], total)[np.searchsorted(first, place[:-1], side="right") - 1]
    q = np.flatnonzero(asks)
    i, d, slot = end[q] * 0 + first[np.searchsorted(first, q, side="right") - 1], np.zeros(len(q), np.int64), np.arange(len(q))
    rows = np.full((len(q), width + 1, 3), _FAR, np.int8)  # cells of query lengths d - 1, d, d + 1
    rows[:, 0, 1], rows[:, 0, 2] = 0, np.where(n[q] > 0, 1, _FAR)
    found_q, found_i = [], []
    while len(q):
        over = n[i] == d
        if over.any():
            at = np.flatnonzero(over)
            cell = n[q[at]] - d[at] + 1
            near = (cell >= 0) & (cell <= 2)
            at, cell = at[near], cell[near]
            hit = at[(rows[slot[at], d[at], cell] <= 1) & (i[at] != q[at])]
            found_q.append(q[hit])
            found_i.append(i[hit])
        x0, x1, x2 = rows[slot, d].T
        c, left = codes[i, d + 1], n[q] - d
        y0 = np.minimum(x0 + (c != codes[q, d]), x1 + 1)
        y1 = np.where(left >= 1, np.minimum(np.minimum(x1 + (c != codes[q, d + 1]), x2 + 1), y0 + 1), _FAR)
        y2 = np.where(left >= 2, np.minimum(x2 + (c != codes[q, np.minimum(d + 2, width + 2)]), y1 + 1), _FAR)
        deeper = ~over & (np.minimum(np.minimum(y0, y1), y2) <= 1)
        at = np.flatnonzero(deeper)
        rows[slot[at], d[at] + 1] = np.stack([y0[at], y1[at], y2[at]], axis=1)
        d[at] += 1
        at = np.flatnonzero(~deeper)
        i[at] = np.where(over[at], i[at] + 1, skip[d[at] + 1, i[at]])
        d[at] = shared[i[at]]
        going = i < end[q]
        if not going.all():
            q, i, d, slot = q[going], i[going], d[going], slot[going]
    none = np.empty(0, np.int64)
    return np.concatenate([none, *found_q]), np.concatenate([none, *found_i])


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, near, form_n, form) from rows (c, b, e, same, mid, n) sorted by list and mid."""
    for table, first in whole_groups(batches, 4):
        c, b, e, same, mid, n = (table.column(k) for k in range(6))
        c, b, e, n = (x.to_numpy() for x in (c, b, e, n))
        mid = mid.to_pylist()
        size = np.fromiter(map(len, mid), np.int64, len(mid))
        q, i = scan(mid, first, size == e - b)  # the shorter word of a pair asks
        if not len(q):
            continue
        codes, lengths = _matrix(mid)
        own = (e[q] == c[q]) | (_shared(codes, lengths, q, i) < (e - b)[q])
        q, i = q[own], i[own]
        long = size[i] > size[q]
        to, of = np.concatenate([q, i[long]]), np.concatenate([i, q[long]])
        there = np.unique(np.concatenate([to, of]))
        same = same.take(pa.array(there)).to_pylist()
        words = {k: s[:p] + mid[k] + s[p:] for k, s, p in zip(there.tolist(), same, b[there].tolist())}
        rank = np.empty(len(mid), np.int64)
        rank[sorted(words, key=words.get)] = np.arange(len(words))
        by = np.lexsort((rank[of], -n[of], to))
        to, of = to[by], of[by]
        start = np.flatnonzero(np.append(True, to[1:] != to[:-1])) if len(to) else np.empty(0, np.int64)
        best = of[start]
        yield pa.RecordBatch.from_arrays(
            [pa.array([words[k] for k in to[start].tolist()], pa.string()), pa.array(np.diff(np.append(start, len(to)))),
             pa.array(n[best]), pa.array([words[k] for k in best.tolist()], pa.string())], ["word", "near", "form_n", "form"])


def _dealt(rows: DataFrame) -> DataFrame:
    """(word, n, c, b, e) with the equal part ``same`` and what lies in the segment, ``mid``."""
    tail = F.col("c") - F.col("e")
    head, size = F.substring("word", F.lit(1), F.col("b")), F.length("word")
    behind = F.substring(F.col("word"), size - tail + 1, tail)
    return rows.select("c", "b", "e", F.concat(head, behind).alias("same"),
                       F.substring(F.col("word"), F.col("b") + 1, size - F.col("b") - tail).alias("mid"), "n", "word")


def neighbours(vocabulary: DataFrame) -> DataFrame:
    """(word, n_near, form, form_n) of every word with a near word; form: the commonest, then the smallest, of them.

    ``vocabulary``: distinct words and their counts n, in a written table.
    """
    part = lambda c, b, e: F.struct(c.alias("c"), b.alias("b"), e.alias("e"))
    size, zero = F.length("word"), F.lit(0)
    half = lambda c: F.floor(c / 2).cast("int")
    pieces = F.filter(F.array(*[x for c in (size, size - 1) for x in (part(c, zero, half(c)), part(c, half(c), c))]),
                      lambda p: (p["c"] > 0) & (p["e"] > p["b"]))
    rows = vocabulary.where(size > 0).select("word", "n", F.explode(pieces).alias("p")).select("word", "n", "p.*")
    keys, done = ["c", "b", "e", "same"], None
    while True:
        dealt = _dealt(rows)
        # lists that are still too long and can be cut: none on most inputs
        hot = written(dealt.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"))
                      .where((F.col("size") > GROUP) & (F.col("e") - F.col("b") > 1)).drop("size"), "long-lists")
        none = hot.isEmpty()
        ready = (dealt if none else dealt.join(hot, keys, "left_anti")).drop("word").select(*keys, "mid", "n")
        done = ready if done is None else done.unionByName(ready)
        if none:
            break
        mid = half(F.col("b") + F.col("e"))
        rows = written(dealt.join(hot, keys, "left_semi").select("word", "n", F.explode(F.array(
            part(F.col("c"), F.col("b"), mid), part(F.col("c"), mid, F.col("e")))).alias("p")).select("word", "n", "p.*"), "cut-again")
    lists = done.repartition(*keys).sortWithinPartitions(*keys, "mid")
    found = lists.mapInArrow(_neighbours, "word string, near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form"))).alias("best")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best).select(
        "word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def variants(counts: DataFrame, ratio: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``counts`` (columns word, n; others are ignored).

    ``form``: the near word of largest n (ties: smallest in code-point order) if
    its n is ``ratio`` (2 or more) times the word's, else null, as ``form_n``.
    ``root``: reached from the word by following forms; the word itself without one.

    Odd input: a null word is left out; a word on several rows has the sum of
    their n (null n: 0); the empty word is near nothing; a word of n 0 whose
    neighbours have 0 too has no form; words of any length and any code points are allowed; no rows give no rows.
    """
    if ratio < 2:
        raise ValueError("forms must be at least twice as common")
    summed = counts.where("word is not null").groupBy("word").agg(F.sum(F.coalesce("n", F.lit(0))).cast("long").alias("n"))
    vocabulary = written(summed, "vocabulary")
    near = vocabulary.join(neighbours(vocabulary), "word", "left")
    better = (F.col("form_n") >= ratio * F.col("n")) & (F.col("form_n") > F.col("n"))
    words = written(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                F.when(better, F.col("form")).alias("form"), F.when(better, F.col("form_n")).alias("form_n")), "forms")
    # follow two forms at once, then four, ...; n doubles with each form, so this ends after a few rounds
    roots = words.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        up = roots.select(F.col("word").alias("root"), F.col("root").alias("__up"))
        roots = written(roots.join(up, "root", "left").select(
            "word", F.coalesce("__up", "root").alias("root"), F.col("__up").isNotNull().alias("__more")), "roots")
        more = roots.where("__more").isEmpty()
        roots = roots.drop("__more")
        if more:
            break
    return words.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def damaged_words(docs: DataFrame) -> DataFrame:
    """The query's words: letter runs of ``text`` with A-Z lower-cased, one in 97 (by crc32 of id and run) short of a code point.

    A null id damages nothing.
    """
    run, low, h = F.col("run"), F.col("low"), F.col("h")
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"([A-Za-zÀ-ÿ]+)"), 1)).alias("run"))
    # lower() would also change other capitals; it is the cheap way where there are none
    lowered = F.when(F.octet_length(run) == F.length(run), F.lower(run)).otherwise(F.translate(run, _UPPER, _LOWER))
    hashed = runs.select("doc_id", lowered.alias("low")).select(
        "low", F.crc32(F.concat_ws(":", F.col("doc_id").cast("string"), "low").cast("binary")).alias("h"), F.col("doc_id").isNotNull().alias("id"))
    at = (h % F.length(low)).cast("int")
    cut = F.concat(F.substring(low, F.lit(1), at), F.substring(low, at + 2, F.length(low)))
    return hashed.select(F.when(F.col("id") & (h % 97 == 0), cut).otherwise(low).alias("word"))


def vocabulary_of(words: DataFrame, least_length: int = 5, least_n: int = 3) -> DataFrame:
    """(word, n) of the words of at least so many code points and occurrences."""
    return words.where(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_n)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form and root of every word of 5 code points and 3 occurrences in all documents."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return variants(vocabulary_of(damaged_words(docs)))


# Near words through shared keys: a wildcard at each place, and the longer word's deletions.
SQL = f"""
with recursive {CRC_TABLE},
r as (select doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')),
  '{_UPPER}', '{_LOWER}') as low from documents),
o as (select doc_id, low, count(*) as k from r group by doc_id, low),
hashed as (select low, k, {crc_sql("doc_id || ':' || low")} as h from o, crc_table),
w as (select case when h % 97 = 0 then substr(low, 1, h % length(low)) || substr(low, h % length(low) + 2) else low end as word, k from hashed),
v as (select word, cast(sum(k) as bigint) as n from w where length(word) >= 5 group by word having sum(k) >= 3),
places as (select word, n, unnest(range(1, length(word) + 1)) as i from v),
cuts as (select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest from places),
pairs as (select a.word, b.word as near, b.n as near_n from cuts a join cuts b on a.i = b.i and a.rest = b.rest and a.word <> b.word
  and length(a.word) = length(b.word)
  union select c.word, v.word, v.n from cuts c join v on c.rest = v.word
  union select v.word, c.word, c.n from cuts c join v on c.rest = v.word),
best as (select word, count(*) as n_near, arg_min({{'f': near, 'n': near_n}}, (-near_n, encode(near))) as b from pairs group by word),
forms as (select v.word, v.n, coalesce(n_near, 0) as n_near, case when b.n >= 2 * v.n then b.f end as form,
  case when b.n >= 2 * v.n then b.n end as form_n from v left join best using (word)),
walk as (select word, coalesce(form, word) as at from forms
  union all select walk.word, forms.form from walk join forms on forms.word = walk.at where forms.form is not null and walk.at <> walk.word),
ends as (select walk.word, walk.at from walk join forms on forms.word = walk.at where forms.form is null)
select f.word, f.form, e.at as root, f.n, f.n_near, f.form_n from forms f join ends e on e.word = f.word
"""
