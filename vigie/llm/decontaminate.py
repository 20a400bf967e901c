"""Benchmark decontamination by winnowing.

A window is 13 consecutive words of a benchmark item (a shorter item is one
window).  Both sides hash their k-word grams and keep, of every run of w
consecutive grams, the smallest hash.  With k + w - 1 no longer than the
shortest window, every shared window is guaranteed to have its smallest gram
among the fingerprints of both sides.  Fingerprints are joined; each hit gives
a diagonal (offset of document against item) along which the match is extended
word by word, so hash collisions never count.

DataFrame functions only.  What a text contains depends on the text alone, so
everything runs per distinct text (by a 128-bit digest): a large group of copies
is searched once, and nulls or repeats in the id column do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigie.llm.common import let, private_columns, read, written

WINDOW = 13
GRAM = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of digits, a-z (A-Z lower-cased) and every character from U+0080; null has none."""
    t = F.coalesce(text, F.lit(""))
    # other capitals keep their case; lower() is the cheap way where there are none
    low = F.when(t.rlike(r"[^\x00-\x7F]"), F.translate(t, _UPPER, _LOWER)).otherwise(F.lower(t))
    return F.array_remove(F.split(low, _BETWEEN), "")


def _grams(w: Column, k: int) -> Column:
    """Hashes of all runs of k words (the length is part of the hash)."""
    hashed = F.transform(F.sequence(F.lit(0), F.size(w) - k),
                         lambda i: F.xxhash64(F.lit(k), *[F.get(w, i + j) for j in range(k)]))
    return F.when(F.size(w) >= k, hashed).otherwise(F.array().cast("array<bigint>"))


def _with_fingerprints(d: DataFrame, w: str, plan: tuple[int, tuple[int, ...]], out: str) -> DataFrame:
    """Add the array of distinct fingerprints of the word array ``w``."""
    run, short = plan
    d = d.withColumn("__h", _grams(F.col(w), GRAM))
    h = F.col("__h")
    least = F.when(F.size(h) > 0, F.transform(F.sequence(F.lit(1), F.greatest(F.size(h) - run + 1, F.lit(1))),
                                              lambda i: F.array_min(F.slice(h, i, run))))
    parts = [F.coalesce(least, F.array().cast("array<bigint>")), *[_grams(F.col(w), k) for k in short]]
    return d.withColumn(out, F.array_distinct(F.concat(*parts))).drop("__h")


def _seeds(d: DataFrame, key: list[str], w: str, plan: tuple[int, tuple[int, ...]]) -> DataFrame:
    """(key, position, gram hash) of all grams."""
    sizes = [GRAM, *plan[1]]
    rows = F.concat(*[F.transform(_grams(F.col(w), k), lambda h, i: F.struct(i.alias("pos"), h.alias("gram"))) for k in sizes])
    return d.select(*key, F.inline(rows))


def digest(text: Column) -> list[Column]:
    """Two 64-bit hashes that stand for the text (null and empty alike)."""
    t = F.coalesce(text, F.lit(""))
    return [F.xxhash64(t).alias("__d0"), F.xxhash64(F.lit("second"), t).alias("__d1")]


def _items(benchmark: DataFrame, text: str, item_id: str) -> tuple[DataFrame, tuple[int, tuple[int, ...]]]:
    """(item, iw, len) and the fingerprint plan: run length, gram sizes of very short items."""
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), words(F.col(text)).alias("iw"))
    items = written(items.where(F.size("iw") > 0).distinct().withColumn("len", F.size("iw")), "items")
    lengths = sorted(r.len for r in items.where(F.col("len") < WINDOW).select("len").distinct().collect())  # 12 at most
    shortest = min([x for x in lengths if x >= GRAM], default=WINDOW)
    return items, (shortest - GRAM + 1, tuple(x for x in lengths if x < GRAM))


def find(docs: DataFrame, benchmark: DataFrame, text: str = "text", bench_text: str = "text",
         item_id: str = "item_id", drop: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(tagged, found, spans).

    tagged: the columns of ``docs`` without ``drop``, n_words and the text's
    digest (__d0, __d1).  found: digest -> n_hit, items (sorted item ids), only
    for texts with a hit.  spans: digest, item, start, end (word positions,
    end exclusive) of every matching window, neighbouring windows merged.
    """
    key = ["__d0", "__d1"]
    items, plan = _items(benchmark, bench_text, item_id)
    tagged = docs.select("*", *digest(F.col(text))).withColumn("__w", words(F.col(text)))
    tagged = _with_fingerprints(tagged, "__w", plan, "__fps").withColumn("n_words", F.size("__w").cast("long"))
    tagged = written(tagged.drop("__w", *drop), "winnowed")
    marks = _with_fingerprints(items, "iw", plan, "fps").select("item", "len", F.explode("fps").alias("gram"))
    grams = written(marks.select("gram").distinct(), "marks")
    # a text with any benchmark fingerprint is a candidate; its words are needed from here on
    hits = tagged.select(*key, F.explode("__fps").alias("gram")).join(grams, "gram", "left_semi").select(*key).distinct()
    hits = written(hits, "candidates")
    cand = docs.select(F.col(text).alias("__text"), *digest(F.col(text))).join(hits, key, "left_semi")
    cand = written(cand.groupBy(*key).agg(F.any_value("__text").alias("__text"))
                   .select(*key, words(F.col("__text")).alias("dw")), "candidate-words")
    item_seeds = _seeds(items, ["item", "iw", "len"], "iw", plan).join(grams, "gram", "left_semi") \
        .select("gram", "item", F.col("pos").alias("q"))
    diag = _seeds(cand, key, "dw", plan).join(written(item_seeds, "seeds"), "gram") \
        .select(*key, "item", (F.col("pos") - F.col("q")).alias("diag")).distinct()
    both = diag.join(cand, key).join(items, "item")
    # extension: word by word along the diagonal, then every window that matches throughout
    same = F.transform("iw", lambda x, q: F.coalesce(F.get("dw", q + F.col("diag")) == x, F.lit(False)))
    run = F.least(F.col("len"), F.lit(WINDOW))
    starts = let(same, lambda e: F.filter(F.sequence(F.lit(0), F.col("len") - run),
                                          lambda s: F.forall(F.slice(e, s + 1, run), lambda x: x)))
    both = written(both.select(*key, "item", "diag", run.alias("run"), starts.alias("starts")), "matches").where(F.size("starts") > 0)
    hit = F.array_distinct(F.flatten(F.transform("starts", lambda s: F.sequence(s + F.col("diag"), s + F.col("diag") + F.col("run") - 1))))
    n_hit = both.select(*key, F.explode(hit).alias("pos")).distinct().groupBy(*key).agg(F.count(F.lit(1)).alias("n_hit"))
    names = both.select(*key, "item").distinct().groupBy(*key).agg(F.sort_array(F.collect_list("item")).alias("items"))
    # neighbouring windows of one diagonal merge into one span
    first = F.filter("starts", lambda s: ~F.array_contains("starts", s - 1))
    last = F.filter("starts", lambda s: ~F.array_contains("starts", s + 1))
    spans = both.select(*key, "item", "diag", "run", F.inline(F.arrays_zip(first.alias("a"), last.alias("b")))) \
        .select(*key, "item", (F.col("a") + F.col("diag")).cast("long").alias("start"),
                (F.col("b") + F.col("diag") + F.col("run")).cast("long").alias("end"))
    return tagged.drop("__fps"), n_hit.join(names, key), spans


@private_columns("text")
def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", bench_text: str = "text",
                  item_id: str = "item_id", drop: tuple[str, ...] = ()) -> DataFrame:
    """The rows of ``docs`` with n_words, n_hit, n_items, items and contaminated.

    A document is contaminated if at least one in twenty of its words lies in a
    shared window.  Result for odd input: null and empty texts have no words and
    no hits; items without words match nothing; a null item id counts as the id
    ''; repeated rows and repeated items change nothing; an empty benchmark hits
    nothing; input columns named like a result are replaced.
    """
    clash = [c for c in ("n_words", "n_hit", "n_items", "items", "contaminated") if c in docs.columns and c != text]
    tagged, found, _ = find(docs.drop(*clash), benchmark, text, bench_text, item_id, drop)
    d = tagged.join(written(found, "found"), ["__d0", "__d1"], "left").drop("__d0", "__d1")
    d = d.withColumns({"n_hit": F.coalesce("n_hit", F.lit(0)).cast("long"),
                       "items": F.coalesce("items", F.array().cast("array<string>"))})
    return d.withColumns({"n_items": F.size("items").cast("long"),
                          "contaminated": (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))})


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with the columns of ``docs``."""
    tagged, found, _ = find(docs.select("text"), benchmark, drop=("text",))
    key = ["__d0", "__d1"]
    bad = found.join(tagged.select(*key, "n_words").distinct(), key).where(20 * F.col("n_hit") >= F.col("n_words")).select(*key)
    own = [f"__c{i}" for i in range(len(docs.columns))]
    d = docs.toDF(*own)
    d = d.select("*", *digest(d[own[docs.columns.index("text")]])).join(written(bad, "contaminated"), key, "left_anti")
    return d.select(*[F.col(o).alias(c) for o, c in zip(own, docs.columns)])


def op3_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items."""
    d = decontaminate(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"), drop=("text",))
    sha = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return d.select("doc_id", "n_words", "n_hit", "n_items", sha, "contaminated")


#: The contract as one DuckDB query: all windows of both sides, joined as text.
SQL = """
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[0-9a-z\\x{80}-\\x{10FFFF}]+') as w from documents),
b as (select cast(item_id as varchar) as item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[0-9a-z\\x{80}-\\x{10FFFF}]+') as w from benchmark),
bl as (select item, w, least(13, len(w)) as run from b where len(w) > 0),
bw as (select distinct item, run, array_to_string(list_slice(w, s, s + run - 1), ' ') as gram
       from (select item, w, run, unnest(range(1, len(w) - run + 2)) as s from bl)),
runs as (select distinct run from bl),
dw as (select doc_id, run, s, array_to_string(list_slice(w, s, s + run - 1), ' ') as gram
       from (select doc_id, w, run, unnest(range(1, len(w) - run + 2)) as s from d, runs where len(w) >= run)),
m as (select doc_id, s, run, item from dw join bw using (run, gram)),
h as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(s, s + run)) as p from m) group by doc_id),
i as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids
      from (select distinct doc_id, item from m) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join h using (doc_id) left join i using (doc_id)
"""
