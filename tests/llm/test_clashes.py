"""Operators on tables whose further columns are named like anything inside them."""

import re

import pytest
from pyspark.sql import functions as F

from vigie.llm import (chunk_dedup, common, decontaminate, embedding_dedup, license_scan, line_dedup, mixing, periodic_runs, quality_model,
                       quality_rules, simhash, token_files, url_filter)

TEXTS = ["one two three four five six seven eight nine ten " * 8, "one two three four five six seven eight nine ten " * 8 + "more",
         "a b c d " * 30, "Permission is hereby granted.\nThe same line of some length here\nThe same line of some length hers", "", None]


def names(module):
    """Every word of a module's source that could be a column's name there, in lower and in mixed case."""
    found = set()
    for source in (open(module.__file__).read(), open(common.__file__).read()):
        for text in re.findall(r'"([^"\n]*)"', source):
            found |= {w for w in re.findall(r"[A-Za-z_][A-Za-z_0-9]*", text) if len(w) < 20}
    found |= {f"{a}{i}" for a in ("x", "z", "m", "l", "s", "d", "m0", "__c", "__x", "c") for i in range(8)}
    lower = {}
    for w in sorted(found):
        lower.setdefault(w.lower(), w)
    return [w if i % 2 else w.title() for i, w in enumerate(lower.values())]


def bench(spark):
    return spark.createDataFrame([("i1", "one two three four five six seven eight nine ten one two three"), ("i2", "x")], "item_id string, text string")


def docs(spark, taken):
    rows = [(i, t, "en", f"s{i % 2}", 2.5) for i, t in enumerate(TEXTS)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score_in double")
    return d, [n for n in taken if n.lower() not in {c.lower() for c in d.columns}]


OPERATORS = {
    "1": (quality_model, lambda s, d: quality_model.score(d, quality_model.fit(d, s.createDataFrame([(0, 1, 0), (1, 0, 0)], "doc_id long, quality int, toxic int")))),
    "3": (decontaminate, lambda s, d: decontaminate.decontaminate(d, bench(s))),
    "4": (license_scan, lambda s, d: license_scan.scan(d)),
    "5": (line_dedup, lambda s, d: line_dedup.dedup(d)),
    "6": (chunk_dedup, lambda s, d: chunk_dedup.dedup(d)),
    "7": (mixing, lambda s, d: mixing.mix(d)),
    "8": (simhash, lambda s, d: simhash.with_components(d)),
    "9": (quality_rules, lambda s, d: quality_rules.judge(d)),
    "11": (periodic_runs, lambda s, d: periodic_runs.with_runs(d)),
    "2": (token_files, lambda s, d: token_files.encode(d)),
}


def plain(rows, columns):
    return sorted((tuple(str(r[c]) for c in columns) for r in rows))


@pytest.mark.parametrize("n", OPERATORS)
def test_text_operators(spark, n):
    module, run = OPERATORS[n]
    d, more = docs(spark, names(module))
    assert len(more) > 20
    wide = d.select("*", *[F.lit(f"in {c}").alias(c) for c in more])
    alone, beside = run(spark, d), run(spark, wide)
    assert plain(beside.collect(), alone.columns) == plain(alone.collect(), alone.columns)
    if n != "2":  # the file format has columns of its own
        results = {c.lower() for c in alone.columns}
        stays = [c for c in more if c.lower() not in results]
        assert [c for c in beside.columns if c in set(stays)] == stays
        first = beside.first()
        assert all(first[c] == f"in {c}" for c in stays)


def test_pages(spark):
    d = spark.createDataFrame([(1, "http://b.com/de/x"), (2, None)], "page_id long, url string")
    more = [c for c in names(url_filter) if c.lower() not in ("page_id", "url")]
    wide = d.select("*", *[F.lit(f"in {c}").alias(c) for c in more])
    for bound in (0, 1 << 20):
        alone, beside = url_filter.judge(d, max_local_bytes=bound), url_filter.judge(wide, max_local_bytes=bound)
        assert plain(beside.collect(), alone.columns) == plain(alone.collect(), alone.columns)


def test_vectors(spark):
    d = spark.createDataFrame([(1, [1.0, 2.0], 1), (2, [1.0, 2.01], 1), (3, [2.0, 4.0], 1), (4, None, 1)], "vec_id long, embedding array<double>, label int")
    more = [c for c in names(embedding_dedup) if c.lower() not in {x.lower() for x in d.columns}]
    wide = d.select("*", *[F.lit(f"in {c}").alias(c) for c in more])
    alone, beside = embedding_dedup.with_duplicates(d), embedding_dedup.with_duplicates(wide)
    assert plain(beside.collect(), alone.columns) == plain(alone.collect(), alone.columns)


@pytest.mark.parametrize("module", [chunk_dedup, line_dedup])
def test_rows_without_id_that_share_a_32_bit_hash(spark, module):
    """Two texts of one 32-bit hash (found by trying): only the one with a repeat loses something."""
    passage = " ".join(f"word{i}" for i in range(60))
    stem = spark.range(200_000).select(F.concat(F.lit(passage + "\n" + passage + "\nrow "), F.col("id").cast("string")).alias("a"),
                                       F.concat(F.lit(" ".join(f"other{i}" for i in range(60)) + " row "), F.col("id").cast("string")).alias("b"))
    both = stem.select("a", F.hash("a").alias("h")).join(stem.select("b", F.hash("b").alias("h")), "h").orderBy("a").limit(1).collect()
    assert both, "no such pair: try more rows"
    rows = [(None, both[0]["a"]), (None, both[0]["b"])]
    got = {r.text for r in module.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert both[0]["b"] in got and both[0]["a"] not in got
