"""SimHash links and components against brute force."""

import random

import numpy as np
import xxhash
from pyspark.sql import types as T

from vigie.llm import simhash as S

SCHEMA = "doc_id long, text string, fp int, root string"


def brute_fingerprint(text):
    words = [w for w in (text or "").encode().lower().replace(b"\x0b", b" ").split()]
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    votes = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g, 42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(grams))


def brute_components(fps):
    """doc index -> smallest doc index reachable over links of at most 3 bits."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def texts():
    rng = random.Random(5)
    vocab = ["w%d" % i for i in range(400)] + ["É", "ÄB", "Ab"]
    out = []
    for _ in range(40):
        words = rng.choices(vocab, k=rng.randint(1, 400))
        out.append(" ".join(words))
        for _ in range(rng.randint(0, 6)):
            words = list(words)
            words[rng.randrange(len(words))] = rng.choice(vocab)
            out.append("\t".join(words) if rng.random() < .3 else " \n".join(words).upper())
    return out + ["", None, " \x0b\f ", "one", "one two", "ONE two", "x y z", None]


def test_fingerprints_and_components(spark):
    t = texts()
    df = spark.createDataFrame([(i, x, 7, "r") for i, x in enumerate(t)], SCHEMA)
    got = {r.doc_id: r for r in S.with_components(df).collect()}
    fps = [brute_fingerprint(x) for x in t]
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{f:016x}" for i, f in enumerate(fps)}
    assert [got[i].component_id for i in range(len(t))] == brute_components(fps)
    assert got[0].fp == 7 and got[0].root == "r" and got[3].text == t[3]
    kept = S.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(brute_components(fps)))


def test_long_text_uses_several_chunks(monkeypatch):
    text = " ".join(str(i * i % 977) for i in range(5000))
    monkeypatch.setattr(S, "_CHUNK", 512)
    assert S.fingerprint(text.encode()) == brute_fingerprint(text)


def test_links_of_dense_clusters_at_every_level(spark, monkeypatch):
    """Clusters with many close fingerprints: the hot blocks are cut again and no link is lost."""
    monkeypatch.setattr(S, "HOT_BLOCK", 6)
    rng = np.random.default_rng(3)
    fps = set()
    for centre in rng.integers(0, 1 << 63, 4, dtype=np.int64).tolist():
        for _ in range(60):
            x = centre
            for b in rng.integers(0, 63, rng.integers(0, 6)).tolist():
                x ^= 1 << b
            fps.add(x)
    fps |= set(rng.integers(0, 1 << 63, 200, dtype=np.int64).tolist())
    fps = sorted(fps)
    want = {(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if (a ^ b).bit_count() <= 3}
    df = spark.createDataFrame([(x,) for x in fps], T.StructType([T.StructField("fp", T.LongType())]))
    assert {(r.a, r.b) for r in S.links(df).collect()} == want and len(want) > 100


def test_null_ids_repeated_rows_and_no_rows(spark):
    a = "the same words here again and again " * 5
    df = spark.createDataFrame([(None, a, 1, ""), (None, a, 2, ""), (4, "other text entirely", 3, None),
                                (4, "other text entirely", 3, None)], SCHEMA)
    got = [(r.doc_id, r.component_id) for r in S.with_components(df).collect()]
    assert sorted(got, key=str) == [(4, 4), (4, 4), (None, None), (None, None)]
    assert sorted((r.doc_id for r in S.drop_near_duplicates(df).collect()), key=str) == [4, None]
    none = spark.createDataFrame([], SCHEMA)
    assert S.with_components(none).count() == 0 and S.drop_near_duplicates(none).count() == 0
