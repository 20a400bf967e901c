"""Shared windows against brute force over all windows."""

import hashlib
import random
import re

from vigie.llm import decontaminate as D


def words(text):
    return re.findall("[0-9a-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))


def brute(docs, items):
    out = {}
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            b = words(t)
            run = min(13, len(b))
            grams = {tuple(b[k:k + run]) for k in range(len(b) - run + 1)} if b else set()
            for k in range(len(w) - run + 1 if b else 0):
                if tuple(w[k:k + run]) in grams:
                    hit |= set(range(k, k + run))
                    found.add("" if item is None else str(item))
        out[i] = (len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w))
    return out


def make(short):
    rng = random.Random(11)
    vocab = ["the", "of", "Éa", "x1", "ab", "日本", "zz", "q"] + ["w%d" % i for i in range(300)]
    text = lambda n: " ".join(rng.choices(vocab, k=n))
    items = [(i, text(rng.randint(14, 50))) for i in range(12)] + [(50, "rep " * 30), (51, None), (52, ""), (53, "!!")]
    items += [(None, text(20)), (7, text(15))]
    if short:
        items += [(100, "q x1"), (101, "the"), (102, "ab zz w7 w8 q"), (103, " ".join("w%d" % i for i in range(9)))]
    docs = []
    for i in range(60):
        parts = [text(rng.randint(0, 80))]
        for _ in range(rng.randint(0, 2)):
            b = words(rng.choice(items)[1])
            if len(b) > 2:
                a = rng.randrange(len(b) - 1)
                parts += [rng.choice([" ", ", ", "\n"]).join(b[a:a + rng.choice([5, 12, 13, 14, 40])]).upper(), text(rng.randint(0, 30))]
        docs.append((i, " ".join(parts)))
    return docs + [(900, None), (901, ""), (902, "rep " * 500), (903, "Rep-rep"), (904, "q"), (905, docs[3][1]), (906, text(20000))], items


def check(spark, short):
    docs, items = make(short)
    df = spark.createDataFrame([(*d, 5, "k") for d in docs], "doc_id long, text string, n_hit int, item string")
    bench = spark.createDataFrame([(*b, "x") for b in items + items[:2]], "item_id int, text string, iw string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.items, r.contaminated) for r in D.decontaminate(df, bench).collect()}
    want = brute(docs, items)
    assert got == want and sum(v[3] for v in want.values()) > 8
    kept = D.keep_clean(df, bench)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted(i for i, v in want.items() if not v[3])


def test_long_items(spark):
    check(spark, False)


def test_items_shorter_than_a_window_and_a_gram(spark):
    check(spark, True)


def test_spans_and_empty_sides(spark):
    bench = spark.createDataFrame([(1, " ".join("b%d" % i for i in range(20)))], "item_id int, text string")
    df = spark.createDataFrame([(1, "x " + " ".join("B%d" % i for i in range(3, 18)) + " y")], "doc_id long, text string")
    spans = D.find(df, bench)[2].collect()
    assert [(s.item, s.start, s.end) for s in spans] == [("1", 1, 16)]
    assert D.decontaminate(df, bench.where("false")).first().n_hit == 0
    assert D.decontaminate(df.where("false"), bench).count() == 0 and D.keep_clean(df.where("false"), bench).count() == 0
    null_ids = spark.createDataFrame([(None, df.first().text), (None, "clean")], "doc_id long, text string")
    assert sorted(r.n_hit for r in D.decontaminate(null_ids, bench).collect()) == [0, 15]
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")
