"""Periodic runs against every stretch of every period."""

import random
import re
import zlib

import numpy as np
import pytest

from vigie.llm import periodic_runs as R


def brute(words):
    """(start, length, period) by start, then period."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)  # the smallest period comes first
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts(seed=4, count=120):
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        vocab = ["é%d" % i for i in range(rng.choice([1, 2, 3, 8, 500]))]
        words = []
        for _ in range(rng.randint(0, 6)):
            part = rng.choices(vocab, k=rng.choice([1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 33, 64, 100]))
            if rng.random() < .5:  # a period that is periodic inside
                part = (part[:rng.randint(1, 3)] * 40)[:len(part)] + rng.choices(vocab, k=rng.randint(0, 2))
            times = rng.choice([1, 1, 2, 3, 4, 5, 9])
            words += (part * times)[:len(part) * times + rng.randint(-len(part) // 2, 0) + 1]
            words += rng.choices(vocab, k=rng.randint(0, 5))
        out.append(words)
    return out


def check(spark, rows, schema="doc_id long, text string"):
    got = R.with_runs(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == len(rows)
    return got


def test_all_runs_and_the_rest_of_the_text(spark):
    many = texts()
    seps = [" ", "\n", "\t \x0b", "\r\n\x0c"]
    rows = [(i, seps[i % 4].join(w) + (" " if i % 3 else "")) for i, w in enumerate(many)]
    total = 0
    for r in check(spark, rows):
        want = brute(many[r.doc_id])
        assert [tuple(x) for x in r.runs] == want, r.doc_id
        assert r.collapsed == collapse(many[r.doc_id], want)
        total += len(want)
    assert total > 200


@pytest.mark.parametrize("period", [*range(1, 20), 31, 32, 33, 63, 64, 100])
def test_every_period_at_the_shortest_length(period):
    rng = random.Random(period)
    part = [str(x) for x in rng.sample(range(10 ** 6), period)]
    for n in (max(6, 4 * period) - 1, max(6, 4 * period), 4 * period + 7):
        body = (part * 16)[:n]
        words = ["a", "b"] + body + ["c"]
        ids = np.unique(words + ["end"], return_inverse=True)[1].astype(np.int64)
        got = R.find_runs(ids, np.array([len(words)]))
        assert sorted(map(tuple, got.tolist())) == brute(words)
        assert len(got) == (n >= max(6, 4 * period))


def test_a_long_text_and_texts_cut_into_chunks(spark, monkeypatch):
    rng = random.Random(9)
    words = [str(rng.randrange(3000)) for _ in range(20_000)]
    part = words[300:3300]
    long = words + part * 5 + ["x"] * 5000 + words[:100]
    rows = [(0, " ".join(long))] + [(i, "a b " * i) for i in range(1, 30)]
    monkeypatch.setattr(R, "_CHUNK", 300)
    got = {r.doc_id: [tuple(x) for x in r.runs] for r in check(spark, rows)}
    assert (20_000, 15_000, 3000) in got[0] and (35_000, 5000, 1) in got[0]
    assert all(got[i] == ([(0, 2 * i, 2)] if i >= 4 else []) for i in range(1, 30))


def test_one_word_for_ever():
    ids = np.append(np.zeros(200_000, np.int64), 1)
    assert R.find_runs(ids, np.array([200_000])).tolist() == [[0, 200_000, 1]]


def test_nulls_repeats_clashing_names_and_no_rows(spark):
    a = "x y z " * 4
    schema = "doc_id long, text string, found int, Runs string, start int"
    rows = [(1, None, 1, "r", 2), (None, "", 1, "r", 2), (2, a, 1, None, 2), (2, a, 1, None, 2), (3, " \n ", 5, "", 0)]
    got = check(spark, rows, schema)
    assert [[tuple(x) for x in r.runs] for r in got] == [[], [], [(0, 12, 3)], [(0, 12, 3)], []]
    assert [r.collapsed for r in got] == ["", "", "x y z", "x y z", ""] and got[0].found == 1 and got[0].start == 2
    assert R.with_runs(spark.createDataFrame([], schema)).count() == 0


def test_query_plants_and_digests(spark, scratch):
    import hashlib
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices("abcdefgh", k=rng.randint(0, 300)))) for i in range(300)] + [(300, None), (None, "a " * 9)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{scratch}/documents.parquet")
    got = {r.doc_id: r for r in R.op11_periodic_runs(spark, scratch).collect()}
    assert len(got) == len(rows)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    hits = 0
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[a + (k - a) % p] if k >= a else w[k] for k in range(n)]
        runs, r = brute(w), got[i]
        best = min(((-m, s, q) for s, m, q in runs), default=None)
        assert r.n_runs == len(runs) and r.runs_sha256 == digest("".join(f"{s},{m},{q}\n" for s, m, q in runs))
        assert r.collapsed_sha256 == digest(collapse(w, runs))
        assert (r.start, r.length, r.period, r.exponent_milli) == (
            (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4)
        hits += bool(runs)
    assert hits > 10
