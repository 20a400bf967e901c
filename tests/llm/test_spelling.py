"""Spelling variants against every pair of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from vigie.llm import spelling as S


def near(a, b):
    """Exactly one insertion, deletion or replacement."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts, ratio=2):
    out = {}
    for w, n in counts.items():
        around = [x for x in counts if near(w, x)]
        best = min(around, key=lambda x: (-counts[x], x), default=None)
        form = best if best is not None and counts[best] >= ratio * n and counts[best] > n else None
        out[w] = [form, n, len(around), counts[form] if form else None]
    for w in out:
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        out[w] = (out[w][0], root, *out[w][1:])
    return out


def vocabulary(seed, size, alphabet, longest):
    rng = random.Random(seed)
    words = set()
    while len(words) < size:
        w = [rng.choice(alphabet) for _ in range(rng.randint(1, longest))]
        words.add("".join(w))
        for _ in range(rng.randint(0, 4)):
            w = list(w)
            at = rng.randrange(len(w) + 1)
            w[at:at + rng.randint(0, 1)] = rng.choice([[], [rng.choice(alphabet)]])
            if w:
                words.add("".join(w))
    return {w: rng.choice([1, 2, 3, 7, 20, 90]) for w in words}


@pytest.mark.parametrize("alphabet,longest", [("ab", 9), ("abcdé\U0001F600ÿ", 7), ("aé", 30)])
def test_scan_finds_all_pairs_of_sorted_lists(alphabet, longest):
    lists = [sorted(vocabulary(s, 60, alphabet, longest)) for s in range(4)] + [["", "a"], [""], ["b"]]
    words = [w for ws in lists for w in ws]
    first = np.cumsum([0] + [len(x) for x in lists[:-1]])
    q, i = S.scan(words, first, np.ones(len(words), bool))
    want = {(a + x, a + y) for a, ws in zip(first, lists) for x, v in enumerate(ws) for y, w in enumerate(ws) if near(v, w)}
    assert len(q) == len(want) and set(zip(q.tolist(), i.tolist())) == want


@pytest.mark.parametrize("group", [2048, 3])
def test_forms_and_roots(spark, monkeypatch, group):
    """Also with lists that are cut again down to one code point."""
    monkeypatch.setattr(S, "GROUP", group)
    counts = vocabulary(1, 500, "abcdeé", 8) | {"x" * 40: 9, "x" * 39: 4, "x" * 39 + "y": 2, "x" * 20 + "y" + "x" * 20: 1}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in S.variants(df).collect()}
    assert got == brute(counts)
    assert sum(r[0] is not None for r in got.values()) > 100 and any(r[1] not in (w, r[0]) for w, r in got.items())


def test_a_long_chain_of_forms(spark):
    counts = {"a" * k: 2 ** (30 - k) for k in range(1, 30)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert {(r.word, r.root) for r in S.variants(df).collect()} == {(w, "a") for w in counts}


def test_nulls_repeats_zeros_and_no_rows(spark):
    schema = "word string, n long, c int, Same string, form string"
    rows = [(None, 5, 1, "", ""), ("", 3, 1, "", ""), ("ab", 1, 1, "", ""), ("ab", 2, 1, "", ""), ("abc", 6, 1, None, None),
            ("q", None, 1, "", ""), ("w", 0, 2, "", "")]
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in S.variants(spark.createDataFrame(rows, schema)).collect()}
    # the empty word has no code point in common with any list: it is near nothing
    assert got == {"": (None, "", 3, 0, None), "ab": ("abc", "abc", 3, 1, 6), "abc": (None, "abc", 6, 1, None),
                   "q": (None, "q", 0, 1, None), "w": (None, "w", 0, 1, None)}
    assert S.variants(spark.createDataFrame([], schema)).count() == 0
    with pytest.raises(ValueError):
        S.variants(spark.createDataFrame([], schema), ratio=1)


def test_query_on_damaged_words(spark, scratch):
    rng = random.Random(3)
    vocab = ["".join(rng.choices("abcdÉéß÷", k=rng.randint(4, 7))) for _ in range(60)]
    rows = [(i, rng.choice(["", " ", ".", "1"]).join(w.upper() if rng.random() < .2 else w + " "
             for w in rng.choices(vocab, k=rng.randint(0, 400)))) for i in range(150)] + [(7, None), (None, "abcde " * 5)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{scratch}/documents.parquet")
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            low = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{i}:{low}".encode())
            if i is not None and h % 97 == 0:
                low = low[:h % len(low)] + low[h % len(low) + 1:]
            counts[low] += 1
    want = brute({w: n for w, n in counts.items() if len(w) >= 5 and n >= 3})
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in S.op12_spelling_variants(spark, scratch).collect()}
    assert got == want and len(got) > 40
