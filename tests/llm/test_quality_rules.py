"""Quality rules: statistics against loops, estimates and distances against numpy."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from vigie.llm import quality_rules as Q


def stats(text):
    t = text or ""
    words = [w for w in re.split("[ \t-\r]+", t) if w]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    twice = {g for g, n in Counter(grams).items() if n > 1}
    covered = {j for i, g in enumerate(grams) if g in twice for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if re.search("[^ \t-\r]", x)]
    return (len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
            len(covered), sum("A" <= c <= "Z" for c in t))


def corpus(n=260):
    rng = random.Random(3)
    vocab = ["".join(rng.choices("abcdeéf", k=rng.randint(2, 8))) for _ in range(500)]
    out = []
    for i in range(n):
        words = rng.choices(vocab, k=rng.randint(55, 400))
        kind = rng.random()
        if kind < 0.04:
            words = [w + rng.choice(["###", "&&", "*|*"]) for w in words]
        elif kind < 0.08:
            words = [w.upper() + "!!" for w in words]
        lines = [" ".join(words[k:k + 9]) for k in range(0, len(words), 9)]
        if rng.random() < 0.1:
            lines += lines[:2]
        out.append((i, "\n".join(lines), rng.choice(["en", "en", "fr", None]), rng.choice(["a", "a", "a", "b", None]), kind < 0.08))
    return out


ODD = [(1000, None, "en", "a", False), (1001, "", None, None, False), (1002, " \t\x0b\n", "en", "a", False), (None, "one two", "xx", "a", False),
       (1003, "a b c a b c a", "en", "a", False), (1004, "x " * 5000, "en", "a", False), (1005, "A|B\n\nA|B\n \n" * 40, "en", "b", False)]


def test_statistics_against_loops(spark):
    rows = corpus(60) + ODD
    df = spark.createDataFrame([(k, r[1], "clash") for k, r in enumerate(rows)], "k int, text string, n_words string")
    got = {r.k: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.n_upper)
           for r in Q.with_statistics(df).collect()}
    assert got == {k: stats(r[1]) for k, r in enumerate(rows)}


def vector(s, k=60):
    n, chars, sym, dup, rep, up = s
    f = lambda num, base: math.floor(1000 * math.log(1 + 100 * num / (base + k)) + 0.5)
    return [math.floor(1000 * math.log((chars + 5 * k) / (n + k)) + 0.5), f(sym, n), f(dup, n), f(rep, n), f(up, chars)]


def brute_fit(x, p):
    """The same C-steps with numpy, all rows of one group at once."""
    x, floor = np.array(x, float), np.array(p.scale_floor)
    rank = lambda v, share: np.sort(v)[math.ceil(share * len(v)) - 1]
    med = np.array([rank(c, 0.5) for c in x.T])
    mad = np.array([rank(abs(c - m), 0.5) for c, m in zip(x.T, med)])
    starts = [(med, np.diag((1.4826 * mad) ** 2 + floor ** 2)), (x.mean(0), np.cov(x.T, bias=True) + np.diag(floor ** 2))]
    best = None
    for m, c in starts:
        for _ in range(p.steps):
            d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
            bins = np.minimum(6000, np.floor(200 * np.log1p(d)))
            core = x[bins <= rank(bins, p.support)]
            m, c = core.mean(0), np.cov(core.T, bias=True) + np.diag(floor ** 2)
        det = np.linalg.slogdet(c)[1]
        if best is None or det < best[0] - 1e-9:
            best = (det, m, c)
    return best[1:]


def test_verdicts_against_numpy(spark):
    rows = corpus() + ODD
    p = Q.QualityParams()
    schema = "doc_id int, text string, lang string, source string, junk boolean, x0 int, m0 string, grp string"
    df = spark.createDataFrame([(*r, 7, "m", "g") for r in rows], schema)
    got = {r.text: r for r in Q.judge(df, p).collect()}
    assert len(got) == len({r[1] for r in rows}) and all((r.x0, r.m0, r.grp) == (7, "m", "g") for r in got.values())
    s = {r[1]: stats(r[1]) for r in rows}
    failed = {t: v[0] < 50 or 100 * v[4] > 50 * v[0] for t, v in s.items()}
    pools = {}
    for r in rows:
        if not failed[r[1]]:
            for key in ((r[2], r[3]), (r[2],), ()):
                pools.setdefault((len(key), key), []).append(vector(s[r[1]]))
    fits = {k: brute_fit(v, p) for k, v in pools.items() if len(v) >= p.min_group}
    for r in rows:
        g = got[r[1]]
        assert g.base_failed == failed[r[1]]
        use = next((fits[(len(k), k)] for k in ((r[2], r[3]), (r[2],), ()) if (len(k), k) in fits), None)
        x = np.array(vector(s[r[1]])) - use[0]
        assert g.distance == pytest.approx(x @ np.linalg.inv(use[1]) @ x, rel=1e-6, abs=1e-6)
        assert g.kept == (not failed[r[1]] and g.distance <= p.cutoff)
    clean = [r for r in rows[:260] if not r[4] and not failed[r[1]]]
    assert all(got[r[1]].kept for r in clean) and not any(got[r[1]].kept for r in rows[:260] if r[4])


def test_keep_good_returns_rows_as_they_were(spark):
    rows = corpus(100)
    df = spark.createDataFrame([(*r, "d") for r in rows], "doc_id int, text string, lang string, source string, kept boolean, distance string")
    out = Q.keep_good(df)
    assert out.columns == df.columns and out.count() <= 100 and {tuple(r) for r in out.collect()} <= {tuple(r) for r in df.collect()}


def test_few_or_no_rows(spark):
    schema = "doc_id long, text string, lang string, source string"
    few = spark.createDataFrame([(1, "word " + " ".join(map(str, range(80))), "en", "a"), (2, "short", "en", "a")], schema)
    assert {r.doc_id: r.kept for r in Q.judge(few).collect()} == {1: True, 2: False}
    assert Q.judge(few.where("false")).count() == 0 and Q.keep_good(few.where("false")).count() == 0
