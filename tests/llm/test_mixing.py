"""Mixing: targets against repeated resharing, copies against one plain prefix sum, odd rows."""

import hashlib
import math
import random

import pytest

from vigie.llm import mixing as M


def brute_targets(sizes, weights=(1, 2, 3)):
    """Reshare by weight until no source is above three times its size."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, left = set(), set(order)
    while True:
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        share = {s: rest * w[s] / sum(w[t] for t in left) for s in left}
        over = {s for s in left if share[s] > 3 * sizes[s] + 1e-9}
        if not over:
            return share | {s: 3 * sizes[s] for s in full}
        full |= over
        left -= over


def rows(n=400):
    rng = random.Random(1)
    sources = ["a", "b", "é", None, "", "z" * 30]
    return [(i, rng.choices(sources, [200, 9, 5, 30, 3, 1])[0], " \t".join("w" * rng.randint(1, 3) for _ in range(rng.randint(0, 60)))) for i in range(n)]


@pytest.mark.parametrize("slice_rows", [20_000, 7])
def test_against_plain_prefix_sums(spark, monkeypatch, slice_rows):
    monkeypatch.setattr(M, "SLICE_ROWS", slice_rows)
    data = rows() + [(None, "b", None), (900, "none", ""), (901, "b", "x\x0by\x1cz")]
    df = spark.createDataFrame([(*r, "clash") for r in data], "doc_id long, source string, text string, size string")
    got = M.mix(df).collect()
    size = lambda t: len((t or "").replace("\x1c", "_").split())
    per = {}
    for _, s, t in data:
        per[s] = per.get(s, 0) + size(t)
    want = brute_targets(per)
    copies = {}
    for s in per:
        rate = math.floor(want[s] / per[s] * M.UNIT) if per[s] else 0
        g = "-" if s is None else "=" + s
        at = int(hashlib.md5(f"17|{g}".encode()).hexdigest()[:8], 16)
        tie = lambda r: hashlib.md5("|".join(x for x in ([str(r[0])] if r[0] is not None else []) + ["x"] + ([r[2]] if r[2] is not None else [])).encode()).hexdigest()
        for r in sorted((r for r in data if r[1] == s), key=lambda r: (math.floor(8 * math.log2(size(r[2]) + 1) + 1e-9), tie(r))):
            copies[r] = (at + rate) // M.UNIT - at // M.UNIT
            at += rate
    assert len(got) == len(data)
    for r in got:
        key = (r.doc_id, r.source, r.text)
        assert (r.size, r.source_size, r.copies) == (size(r.text), per[r.source], copies[key])
        assert r.target == pytest.approx(want[r.source]) and r.taken == r.copies * r.size and r.copies <= 3
    for s, total in per.items():
        assert abs(sum(r.taken for r in got if r.source == s) - want[s]) <= 3 * 60 + 0.1 * want[s]


def test_sample_repeats_rows(spark):
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows(120))] * 2, "doc_id long, source string, text string, __k0 long")
    want = {}
    for r in M.mix(df).collect():
        want[r["__k0"]] = want.get(r["__k0"], 0) + r.copies
    out = M.sample(df)
    assert out.columns == df.columns
    got = {r["__k0"]: r.n for r in out.groupBy("__k0").agg(M.F.count(M.F.lit(1)).alias("n")).collect()}
    assert got == {k: n for k, n in want.items() if n}
    assert sorted(map(str, M.sample(df).collect())) == sorted(map(str, out.collect()))


def test_no_rows(spark):
    df = spark.createDataFrame([], "doc_id long, source string, text string")
    assert M.mix(df).count() == 0 and M.sample(df).count() == 0
