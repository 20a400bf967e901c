"""Attention model: encoder against plain loops, gradient against differences, held-out accuracy."""

import random
import zlib

import numpy as np
import pytest

from vigie.llm import quality_model as Q


def plain(text: bytes):
    """Word statistics of each passage by loops."""
    for c in b"\t\r\x0b\x0c\n":
        text = text.replace(bytes([c]), b" ")
    words = text.split(b" ")
    words = [w for w in words if w]
    out, seen = [], set()
    for i in range(0, max(len(words), 1), Q.PASSAGE_WORDS):
        part, here, again, early = words[i:i + Q.PASSAGE_WORDS], set(), 0, 0
        for w in part:
            again += w in here
            early += w in seen
            here.add(w)
            seen.add(w)
        n = max(len(part), 1)
        sizes = [len(w) for w in part] or [0]
        out.append([np.mean(sizes) / 10, np.std(sizes) / 10, again / n, early / n, np.log1p(len(part)) / 5])
    return np.array(out)


def texts(n=40):
    rng = random.Random(1)
    vocab = ["the", "of", "été", "word", "x", "ONE!", "a|b", "日本"]
    return [b"", b" \n", b"  lead", b"one"] + [rng.choice([" ", "\n", "\t "]).join(rng.choices(vocab, k=rng.randint(1, 500))).encode() for _ in range(n)]


def test_passages_against_loops():
    t = texts()
    x, bag = Q.encode_passages(t)
    want = [plain(a) for a in t]
    assert bag.tolist() == [i for i, w in enumerate(want) for _ in w]
    assert np.allclose(x[:, -5:], np.concatenate(want), atol=1e-5)
    some = t[10].split(b" ")[:1] and x[bag == 10]
    assert np.allclose((some[:, :Q._C] ** 2).sum(axis=1), 1, atol=1e-5) and np.allclose((some[:, Q._C:-5] ** 2).sum(axis=1), 1, atol=1e-5)


def test_gradient():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) + rng.normal(size=v.shape) * .1 for k, v in Q.start_params(rng, 6, 5, 4).items()}
    x, bag, y = rng.normal(size=(9, 6)), np.array([0, 0, 1, 1, 1, 1, 2, 3, 3]), np.array([0., 1, 1, 0])
    _, grad = Q.loss_and_gradient(p, x, bag, y)
    for k, v in p.items():
        for i in np.ndindex(v.shape):
            old = v[i]
            v[i] = old + 1e-6
            up = Q.loss_and_gradient(p, x, bag, y)[0]
            v[i] = old - 1e-6
            down = Q.loss_and_gradient(p, x, bag, y)[0]
            v[i] = old
            assert (up - down) / 2e-6 == pytest.approx(grad[k][i], abs=1e-6)


def test_long_text_in_parts_and_in_one_go(monkeypatch):
    rng = np.random.default_rng(3)
    model = Q.MilModel(Q.start_params(rng, Q.N_FEATURES), np.zeros(Q.N_FEATURES), np.ones(Q.N_FEATURES))
    t = texts(6)
    one = model.score(t)
    monkeypatch.setattr(Q, "PART_BYTES", 1)  # every text on its own
    alone = np.array([Q.MilModel.score(model, [a])[0] for a in t[:1]])
    assert alone[0] == pytest.approx(one[0])
    monkeypatch.setattr(Q, "PART_BYTES", 700)
    parts = model.score(t)
    assert np.isfinite(parts).all() and parts[0] == pytest.approx(one[0]) and abs(parts - one).max() < 0.2


def test_learns_labels_of_held_out_documents(spark):
    rng = random.Random(9)
    good = lambda: " ".join(rng.choices(["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta"], k=rng.randint(20, 300)))
    bad = lambda: good() + " " + " ".join(rng.choices(["#$%", "&&&", "***"], k=150)) + " " + good()
    rows = [(i, bad() if i % 3 == 0 else good(), i % 3 != 0) for i in range(400)]
    docs = spark.createDataFrame([(i, t, 5) for i, t, _ in rows] + [(None, None, 1), (401, "", 2)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, int(y)) for i, _, y in rows] + [(None, 1), (3, None), (999, 0)], "doc_id long, quality int")
    model = Q.fit(docs, labels, sample=150)
    got = Q.score(docs, model).withColumn("held", Q.held_out()).collect()
    assert len(got) == 402 and got[0].text is not None and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.doc_id is not None and r.doc_id < 400 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 50 and {r.doc_id for r in held} == {r.doc_id for r in got if r.held and r.doc_id not in (None, 401)}
    assert np.mean([r.predicted == int(r.doc_id % 3 != 0) for r in held]) > 0.95
    assert [r.score for r in Q.score(docs, Q.fit(docs, labels, sample=150)).collect()] == [r.score for r in got]


def test_no_labels_and_no_documents(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = Q.fit(docs, labels)
    assert Q.score(docs, model).first().score == 0.5 and Q.score(docs.where("false"), model).count() == 0
