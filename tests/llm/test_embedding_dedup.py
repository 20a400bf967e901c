"""Vector links and components against all pairs."""

import numpy as np
import pytest
from pyspark.sql import types as T

from vigie.llm import embedding_dedup as E

SCHEMA = "vec_id long, embedding array<double>, label int, cls string, Kept int"


def brute(rows, cosine=0.98):
    """id -> (n_links, component_id); ids are distinct."""
    def usable(x):
        return x is not None and len(x) and all(y is not None and np.isfinite(y) for y in x) and any(x)
    n, links = len(rows), [0] * len(rows)
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    good = [i for i, r in enumerate(rows) if r[2] is not None and usable(r[1])]
    for dim, label in {(len(rows[i][1]), rows[i][2]) for i in good}:
        at = [i for i in good if len(rows[i][1]) == dim and rows[i][2] == label]
        x = np.array([rows[i][1] for i in at], float)
        x /= np.abs(x).max(axis=1)[:, None]
        x /= np.linalg.norm(x, axis=1)[:, None]
        for p, q in zip(*np.nonzero(np.triu(x @ x.T >= cosine, 1))):
            i, j = at[p], at[q]
            links[i] += 1
            links[j] += 1
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    low = {}
    for i in range(n):
        low.setdefault(find(i), rows[i][0])
        low[find(i)] = min(low[find(i)], rows[i][0])
    return {r[0]: (links[i], low[find(i)]) for i, r in enumerate(rows)}


def near(rng, x, cosine):
    """A vector at this cosine to x."""
    y = rng.standard_normal(len(x))
    y -= x * (x @ y) / (x @ x)
    return cosine * x / np.linalg.norm(x) + np.sqrt(1 - cosine ** 2) * y / np.linalg.norm(y)


def clusters(seed=1, dim=16):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(60):
        centre, label = rng.standard_normal(dim), int(rng.integers(0, 3))
        for _ in range(int(rng.integers(1, 9))):
            x = near(rng, centre, rng.uniform(.985, .9999)) * rng.choice([1e-200, 1., 1e200, 3.])
            for _ in range(int(rng.choice([1, 1, 1, 3]))):  # exact copies
                rows.append((len(rows), x.tolist(), label if rng.random() < .9 else 7, "c", 0))
    centre = rng.standard_normal(dim)  # one large group
    for _ in range(150):
        rows.append((len(rows), near(rng, centre, .995).tolist(), 1, "c", 0))
    bad = [None, [], [0.] * dim, [1., None], [1., float("nan")], [float("inf"), 1.], [1., 2.], [2., 4.]]
    rows += [(len(rows) + k, x, 1, None, None) for k, x in enumerate(bad)]
    x = rows[0][1]
    rows += [(len(rows), x, None, "", 1)]
    order = rng.permutation(len(rows))
    return [(int(order[r[0]]), *r[1:]) for r in rows]


@pytest.mark.parametrize("small", [False, True])
def test_links_and_components(spark, monkeypatch, small):
    """Also with small windows, blocks and partitions (windows across borders, blocks against each other)."""
    if small:
        monkeypatch.setattr(E, "WINDOW", 6)
        monkeypatch.setattr(E, "BLOCK", 16)
        monkeypatch.setattr(E, "PART_ROWS", 500)
    rows = clusters()
    got = {r.vec_id: r for r in E.with_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = brute(rows)
    assert {i: (r.n_links, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (i == r.component_id) for i, r in got.items())
    assert max(n for n, _ in want.values()) > 100 and sum(n > 0 for n, _ in want.values()) > 300
    assert got[rows[0][0]].cls == "c"


def test_recall_of_isolated_pairs_at_the_threshold(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(64).tolist(), 1, "", 0) for i in range(6000)]
    rows += [(6000 + i, near(rng, np.array(rows[i][1]), .9801).tolist(), 1, "", 0) for i in range(400)]
    got = {r.vec_id: r.component_id for r in E.with_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    found = sum(got[6000 + i] == i for i in range(400))
    assert found >= 396, found
    assert all(got[i] == i for i in range(6000))


def test_null_and_repeated_ids_floats_and_no_rows(spark):
    schema = "vec_id long, embedding array<float>, label string"
    x, y = [1., 2., 3.], [3., -2., 1.]
    rows = [(None, x, "a"), (None, x, "a"), (5, y, "a"), (5, y, "a"), (5, x, "b"), (None, None, "a")]
    got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in E.with_duplicates(spark.createDataFrame(rows, schema)).collect()]
    assert sorted(got, key=str) == sorted([(None, 1, None, True)] * 2 + [(5, 1, 5, True)] * 2 + [(5, 0, 5, True), (None, 0, None, True)], key=str)
    assert E.with_duplicates(spark.createDataFrame([], schema)).count() == 0


def test_stars_connect_the_same_rows():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 300, (2, 220))
    at, root = E._stars(300, a, b)
    assert len(at) <= 300 and (root < at).all()

    def parts(pairs):
        low = list(range(300))
        for _ in range(300):
            for i, j in pairs:
                low[i] = low[j] = min(low[i], low[j])
        return low
    assert parts(list(zip(a, b))) == parts(list(zip(at, root)))


def test_query(spark, scratch):
    rows = [(r[0], r[1], r[2]) for r in clusters(3, 64)]
    schema = T.StructType.fromDDL("vec_id long, embedding array<double>, label int")
    spark.createDataFrame(rows, schema).write.parquet(f"{scratch}/embeddings.parquet")
    got = {r.vec_id: (r.n_links, r.component_id) for r in E.op13_projection_passes(spark, scratch).collect()}
    assert got == brute(rows)
