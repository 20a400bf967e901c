"""Siren-grouped folds and leakage exclusion (reference fixture: 200 train /
100 test rows over 100 sirens)."""

import random

import pytest
from pyspark.sql import functions as F

from vigie.operators import ranking
from vigie.operators.split import exclude_train_firms, fold_sets, fold_sizes, siren_folds


@pytest.fixture(scope="module")
def frames(spark):
    rnd = random.Random(19)
    sirens = [str(round(rnd.random() * 10 ** 9)).zfill(9) for _ in range(100)]
    train = spark.createDataFrame([(rnd.choice(sirens), rnd.random() > 0.9) for _ in range(200)],
                                  "siren string, output boolean")
    test = spark.createDataFrame([(rnd.choice(sirens), rnd.random() > 0.9) for _ in range(100)],
                                 "siren string, output boolean")
    return train, test


def test_no_siren_overlap(frames):
    train, test = frames
    folds = siren_folds(train, test, 3)
    for i in range(3):
        tr, te = fold_sets(train, test, folds, i)
        assert not {r.siren for r in tr.collect()} & {r.siren for r in te.collect()}


def test_test_folds_disjoint(frames):
    train, test = frames
    folds = siren_folds(train, test, 4)
    seen = set()
    for i in range(4):
        _, te = fold_sets(train, test, folds, i)
        ids = {r.siren for r in te.collect()}
        assert not ids & seen
        seen |= ids


@pytest.mark.parametrize("k", [1, 2, 15, 100])
def test_number_of_folds(frames, k):
    train, test = frames
    folds = siren_folds(train, test, k)
    assert fold_sizes(train, test, folds, k).count() == k
    sizes = [r[1] for r in folds.groupBy("fold").count().collect()]
    assert max(sizes) - min(sizes) <= 1


@pytest.mark.parametrize("k", [0, -15, 101, 3.5])
def test_value_errors(frames, k):
    train, test = frames
    with pytest.raises(ValueError):
        siren_folds(train, test, k)


def test_missing_siren_column(frames):
    train, test = frames
    with pytest.raises(ValueError):
        siren_folds(train.drop("siren"), test, 2)


def test_ntile_matches_sql_ntile(spark, monkeypatch):
    """Distributed rank + ntile equal a single-window ntile, with many buckets."""
    df = spark.range(1037).select(F.col("id"), (F.rand(5) * 1000).alias("h"))
    ranked = ranking.global_rank(df, [F.col("h"), F.col("id")], F.floor(F.col("h") / 50), out="rk")
    got = ranked.select("id", ranking.ntile_from_rank(F.col("rk"), F.lit(1037), 7).alias("t"))
    from pyspark.sql import Window
    want = df.select("id", (F.ntile(7).over(Window.orderBy("h", "id")) - 1).alias("t"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_exclude_train_firms(spark):
    train = spark.createDataFrame([("1",), ("2",)], "siren string")
    test = spark.createDataFrame([("1", 1), ("3", 2), (None, 3)], "siren string, v int")
    assert sorted(r.v for r in exclude_train_firms(test, train).collect()) == [2, 3]
