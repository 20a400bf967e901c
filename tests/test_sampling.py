"""Reproducible samples: exact distributed top-n, quotas, hash split."""

import re

import pytest
from pyspark.sql import functions as F

from vigie.operators import dataset
from vigie.operators.dataset import DatasetSpec, fetch, fetch_quota, match, normalise_ids, project, quota_sizes, top_n, top_n_per
from vigie.operators.sampling import sample_rows, split_train_test


@pytest.fixture(scope="module")
def panel_like(spark):
    df = spark.range(5000).select(
        F.format_string("%014d", F.col("id") % 1700).alias("siret"),
        F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") / 1700).cast("int") * 31).alias("periode"),
        F.round(F.rand(11), 3).alias("random_order"),   # many ties on purpose
        (F.col("id") % 40).cast("double").alias("effectif"),
        (F.col("id") % 5 == 0).alias("outcome"),
    )
    return df.withColumn("siren", F.substring("siret", 1, 9)).cache()


@pytest.mark.parametrize("n", [1, 17, 999, 4999, 5000, 7000])
def test_top_n_cutoff_equals_sort(panel_like, n):
    want = [tuple(r) for r in panel_like.orderBy(F.desc("random_order"), "siret", "periode").limit(n).collect()]
    got = top_n(panel_like, n, direct_limit=10)
    got = [tuple(r) for r in got.orderBy(F.desc("random_order"), "siret", "periode").collect()]
    assert got == want


def test_quota_sizes_half_even():
    assert quota_sizes(1000, 0.2) == (200, 800)
    assert quota_sizes(5, 0.5) == (2, 3)
    with pytest.raises(ValueError):
        DatasetSpec(proportion_positive_class=1.5)


def test_quota_sample(panel_like):
    spec = DatasetSpec(sample_size=100, proportion_positive_class=0.3, min_effectif=0)
    out = fetch(panel_like, spec)
    counts = {r.outcome: r["count"] for r in out.groupBy("outcome").count().collect()}
    assert counts == {True: 30, False: 70}
    assert spec.sample_size == 100 and spec.outcome is None


def test_quota_short_class_not_topped_up(panel_like):
    small = panel_like.filter(~F.col("outcome") | (F.col("effectif") == 0))
    out = fetch(small, DatasetSpec(sample_size=1000, proportion_positive_class=0.5, min_effectif=0))
    counts = {r.outcome: r["count"] for r in out.groupBy("outcome").count().collect()}
    assert counts[False] == 500 and counts[True] < 500


def test_min_effectif_rules(panel_like):
    zero = match(panel_like, DatasetSpec(min_effectif=0)).count()
    default = match(panel_like, DatasetSpec()).count()
    assert zero == 5000 and default == panel_like.filter("effectif >= 10").count()


def test_project_creates_missing_and_pads(spark):
    df = spark.createDataFrame([("123", "45", 1.0), ("123456789012345", None, 2.0)], "siret string, siren string, x double")
    out = normalise_ids(project(df, ["siret", "siren", "x", "tag_debit"])).collect()
    assert out[0].siret == "00000000000123" and out[0].siren == "000000045" and out[0].tag_debit is None
    assert out[1].siret == "123456789012345" and out[1].siren is None


def test_split_and_sample_are_deterministic(panel_like):
    a, b = split_train_test(panel_like, 0.67, 42)
    assert a.count() + b.count() == 5000
    assert 0.6 < a.count() / 5000 < 0.74
    s1 = sorted(r.siret + str(r.periode) for r in sample_rows(panel_like, 50, seed=3).collect())
    s2 = sorted(r.siret + str(r.periode) for r in sample_rows(panel_like.repartition(7), 50, seed=3).collect())
    assert s1 == s2 and len(s1) == 50


def test_flatten_nested_records(spark):
    from vigie.operators.dataset import flatten

    df = spark.createDataFrame([(("1", "2020-01-01"), ("1", 3.0))],
                               "_id struct<siret:string,periode:string>, value struct<siret:string,x:double>")
    assert flatten(df).columns == ["siret", "x"]


def test_top_n_heavy_tail_recursion(spark):
    """One huge random_order squeezes every other row into the first
    equal-width bucket: the cut-off recurses and stays exact."""
    rows = [(f"{i:05d}", i / 1000.0) for i in range(2000)] + [("99999", 1e12)]
    df = spark.createDataFrame(rows, "siret string, random_order double").withColumn("periode", F.lit(1))
    for n in (1, 2, 777, 2001, 5000):
        got = sorted(r.siret for r in top_n(df, n, direct_limit=5).collect())
        want = sorted(s for s, _ in sorted(rows, key=lambda r: (-r[1], r[0]))[:n])
        assert got == want


def test_top_n_ignores_null_scores_on_both_paths(spark):
    rows = [(f"{i:03d}", None if i % 3 == 0 else i / 100.0) for i in range(60)]
    df = spark.createDataFrame(rows, "siret string, random_order double").withColumn("periode", F.lit(1))
    for limit in (None, 2):
        got = sorted(r.siret for r in top_n(df, 100, direct_limit=limit).collect())
        assert got == sorted(s for s, v in rows if v is not None)


def _executed(spark, df):
    """Operators of the plan that ran."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_large_samples_merge_nothing_in_one_task(spark):
    df = spark.range(30_000).select(F.format_string("%06d", "id").alias("siret"), F.lit(1).alias("periode"),
                                    (F.col("id") % 7 == 0).alias("outcome"), F.xxhash64("id").cast("double").alias("random_order"))
    for out, n in ((top_n(df, 12_345), 12_345), (top_n(df, 12_345, direct_limit=0), 12_345),
                   (top_n_per(df, {True: 3000, False: 9000}, "outcome"), 12_000)):
        plan = _executed(spark, out)
        limits = [int(x) for x in re.findall(r"TakeOrderedAndProject\(limit=(\d+)", plan)]
        assert max(limits, default=0) <= 2000 and "SinglePartition" not in plan.replace("TakeOrdered", "")
        assert out.count() == n


@pytest.mark.parametrize("direct,cut", [(0, 0), (0, 10 ** 6), (3, 40), (50, 5)])
def test_top_rows_per_class_equal_sorts(spark, panel_like, monkeypatch, direct, cut):
    """Histograms of histograms, ranks over many partitions, ties, one class smaller than its quota."""
    monkeypatch.setattr(dataset, "RANGE_ROWS", 7)
    monkeypatch.setattr(dataset, "RANGES", 16)
    df = panel_like.withColumn("kind", F.when(F.col("effectif") < 2, "a").when(F.col("effectif") < 30, "b").otherwise("c"))
    order = [F.desc("random_order"), "siret", "periode"]
    rows = df.orderBy(*order).collect()
    for quotas in ({"a": 100, "b": 1777, "c": 10 ** 6}, {"a": 1, "b": 0, "none": 5}, {"b": 3500}):
        want = sorted((r.siret, r.periode) for v, n in quotas.items() for r in [x for x in rows if x.kind == v][:n])
        got = top_n_per(df, quotas, "kind", direct_limit=direct, cut_limit=cut)
        assert sorted((r.siret, r.periode) for r in got.collect()) == want and got.columns == df.columns
    want = [(r.siret, r.periode) for r in rows[:999]]
    got = top_n(df, 999, direct_limit=direct, cut_limit=cut).orderBy(*order).collect()
    assert [(r.siret, r.periode) for r in got] == want


def test_quota_sample_on_either_path(panel_like):
    spec = DatasetSpec(sample_size=1000, proportion_positive_class=0.15, min_effectif=0)
    rows = lambda df: sorted((r.siret, r.periode, r.outcome) for r in df.collect())
    direct = rows(fetch_quota(panel_like, spec))
    assert len(direct) == 1000 and rows(fetch_quota(panel_like, spec, direct_limit=10)) == direct


def test_odd_scores(spark):
    inf, nan = float("inf"), float("nan")
    scores = [None, nan, inf, -inf, inf, 1e308, -1e308, 0.0, -0.0, 5e-324, 1.0, 2.0]
    df = spark.createDataFrame([(f"{i:02d}", s) for i, s in enumerate(scores)], "siret string, random_order double").withColumn("periode", F.lit(1))
    want = [i for _, i in sorted((-s, i) for i, s in enumerate(scores) if s is not None and s == s)]
    for n in range(1, 12):
        for direct in (None, 0, 2):
            got = sorted(int(r.siret) for r in top_n(df, n, direct_limit=direct).collect())
            assert got == sorted(want[:n]), (n, direct)
    same = spark.range(60).select(F.lit("x").alias("siret"), F.lit(1.0).alias("random_order"), F.lit(1).alias("periode"), "id")
    assert top_n(same, 25, direct_limit=0).count() == 25
    assert top_n_per(same.limit(0), {None: 3}, None).count() == 0
