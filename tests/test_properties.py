"""Property checks of the distributed order machinery against plain Python
(hypothesis, few examples: each one is a Spark job)."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vigie.operators import ranking
from vigie.operators.dataset import top_n

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
values = st.lists(st.integers(min_value=0, max_value=40), min_size=1, max_size=120)


@SETTINGS
@given(values, st.booleans())
def test_running_sums_equal_cumsum(spark, monkeypatch_module, xs, descending):
    monkeypatch_module.setattr(ranking, "_TARGET_ROWS_PER_BUCKET", 5)
    keys = sorted(set(xs), reverse=descending)
    weights = {k: xs.count(k) for k in keys}
    df = spark.createDataFrame([(float(k), weights[k]) for k in keys], "k double, w long")
    got = {r.k: r.cum_w for r in ranking.running_sums(df, "k", ["w"], descending=descending).collect()}
    want = dict(zip(map(float, keys), np.cumsum([weights[k] for k in keys]).tolist()))
    assert got == want


@SETTINGS
@given(values, st.integers(min_value=1, max_value=130))
def test_top_n_equals_sort(spark, xs, n):
    rows = [(f"{i:05d}", float(x) / 40.0) for i, x in enumerate(xs)]
    df = spark.createDataFrame(rows, "siret string, random_order double").withColumn("periode", F.lit(1))
    got = sorted((r.siret for r in top_n(df, n, direct_limit=3).collect()))
    want = sorted(s for s, _ in sorted(rows, key=lambda r: (-r[1], r[0]))[:n])
    assert got == want
