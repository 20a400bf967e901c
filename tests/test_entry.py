"""Driver contract and a few queries against DuckDB on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tools.compare import compare_frames, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables absent")


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "n_rows" in df.columns


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 45


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, name):
    got = entry.queries()[name](spark, SF).toPandas()
    want = duck(SF).sql(entry.oracle_sql()[name]).df()
    ok, msg = compare_frames(got, want)
    assert ok, msg
