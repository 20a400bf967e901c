"""A panel grown by months against the panel built at once."""

import os

import pytest
from pyspark.sql import functions as F

from vigie.schema import PANEL_COLUMNS
from vigie.sources.incremental import PanelStore
from vigie.sources.panel import build_panel

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables absent")


@pytest.fixture(scope="module")
def whole(spark):
    return rows(build_panel(spark, SF))


def rows(df):
    return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect())


def months(path, table):
    """{partition: names of its files}"""
    root = f"{path}/{table}"
    return {d: sorted(f for f in os.listdir(f"{root}/{d}") if f.endswith(".parquet")) for d in os.listdir(root) if "=" in d}


def test_appends_equal_one_build_and_rewrite_only_their_months(spark, scratch, whole):
    store = PanelStore(spark, f"{scratch}/store")
    store.append(SF, until="1997-03-01")
    assert rows(store.read()) == rows(build_panel(spark, SF, until="1997-03-01"))
    before = {t: months(store.path, t) for t in ("core", "monthly")}
    store.append(SF, since="1997-03-01", until="1999-06-01")
    assert rows(store.read()) == rows(build_panel(spark, SF, until="1999-06-01"))
    for t, files in before.items():
        now = months(store.path, t)
        assert {d: now[d] for d in files} == files and len(now) > len(files)
    before = months(store.path, "core")
    store.append(SF, since="1999-06-01")
    assert store.read().columns == list(PANEL_COLUMNS) and rows(store.read()) == whole
    now = months(store.path, "core")
    assert {d for d in before if now[d] != before[d]} == set() and all(d >= "periode=1999-06-01" for d in now if d not in before)
    assert store.months()[:2] == ["1997-03-01", "1999-06-01"]


def test_replaced_months_and_a_start_without_a_snapshot(spark, scratch, whole):
    store = PanelStore(spark, f"{scratch}/store")
    store.append(SF, until="1998-01-01")
    store.append(SF, since="1998-01-01", until="2000-01-01")
    before = months(store.path, "core")
    store.append(SF, since="1998-07-01")   # no snapshot of this month; replaces eighteen months
    assert rows(store.read()) == whole and "2000-01-01" not in store.months()
    now = months(store.path, "core")
    assert all((now[d] == before[d]) == (d < "periode=1998-07-01") for d in before)
    store.append(SF, since="1998-07-01")   # again: the same rows
    assert rows(store.read()) == whole


def test_an_unfinished_append_is_not_seen(spark, scratch, monkeypatch, whole):
    store = PanelStore(spark, f"{scratch}/store")
    store.append(SF, until="1999-01-01")
    old = rows(store.read())
    monkeypatch.setattr(store, "_advanced", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        store.append(SF, since="1999-01-01")
    assert rows(store.read()) == old
    monkeypatch.undo()
    store.append(SF, since="1999-01-01")
    assert rows(store.read()) == whole


def test_refused_months(spark, scratch):
    store = PanelStore(spark, f"{scratch}/store")
    with pytest.raises(ValueError, match="nothing"):
        store.read()
    with pytest.raises(ValueError, match="empty store"):
        store.append(SF, since="1999-01-01")
    store.append(SF, until="1996-01-01")
    for since, until, why in ((None, None, "already"), ("1997-01-01", None, "left out"), ("1995-06-01", "1995-09-01", "cut"),
                              ("1995-06-15", None, "first day")):
        with pytest.raises(ValueError, match=why):
            store.append(SF, since=since, until=until)


def test_the_look_back_reads_twelve_months_of_changed_customers_only(spark, scratch):
    store = PanelStore(spark, f"{scratch}/store")
    store.append(SF, until="2000-01-01")
    monthly = store._table("monthly")
    fresh = monthly.where(F.col("periode") >= F.lit("1999-12-01").cast("date"))
    plan = monthly.where((F.col("periode") < F.lit("1999-12-01").cast("date")) & (F.col("periode") >= F.add_months(
        F.lit("1999-12-01").cast("date"), -12))).join(fresh.select("o_custkey").distinct(), "o_custkey", "left_semi")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(periode" in text and "1998-12-01" in text


def operators(df):
    """How often the plan before adaptive changes deals rows by a hash and sorts them."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning"), plan.count("Sort [")


def test_panel_rows_move_and_are_sorted_once_after_the_join(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # line items, orders and customers move once; the summed orders once more, for months, attributes and windows
        assert operators(build_panel(spark, SF)) == (4, 3)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_outcome_reads_the_snapshot_for_customers_at_risk_only(spark, scratch, whole):
    store = PanelStore(spark, f"{scratch}/store")
    store.append(SF)
    found = store.read()
    assert "Union" in found._jdf.queryExecution().optimizedPlan().toString()
    assert rows(found) == whole and found.where("time_til_outcome is null").count() > 0
