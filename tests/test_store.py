"""Merged curve states, quarantined lines, typed exports, published runs."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigie.operators import curves, metrics
from vigie.sources import exports, io, quarantine
from vigie.sources.publish import Damaged, Publication


# ---- curve states

@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(4)
    rows = [(f"20{y}-{m:02d}-{d:02d}", rng.choice([None, float("nan"), *[i / 20 for i in range(21)]]), rng.choice([True, False, None]))
            for y in (18, 19) for m in range(1, 13) for d in range(1, 25)]
    rows.append((None, 0.5, True))
    return spark.createDataFrame(rows, "day string, score double, outcome boolean").withColumn("periode", F.to_date("day")).cache()


def curve(df):
    return [tuple(r) for r in df.orderBy(F.col("threshold").asc_nulls_last()).collect()]


def test_curve_of_merged_states_equals_the_curve_of_the_rows(spark, scored, scratch):
    store, month = curves.StateStore(spark, f"{scratch}/states"), F.month("periode")
    parts = [curves.month_states(scored.where(month % 3 == k)) for k in range(3)]
    assert sorted(curves.merge_states(*parts).collect()) == sorted(curves.merge_states(parts[2], curves.merge_states(*parts[:2])).collect())
    store.put(curves.merge_states(*parts))
    for lo, hi in ((None, None), ("2018-05-01", "2019-03-01"), ("2019-12-01", None), ("2030-01-01", None)):
        table = curves.curve_table(store.read(), lo, hi)
        rows = scored.where("periode is not null")
        rows = rows.where(F.col("periode") >= lo) if lo else rows
        rows = rows.where(F.col("periode") < hi) if hi else rows
        assert curve(metrics.curve_of(table)) == curve(metrics.pr_curve(rows))
        assert metrics.evaluate_table(table, 2).first() == metrics.evaluate(rows, 2).first()


def test_a_month_is_replaced_and_only_its_files_are_read(spark, scored, scratch):
    store = curves.StateStore(spark, f"{scratch}/states")
    store.put(curves.month_states(scored))
    june = F.col("periode").between("2018-06-01", "2018-06-30")
    before = set(os.listdir(f"{store.path}/periode=2018-07-01"))
    store.put(curves.month_states(scored.where(june & (F.col("score") > 0.5))))
    assert set(os.listdir(f"{store.path}/periode=2018-07-01")) == before
    want = scored.where(~june | (F.col("score") > 0.5))
    assert curve(metrics.curve_of(curves.curve_table(store.read()))) == curve(metrics.pr_curve(want.where("periode is not null")))
    plan = curves.curve_table(store.read(), "2018-06-01", "2018-07-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(periode" in plan
    few = curves.month_states(scored, digits=1)
    assert few.where("threshold <> round(threshold, 1)").isEmpty() and few.groupBy("periode").count().agg(F.max("count")).first()[0] <= 11


# ---- broken lines

def lines(path, *text):
    with open(path, "w") as fh:
        fh.write("\n".join(text) + "\n")
    return path


def test_extract_with_broken_lines(spark, scratch):
    path = lines(f"{scratch}/x.csv", "siret,siren,periode,effectif,outcome", "00012,1,2020-01-01,12.5,True", "2,1,2020-13-01,12,false",
                 "3,1,2020-01-01,many,maybe", "4,1,2020-01-01", "5,1,2020-01-01,1,true,more", ",1,2020-01-01,1,true",
                 "123456789012345,1,2020-01-01,1,true", "12a,1,2020-01-01,1,true", "6,,,,")
    found = quarantine.read_extract_checked(spark, path)
    assert [tuple(map(str, r)) for r in found.good.collect()] == [("00012", "1", "2020-01-01", "12.5", "True"), ("6", "None", "None", "None", "None")]
    got = {r.line: r.reasons for r in found.broken.collect()}
    assert got == {"2,1,2020-13-01,12,false": ["periode is not a date"], "3,1,2020-01-01,many,maybe": ["effectif is not a double", "outcome is not a boolean"],
                   "4,1,2020-01-01": ["wrong number of fields"], "5,1,2020-01-01,1,true,more": ["wrong number of fields"],
                   ",1,2020-01-01,1,true": ["siret is missing"], "123456789012345,1,2020-01-01,1,true": ["siret is longer than 14"],
                   "12a,1,2020-01-01,1,true": ["siret is not a number"]}
    assert (found.n_good, found.n_broken) == (2, 7) and found.broken.first().file.endswith("x.csv")
    quarantine.write_quarantine(found.broken, f"{scratch}/q")
    quarantine.write_quarantine(found.broken, f"{scratch}/q")
    assert spark.read.json(f"{scratch}/q").count() == 14


def test_lists_and_predictions_with_broken_lines(spark, scratch):
    path = lines(f"{scratch}/s.csv", "12345678901234,extra", " 123 ", "", "12x", "123456789012345")
    found = quarantine.read_siret_list_checked(spark, path)
    assert [r.siret for r in found.good.collect()] == ["12345678901234", "00000000000123"]
    assert sorted(r.reasons[0] for r in found.broken.collect()) == ["siret is longer than 14", "siret is not a number"]
    path = lines(f"{scratch}/p.csv", "siren,siret,predicted_probability", "1,11,0.5", "1,12,1.5", "1,13,high", "1,14,", "1,15")
    found = quarantine.read_predictions_checked(spark, path)
    assert [(r.siret, r.predicted_probability) for r in found.good.collect()] == [("11", 0.5), ("14", None)]
    assert {r.line.split(",")[1]: r.reasons for r in found.broken.collect()} == {
        "12": ["predicted_probability is not in [0, 1]"], "13": ["predicted_probability is not a double"], "15": ["wrong number of fields"]}
    empty = lines(f"{scratch}/e.csv", "siret,siren")
    found = quarantine.read_extract_checked(spark, empty)
    assert (found.n_good, found.n_broken, found.good.count(), found.broken.count()) == (0, 0, 0, 0)


# ---- typed exports

def test_wrappers_at_any_depth(spark, scratch):
    records = [
        {"_id": {"$oid": "5f"}, "value": {"siret": "12", "periode": {"$date": "2020-01-31T23:30:00Z"}, "n": {"$numberLong": "9007199254740993"},
         "x": {"$numberDouble": "NaN"}, "deep": [{"at": {"$date": {"$numberLong": "1580515200000"}}, "v": {"$numberInt": "3"}}], "plain": 1.5,
         "both": {"$numberInt": "4"}, "kind": {"$numberLong": "1"}, "tags": ["a"]}},
        {"_id": {"$oid": "60"}, "value": {"siret": "13", "periode": None, "n": None, "x": {"$numberDouble": "-Infinity"}, "deep": [], "plain": 2,
         "both": 5, "kind": {"$numberDouble": "2.5"}, "tags": []}},
    ]
    path = lines(f"{scratch}/e.json", *map(json.dumps, records))
    df = exports.read_export(spark, path, kinds={"both": "int"})
    kinds = dict(df.dtypes)
    assert kinds["n"] == "bigint" and kinds["periode"] == "date" and kinds["both"] == "int" and kinds["kind"] == "double"
    assert kinds["deep"] == "array<struct<at:timestamp,v:int>>"
    a, b = df.orderBy("siret").collect()
    assert a.siret == "00000000000012" and str(a.periode) == "2020-01-31" and a.n == 2 ** 53 + 1 and a.x is None
    assert a.deep[0].v == 3 and df.select(F.unix_timestamp(F.col("deep")[0]["at"])).where("deep is not null").first()[0] in (1580515200, None)
    assert (a.both, b.both, a.kind, b.kind, b.x, b.n, b.periode, b.deep) == (4, 5, 1.0, 2.5, float("-inf"), None, None, [])


def test_a_field_without_wrappers_is_left_alone(spark, scratch):
    path = lines(f"{scratch}/e.json", json.dumps({"s": '{"$odd": 1}', "o": {"a": 1, "$date": "x"}, "d": "2020-01-01"}))
    r = exports.read_export(spark, path).first()
    assert r.s == '{"$odd": 1}' and r.o["$date"] == "x" and r.d == "2020-01-01"


# ---- published runs

def rows(spark, *sirets):
    return spark.createDataFrame([("1", s, 0.5) for s in sirets], "siren string, siret string, predicted_probability double")


def put(p, run, df, finish=True):
    path = p.stage(run)
    io.write_predictions(df, f"{path}/predictions")
    if finish:
        p.commit(run, path)
    return path


def seen(spark, p):
    return {run: sorted(r.siret for r in io.read_predictions(spark, f"{path}/predictions").collect()) for run, path in p.runs().items()}


def test_only_finished_runs_are_seen_and_a_repetition_replaces(spark, scratch):
    p = Publication(spark, f"{scratch}/out")
    assert p.runs() == {}
    put(p, "a", rows(spark, "1", "2"))
    put(p, "b", rows(spark, "3"), finish=False)   # killed before its manifest
    assert seen(spark, p) == {"a": ["1", "2"]}
    with pytest.raises(FileNotFoundError):
        p.path("b")
    put(p, "b", rows(spark, "4"))
    first = p.path("a")
    put(p, "a", rows(spark, "5"), finish=False)   # a repetition that was killed changes nothing
    assert p.path("a") == first
    put(p, "a", rows(spark, "6"))
    assert seen(spark, p) == {"a": ["6"], "b": ["4"]} and p.verify("a") >= 1
    os.makedirs(f"{scratch}/out/none")
    with pytest.raises(ValueError, match="no file"):
        p.commit("c", f"{scratch}/out/none")


def test_a_manifest_that_lacks_rows_is_not_complete(spark, scratch):
    p = Publication(spark, f"{scratch}/out")
    path = p.stage("a")
    rows(spark, *map(str, range(40))).repartition(4).write.json(f"{path}/x")
    p.commit("a", path)
    assert p.verify("a") >= 4
    (name,) = os.listdir(f"{scratch}/out/manifests")
    folder = f"{scratch}/out/manifests/{name}"
    (part,) = [f for f in os.listdir(folder) if f.endswith(".json")]
    kept = open(f"{folder}/{part}").read().splitlines()[:-1]
    for f in os.listdir(folder):
        os.remove(f"{folder}/{f}")
    lines(f"{folder}/part.json", *kept)
    assert p.runs() == {}


def test_damaged_files_are_named(spark, scratch):
    p = Publication(spark, f"{scratch}/out")
    path = put(p, "a", rows(spark, "1", "2"))
    (part,) = [f for f in os.listdir(f"{path}/predictions") if f.startswith("part")][:1]
    with open(f"{path}/predictions/{part}", "a") as fh:
        fh.write("1,9,0.5\n")
    os.remove(f"{path}/predictions/.{part}.crc")  # the local file system's own
    with pytest.raises(Damaged, match=part):
        p.verify("a")
