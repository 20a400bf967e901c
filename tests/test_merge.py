"""Model merge by priority and alert flags."""

import pytest

from vigie.functions.features import FLAG_NONE, FLAG_ORANGE, FLAG_RED
from vigie.operators.merge import flag_scores, merge_models, score_list

S = "siret string, predicted_probability double"


def test_priority_three_models(spark):
    a = spark.createDataFrame([("1", 0.1), ("2", None)], S)
    b = spark.createDataFrame([("1", 0.2), ("2", 0.3), ("3", 0.4)], S)
    c = spark.createDataFrame([("3", 0.5), ("4", 0.6), ("5", None)], S)
    got = {r.siret: r.predicted_probability for r in merge_models([a, b, c]).collect()}
    assert got == {"1": 0.1, "2": 0.3, "3": 0.4, "4": 0.6, "5": None}


def test_single_and_empty(spark):
    a = spark.createDataFrame([("1", 0.1)], S)
    assert merge_models([a]) is a
    with pytest.raises(ValueError):
        merge_models([])


def test_flags(spark):
    df = spark.createDataFrame([("1", 0.8), ("2", 0.75), ("3", 0.31), ("4", 0.3), ("5", None)], S)
    got = [r.alert for r in flag_scores(df, 0.75, 0.3).orderBy("siret").collect()]
    assert got == [FLAG_RED, FLAG_ORANGE, FLAG_ORANGE, FLAG_NONE, FLAG_NONE]
    with pytest.raises(ValueError):
        flag_scores(df, 0.3, 0.75)
    with pytest.raises(ValueError):
        flag_scores(df, 1.2, 0.3)


def test_score_list_records(spark):
    df = spark.createDataFrame([("1", 0.8)], S)
    row = score_list(df, "2020-02-01", "2102", "algo", 0.75, 0.3).first()
    assert row.asDict() == {"siret": "1", "periode": "2020-02-01", "score": 0.8, "batch": "2102",
                            "algo": "algo", "alert": FLAG_RED}


def test_produce_list_from_files(spark, scratch):
    from vigie.plans.lists import produce_list
    from vigie.sources import io

    a = spark.createDataFrame([("000000001", "00000000100000", 0.9), ("000000002", "00000000200000", None)],
                              "siren string, siret string, predicted_probability double")
    b = spark.createDataFrame([("000000002", "00000000200000", 0.5), ("000000003", "00000000300000", 0.1)],
                              "siren string, siret string, predicted_probability double")
    io.write_predictions(a, f"{scratch}/a")
    io.write_predictions(b, f"{scratch}/b")
    records, counts = produce_list(spark, [f"{scratch}/a", f"{scratch}/b"], 0.75, 0.3, "2020-02-01", "2102",
                                   "merged", out_path=f"{scratch}/list")
    got = {r.siret: (r.score, r.alert) for r in io.read_scores(spark, f"{scratch}/list").collect()}
    assert got == {"00000000100000": (0.9, FLAG_RED), "00000000200000": (0.5, FLAG_ORANGE),
                   "00000000300000": (0.1, FLAG_NONE)}
    assert (counts["n_total"], counts["n_red"], counts["n_orange"]) == (3, 1, 1)
