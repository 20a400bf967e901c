"""Sources and sinks: CSV extracts, siret lists, predictions, stats, scores."""

import os

import pytest
from pyspark.sql import functions as F

from vigie.sources import io


def test_extract_round_trip_keeps_zeros(spark, scratch):
    df = spark.createDataFrame([("00012345678901", "000123456", 1.5)], "siret string, siren string, ratio_dette double")
    io.write_extract_csv(df, f"{scratch}/extract")
    back = io.read_extract_csv(spark, f"{scratch}/extract").first()
    assert back.siret == "00012345678901" and back.siren == "000123456" and back.ratio_dette == 1.5


def test_siret_list(spark, scratch):
    path = f"{scratch}/sirets.csv"
    with open(path, "w") as fh:
        fh.write("12345678901234,extra\n123,more,cols\n")
    got = [r.siret for r in io.read_siret_list(spark, path).collect()]
    assert got == ["12345678901234", "00000000000123"]
    empty = f"{scratch}/empty.csv"
    open(empty, "w").close()
    with pytest.raises(io.EmptyFileError):
        io.read_siret_list(spark, empty)


def test_predictions_with_maps_as_csv(spark, scratch):
    df = spark.createDataFrame([("000000001", "00000000100000", 0.4)],
                               "siren string, siret string, predicted_probability double")
    df = df.withColumn("macro_expl", F.create_map(F.lit("g"), F.lit(0.5)))
    io.write_predictions(df, f"{scratch}/pred")
    back = spark.read.csv(f"{scratch}/pred", header=True).first()
    assert back.macro_expl == '{"g":0.5}'
    assert io.read_predictions(spark, f"{scratch}/pred").first().siren == "000000001"


def test_stats_round_trip(spark, scratch):
    stats = {"train_from": "2016-01-01", "train": {"Fbeta": 0.5}}
    io.write_stats(spark, stats, f"{scratch}/stats")
    assert io.read_stats(spark, f"{scratch}/stats") == stats


def test_export_scores(spark, scratch):
    df = spark.createDataFrame([("1", "2020-02-01", 0.8, "b", "a", "Alerte seuil F1")],
                               "siret string, periode string, score double, batch string, algo string, alert string")
    io.export_scores(df, f"{scratch}/scores")
    assert io.read_scores(spark, f"{scratch}/scores").collect() == df.collect()
    assert any(f.endswith(".json") for f in os.listdir(f"{scratch}/scores"))
