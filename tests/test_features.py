"""Feature recipes and pipelines on the reference's literal frames."""

import math

import pytest
from pyspark.sql import functions as F

from vigie.functions.features import PAYDEX_LABELS, paydex_group
from vigie.operators.clean import remove_administrations
from vigie.plans.pipeline import (DEFAULT_PIPELINE, SMALL_PIPELINE, MissingDataError, Step, add_debt_per_head_delta,
                                  add_paydex_group, add_paydex_yoy, check_feature, run_pipeline)

ACOSS = [(10, 1000, 1000, 0, 0), (10, 1200, 0, 300, 0), (10000, 0, 1200, 1200, 1200)]
ACOSS_SCHEMA = ("effectif long, montant_part_patronale long, montant_part_patronale_past_3 long, "
                "montant_part_ouvriere long, montant_part_ouvriere_past_3 long")


def test_debt_per_head_delta(spark):
    df = spark.createDataFrame(ACOSS, ACOSS_SCHEMA)
    out = add_debt_per_head_delta(df)
    assert len(out.columns) == len(df.columns) + 1
    vals = [r[0] for r in out.select("avg_delta_dette_par_effectif").collect()]
    assert vals == pytest.approx([0.0, 50.0, -0.04])


def test_debt_per_head_zero_or_missing_staff(spark):
    df = spark.createDataFrame([(0.0, 10.0, 0.0, 5.0, 0.0), (None, 10.0, 0.0, 5.0, 0.0), (10.0, None, 0.0, 5.0, 0.0)],
                               ACOSS_SCHEMA.replace("long", "double"))
    vals = [r[0] for r in add_debt_per_head_delta(df).select("avg_delta_dette_par_effectif").collect()]
    assert vals == [0.0, 0.0, 0.0]


def test_paydex_yoy_and_groups(spark):
    df = spark.createDataFrame([(10, 91), (30, 30), (10000, 15)], "paydex_nb_jours long, paydex_nb_jours_past_12 long")
    out = add_paydex_group(add_paydex_yoy(df)).collect()
    assert [r.paydex_yoy for r in out] == [-81, 0, 9985]
    assert [r.paydex_group for r in out] == ["(0.0, 15.0]", "(15.0, 30.0]", "(90.0, inf]"]


def test_paydex_group_edges(spark):
    vals = [0.0, 15.0, 30.0, 60.0, 90.0, -5.0, 90.5, None, float("-inf"), float("inf")]
    df = spark.createDataFrame([(v,) for v in vals], "paydex_nb_jours double")
    got = [r[0] for r in df.select(paydex_group()).collect()]
    assert got == ["(-inf, 0.0]", "(0.0, 15.0]", "(15.0, 30.0]", "(30.0, 60.0]", "(60.0, 90.0]",
                   "(-inf, 0.0]", "(90.0, inf]", None, None, "(90.0, inf]"]
    assert len(PAYDEX_LABELS) == 6


def test_remove_administrations_keeps_null(spark):
    df = spark.createDataFrame([("A",), ("B",), ("E",), ("O",), ("P",), (None,)], "code_naf string")
    assert [r[0] for r in remove_administrations(df).collect()] == ["A", "B", "E", None]


def _full(spark):
    rows = []
    naf = ["A", "B", "E", "O", "P"]
    paydex = [(10, 91), (30, 30), (10000, 15)]
    for i in range(5):
        a = ACOSS[i] if i < 3 else (None,) * 5
        p = paydex[i] if i < 3 else (None, None)
        rows.append((naf[i],) + tuple(None if v is None else float(v) for v in a) + tuple(
            None if v is None else float(v) for v in p))
    return spark.createDataFrame(rows, "code_naf string, " + ACOSS_SCHEMA.replace("long", "double")
                                 + ", paydex_nb_jours double, paydex_nb_jours_past_12 double")


def test_default_pipeline(spark):
    out = run_pipeline(_full(spark), DEFAULT_PIPELINE)
    rows = out.collect()
    assert (len(rows), len(out.columns)) == (3, 11)
    assert [r.avg_delta_dette_par_effectif for r in rows] == pytest.approx([0, 50, -0.04])
    assert [r.paydex_yoy for r in rows] == [-81, 0, 9985]
    assert [r.paydex_group for r in rows] == ["(0.0, 15.0]", "(15.0, 30.0]", "(90.0, inf]"]


def test_small_pipeline(spark):
    out = run_pipeline(_full(spark), SMALL_PIPELINE)
    assert out.count() == 3 and "paydex_group" not in out.columns


def test_pipeline_missing_input(spark):
    with pytest.raises(MissingDataError):
        run_pipeline(_full(spark).drop("code_naf"), DEFAULT_PIPELINE)


def test_pipeline_inputs_may_come_from_earlier_steps(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    steps = [Step("make y", lambda d: d.withColumn("y", F.col("x") * 2), ("x",), ("y",)),
             Step("make z", lambda d: d.withColumn("z", F.col("y") + 1), ("y",), ("z",))]
    assert run_pipeline(df, steps).first().z == 3.0


def test_pipeline_contract():
    for pipe in (DEFAULT_PIPELINE, SMALL_PIPELINE):
        for step in pipe:
            assert isinstance(step.name, str) and callable(step.function)
            assert isinstance(step.inputs, tuple)
            assert step.outputs is None or isinstance(step.outputs, tuple)
    assert check_feature("paydex_group", [], DEFAULT_PIPELINE)
    assert not check_feature("nope", ["a"], DEFAULT_PIPELINE)
    assert math.isfinite(1.0)
