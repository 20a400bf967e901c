"""End-to-end model runs on the smallest tables: both specifications, files
written and read back, leakage control between train and test."""

import os

import pytest
from pyspark.sql import functions as F

from vigie.operators.model import LinearModel
from vigie.plans.run import prepare_test, prepare_train, run_model
from vigie.plans.specs import default_model, small_model
from vigie.sources import io
from vigie.sources.panel import load_panel

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables absent")
ALL = {"train_spl_size": "all", "test_spl_size": "all", "predict_spl_size": "all"}


@pytest.fixture(scope="module")
def panel(spark):
    return load_panel(spark, SF)


def test_default_model_run_writes_everything(spark, panel, scratch):
    preds, stats, model = run_model(spark, panel, default_model(), ALL, out_dir=scratch,
                                    with_explain=True, save_model=True)
    rows = preds.collect()
    assert rows and all(0.0 < r.predicted_probability < 1.0 for r in rows)
    assert set(preds.columns) == {"siren", "siret", "predicted_probability", "expl_selection",
                                  "macro_expl", "micro_expl", "macro_radar"}
    base = stats["output"]
    back = io.read_stats(spark, f"{base}/stats")
    assert back["train_from"] == default_model().train.date_min and "balanced_accuracy" in back["train"]
    csv = spark.read.csv(f"{base}/predictions", header=True)
    assert csv.count() == len(rows) and csv.first().macro_expl.startswith("{")
    assert LinearModel.load(spark, f"{base}/model") == model
    assert set(model.levels["paydex_group"]) <= {"(-inf, 0.0]", "(0.0, 15.0]", "(15.0, 30.0]", "(30.0, 60.0]",
                                                 "(60.0, 90.0]", "(90.0, inf]"}


def test_small_model_run(spark, panel):
    preds, stats, model = run_model(spark, panel, small_model(), ALL)
    assert preds.count() > 0 and model.levels == {}
    assert set(model.encoded_names()) == {"apart_heures_consommees_cumulees", "apart_heures_consommees",
                                          "ratio_dette", "avg_delta_dette_par_effectif"}
    assert 0.0 <= stats["test"]["balanced_accuracy"] <= 1.0


def test_no_firm_in_both_train_and_test(spark, panel):
    spec = default_model()
    from vigie.plans.run import apply_overrides
    spec = apply_overrides(spec, ALL)
    train = prepare_train(panel, spec)
    test = prepare_test(panel, spec, train)
    overlap = test.select("siren").distinct().join(train.select("siren").distinct(), "siren")
    assert overlap.count() == 0
    assert test.filter(F.coalesce(F.col("time_til_outcome") <= 0, F.lit(False))).count() == 0


def test_exclude_fetched_train_firms_is_stricter(spark, panel):
    _, s1, _ = run_model(spark, panel, small_model(), ALL)
    _, s2, _ = run_model(spark, panel, small_model(), ALL, exclude_fetched_train_firms=True)
    n1 = sum(s1["test"]["confusion_matrix"].values())
    n2 = sum(s2["test"]["confusion_matrix"].values())
    assert n2 <= n1


def test_predict_siret_list_file(spark, panel, scratch):
    full, _, _ = run_model(spark, panel, small_model(), ALL)
    keep = sorted(r.siret for r in full.collect())[:3]
    path = f"{scratch}/sirets.csv"
    with open(path, "w") as fh:
        fh.write("\n".join(str(int(s)) for s in keep) + "\n")   # leading zeros lost, as in a numeric export
    some, _, _ = run_model(spark, panel, small_model(), ALL, predict_siretlist_path=path)
    assert sorted(r.siret for r in some.collect()) == keep


def test_command_line(spark, scratch):
    from vigie.__main__ import main

    stats = main(["--tables", SF, "--model_name", "small", "--out_dir", scratch, "--train_spl_size", "300",
                  "--predict_on", "2000-07-01", "--save_model"])
    assert stats["train_spl_size"] == 300 and stats["predict_on"] == "2000-07-01"
    assert {"predictions", "stats", "model"} <= set(os.listdir(stats["output"]))
