"""A model run (P14) with run options.

train: fetch (quota sample) -> fill -> drop incomplete -> pipeline -> fit -> evaluate
test:  fetch -> drop firms seen in training -> fill -> drop incomplete
       -> drop strong signals -> pipeline -> score -> evaluate
predict: fetch -> fill -> drop incomplete -> pipeline -> score [-> explain] -> export

Jobs run only for the fit (encoder statistics + the optimiser over a cached encoded
set), the two evaluations and the writes.  Emptiness, class balance and unseen levels
are counted in the passes that write the sets.
"""

from __future__ import annotations

import logging
from dataclasses import replace
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigie.operators import clean
from vigie.operators.checks import Checks, require_rows
from vigie.operators.dataset import fetch, flatten, match, month_window_end, raise_if_empty
from vigie.operators.explain import explain
from vigie.operators.metrics import evaluate_dict
from vigie.operators.model import LinearModel, fit_logistic
from vigie.operators.split import exclude_train_firms
from vigie.plans.pipeline import run_pipeline
from vigie.plans.specs import ModelSpec
from vigie.schema import IGNORE_NA
from vigie.sources import io
from vigie.sources.publish import Publication

log = logging.getLogger(__name__)

# --- fixed values: run options and the data-set attribute each one sets -------
ARGS_TO_ATTRS = {
    "train_spl_size": ("train", "sample_size"),
    "test_spl_size": ("test", "sample_size"),
    "predict_spl_size": ("predict", "sample_size"),
    "train_proportion_positive_class": ("train", "proportion_positive_class"),
    "train_from": ("train", "date_min"),
    "train_to": ("train", "date_max"),
    "test_from": ("test", "date_min"),
    "test_to": ("test", "date_max"),
    "predict_on": ("predict", "date_min"),
}
# --- end of fixed values -------------------------------------------------------


def apply_overrides(spec: ModelSpec, overrides: dict[str, Any] | None,
                    predict_sirets: DataFrame | None = None) -> ModelSpec:
    """Set the given options (a value of ``None`` leaves the attribute
    unchanged, as in the reference, unless passed as ``"all"`` for a size,
    which means no sample cap); the prediction month sets both bounds."""
    sets = {"train": {}, "test": {}, "predict": {}}
    for arg, value in (overrides or {}).items():
        if arg not in ARGS_TO_ATTRS:
            raise ValueError(f"no such run option: {arg}")
        if value is None:
            continue
        ds, attr = ARGS_TO_ATTRS[arg]
        sets[ds][attr] = None if value == "all" else value
    if (overrides or {}).get("predict_on"):
        sets["predict"]["date_max"] = month_window_end(overrides["predict_on"])
    if predict_sirets is not None:
        sets["predict"]["sirets"] = predict_sirets
    return replace(spec,
                   train=replace(spec.train, **sets["train"]),
                   test=replace(spec.test, **sets["test"]),
                   predict=replace(spec.predict, **sets["predict"]))


def make_stats(spec: ModelSpec) -> dict[str, Any]:
    ds = {"train": spec.train, "test": spec.test, "predict": spec.predict}
    return {arg: getattr(ds[d], a) for arg, (d, a) in ARGS_TO_ATTRS.items()}


def _clean(df: DataFrame) -> DataFrame:
    return clean.remove_na(clean.replace_missing_data(df), IGNORE_NA)


def _fetched(panel: DataFrame, dataset, checks: Checks | None) -> DataFrame:
    """The data set; an empty one is an error, found while it is written (``checks``) or by a test of the filters alone."""
    if checks is not None:
        return checks.on(fetch(panel, dataset), "fetched")
    raise_if_empty(match(flatten(panel), dataset))
    return fetch(panel, dataset)


def prepare_train(panel: DataFrame, spec: ModelSpec, checks: Checks | None = None) -> DataFrame:
    return run_pipeline(_clean(_fetched(panel, spec.train, checks)), spec.pipeline)


def prepare_test(panel: DataFrame, spec: ModelSpec, train: DataFrame, checks: Checks | None = None) -> DataFrame:
    df = exclude_train_firms(_fetched(panel, spec.test, checks), train)
    df = clean.remove_strong_signals(_clean(df))
    return run_pipeline(df, spec.pipeline)


def prepare_predict(panel: DataFrame, spec: ModelSpec, checks: Checks | None = None) -> DataFrame:
    return run_pipeline(_clean(_fetched(panel, spec.predict, checks)), spec.pipeline)


def run_model(spark: SparkSession, panel: DataFrame, spec: ModelSpec,
              overrides: dict[str, Any] | None = None, out_dir: str | None = None,
              with_explain: bool = False, save_model: bool = False,
              predict_sirets: DataFrame | None = None,
              exclude_fetched_train_firms: bool = False,
              predict_siretlist_path: str | None = None,
              unknown: str = "error", run_id: str | None = None) -> tuple[DataFrame, dict[str, Any], LinearModel]:
    """Returns (predictions, statistics, fitted model); publishes
    ``predictions/``, ``stats/`` (and ``model/``) under ``out_dir`` if given
    (``publish.Publication``; ``run_id`` names the run, so that a repetition
    replaces it; default: specification and time).

    Test rows of firms seen in training are dropped; by default "seen" means
    present in the cleaned training set (as the reference does), with
    ``exclude_fetched_train_firms`` every fetched training firm counts.
    ``predict_siretlist_path`` restricts the prediction set to the sirets of a
    one-column file (S5; an empty file raises ``EmptyFileError``).
    A categorical level absent from training is an error (``unknown="error"``,
    as the reference's encoder) or encodes as all zeros (``unknown="ignore"``).
    """
    if unknown not in ("error", "ignore"):
        raise ValueError("unknown must be 'error' or 'ignore'")
    if predict_siretlist_path is not None:
        predict_sirets = io.read_siret_list(spark, predict_siretlist_path)
    spec = apply_overrides(spec, overrides, predict_sirets)
    stats = make_stats(spec)
    stats["run_on"] = datetime.now(timezone.utc).strftime("%Y%m%d-%H%M%S")

    # every set is written once, with what the model reads; its checks are counts of that pass
    checks = Checks()
    train = checks.on(prepare_train(panel, spec, checks), "train", positive=F.count(F.when(F.col("outcome").cast("boolean"), F.lit(1))))
    train, noted = checks.written(train, "train")
    require_rows(noted["fetched"]["rows"], "training set")
    stats["train_balance"] = {"rows": noted["train"]["rows"], "positive": noted["train"]["positive"]}
    model = fit_logistic(train, spec.feature_groups, spec.onehot)
    stats["train"] = _metrics(model.score(train, "score"), spec.eval_beta)

    checks = Checks()
    seen = fetch(panel, spec.train) if exclude_fetched_train_firms else train
    test_set = prepare_test(panel, spec, seen, checks).select(*dict.fromkeys(["outcome", *spec.features]))
    test_set, noted = checks.written(checks.on(test_set, "set", **model.unseen_levels(test_set.columns)), "test")
    require_rows(noted["fetched"]["rows"], "test set")
    if unknown == "error":
        model.refuse_unseen(noted["set"])
    stats["test"] = _metrics(model.score(test_set, "score"), spec.eval_beta)

    checks = Checks()
    predict_set = prepare_predict(panel, spec, checks)
    predict = model.score(checks.on(predict_set, "set", **model.unseen_levels(predict_set.columns)))
    columns = ["siren", "siret", "predicted_probability"]
    if with_explain:
        predict = explain(predict, model)
        columns += ["expl_selection", "macro_expl", "micro_expl", "macro_radar"]
    predictions, noted = checks.written(predict.select(*columns), "predictions")
    require_rows(noted["fetched"]["rows"], "prediction set")
    if unknown == "error":
        model.refuse_unseen(noted["set"])
    if out_dir:
        # staged files first; the manifest makes them a run that readers see
        publication, run = Publication(spark, out_dir), run_id or f"{spec.name}_{stats['run_on']}"
        base = publication.stage(run)
        io.write_predictions(predictions, f"{base}/predictions")
        io.write_stats(spark, stats, f"{base}/stats")
        if save_model:
            model.save(spark, f"{base}/model")
        publication.commit(run, base)
        stats["run"], stats["output"] = run, base
    return predictions, stats, model


def _metrics(scored: DataFrame, beta: float) -> dict[str, Any]:
    m = evaluate_dict(scored.withColumn("outcome", F.col("outcome").cast("boolean")), beta)
    return {"balanced_accuracy": m["balanced_accuracy"], "Fbeta": m[f"f{beta}"], "aucpr": m["aucpr"],
            "confusion_matrix": m["confusion_matrix"]}
