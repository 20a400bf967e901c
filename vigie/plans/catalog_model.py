"""Registered queries for encoding, explanation, fit and the full run.

Explanations use a fixed model (literal scaler and weights, ``params``) so the
DuckDB oracle can recompute every contribution; the real fit and the model run
have no SQL equivalent (iterative optimiser) and get a rows-only check.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigie.functions.features import PAYDEX_LABELS
from vigie.operators.explain import COLLAPSED_GROUP, explain
from vigie.operators.model import (OFFSET, LinearModel, cross_validate, fit_folds, fit_logistic, level_aggregates, level_name,
                                   scaler_aggregates)
from vigie.operators.clean import remove_siren
from vigie.operators.dataset import fetch, month_window_end, top_n
from vigie.operators.merge import score_list
from vigie.operators.split import fold_sets, siren_folds
from vigie.plans import params as P
from vigie.plans.catalog import (ALL_FROM, ALL_TO, WHOLE, DEFAULT_PIPELINE, PAYDEX_GROUP_SQL, DEBT_DELTA_SQL, TEST, TRAIN, _prepared,
                                 finalize, panel, register, scan_sql)
from vigie.plans.catalog_scores import ALGO, BATCH, FLAG_SQL, MODELS_CTES, MONTH_A, _model_scores
from vigie.plans.oracle_panel import with_panel
from vigie.plans.pipeline import SMALL_PIPELINE
from vigie.plans.specs import (DEFAULT_FEATURE_GROUPS, DEFAULT_ONEHOT, DEFAULT_VARIABLES, SMALL_FEATURE_GROUPS, SMALL_VARIABLES,
                               default_model)
from vigie.session import checkpoint_dir, written_table
from vigie.schema import PANEL_COLUMNS
from vigie.sources import io
from vigie.sources.incremental import PanelStore

NUMERIC = [f for fs in DEFAULT_FEATURE_GROUPS.values() for f in fs if f not in DEFAULT_ONEHOT]


def fixed_explain_model() -> LinearModel:
    coefs = {level_name("paydex_group", lv): b for lv, b in zip(PAYDEX_LABELS, P.EXPLAIN_LEVEL_COEFS)}
    coefs.update(P.EXPLAIN_COEFS)
    return LinearModel(groups={g: list(fs) for g, fs in DEFAULT_FEATURE_GROUPS.items()},
                       levels={"paydex_group": list(PAYDEX_LABELS)},
                       scaler=dict(P.EXPLAIN_SCALER), coefs=coefs, intercept=P.EXPLAIN_INTERCEPT)


def _explained(spark, sf) -> DataFrame:
    data = _prepared(spark, sf, WHOLE.with_(fields=DEFAULT_VARIABLES), DEFAULT_PIPELINE)
    return explain(data, fixed_explain_model(), P.EXPLAIN_THRESH)


# ---- SQL side: prepared test set and the contribution of every encoded column

def _prepared_sql(date_min: str = ALL_FROM, date_max: str = ALL_TO) -> str:
    fill = {c: "0.0" for c in DEFAULT_VARIABLES
            if c.startswith(("montant_part", "cotisation", "ratio_dette", "apart_heures")) or c == "effectif"}
    cols = []
    for c in DEFAULT_VARIABLES:
        cols.append(f"coalesce({c}, {fill[c]}) AS {c}" if c in fill else c)
    nn = [c for c in DEFAULT_VARIABLES if c not in fill and c not in ("time_til_outcome", "code_naf")]
    return ("SELECT *, paydex_nb_jours - paydex_nb_jours_past_12 AS paydex_yoy, "
            f"{PAYDEX_GROUP_SQL} AS paydex_group, {DEBT_DELTA_SQL} AS avg_delta_dette_par_effectif FROM ("
            f"SELECT {', '.join(cols)} FROM ({scan_sql(date_min, date_max)})) "
            f"WHERE {' AND '.join(f'{c} IS NOT NULL' for c in nn)} "
            "AND NOT coalesce(code_naf IN ('O', 'P'), false)")


def _contrib_sql(model: LinearModel):
    """[(group, name, contribution SQL, |w| * |x| SQL)] in encoded order."""
    out = []
    for g, fs in model.groups.items():
        for f in fs:
            for lv in model.levels.get(f, []):
                n = level_name(f, lv)
                x = f"(CASE WHEN {f} = '{lv}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)"
                out.append((g, n, x))
    for g, fs in model.groups.items():
        for f in fs:
            if f in model.levels:
                continue
            m, s = model.scaler[f]
            out.append((g, f, f"(({f} - ({m!r})::DOUBLE) / ({s!r})::DOUBLE)"))
    return [(g, n, f"(({model.coefs[n]!r})::DOUBLE * {x})", f"(({abs(model.coefs[n])!r})::DOUBLE * abs({x}))")
            for g, n, x in out]


def _explain_ctes() -> tuple[str, ...]:
    model = fixed_explain_model()
    enc = _contrib_sql(model)
    b0 = model.intercept
    contr = ", ".join(f"{c} AS c{i}" for i, (_, _, c, _) in enumerate(enc))
    norm = " + ".join([f"({abs(b0)!r})::DOUBLE"] + [a for _, _, _, a in enc])
    base = f"ex AS (SELECT siret, periode, {contr}, {norm} AS nrm FROM prep)"
    # selection entries: offset-free, collapsed group as one entry
    sel = []
    members = [f"c{i}" for i, (g, _, _, _) in enumerate(enc) if g == COLLAPSED_GROUP]
    for i, (g, n, _, _) in enumerate(enc):
        if g == COLLAPSED_GROUP:
            continue
        sel.append((g, n, f"c{i}"))
    sel.append((COLLAPSED_GROUP, COLLAPSED_GROUP, " + ".join(members)))
    entries = " UNION ALL ".join(
        f"SELECT siret, periode, '{g}' AS grp, '{n}' AS feature, {v} AS value, nrm FROM ex" for g, n, v in sel)
    groups = [g for g in model.groups if any(eg == g for eg, _, _, _ in enc)]
    shift = f"({b0 / (len(enc) + 1)!r})::DOUBLE"
    radar = " UNION ALL ".join(
        f"SELECT siret, periode, '{grp}' AS grp, 1.0 / (1.0 + exp(-("
        + " + ".join(f"(c{i} - {shift})" for i, (g, _, _, _) in enumerate(enc) if g == grp)
        + "))) AS value FROM ex" for grp in groups)
    macro = " UNION ALL ".join(
        [f"SELECT siret, periode, '{grp}' AS grp, ("
         + " + ".join(f"c{i}" for i, (g, _, _, _) in enumerate(enc) if g == grp)
         + ") / NULLIF(nrm, 0) AS value FROM ex" for grp in groups]
        + [f"SELECT siret, periode, '{OFFSET}' AS grp, ({b0!r})::DOUBLE / NULLIF(nrm, 0) AS value FROM ex"])
    micro = (f"SELECT siret, periode, feature, value / NULLIF(nrm, 0) AS value FROM entries UNION ALL "
             f"SELECT siret, periode, '{OFFSET}' AS feature, ({b0!r})::DOUBLE / NULLIF(nrm, 0) AS value FROM ex")
    return ("prep AS (" + _prepared_sql() + ")", base, f"entries AS ({entries})", f"radar AS ({radar})",
            f"macro AS ({macro})", f"micro AS ({micro})")


_LIM = 4.0 * P.EXPLAIN_THRESH


@register("explain_selection", with_panel(
    "SELECT siret, strftime(periode, '%Y-%m-%d') AS periode, kind, pos::BIGINT AS pos, grp, feature FROM ("
    "SELECT *, 'select_concerning' AS kind, row_number() OVER (PARTITION BY siret, periode "
    "ORDER BY value DESC, feature) - 1 AS pos FROM entries WHERE value >= " + repr(_LIM) + " "
    "UNION ALL SELECT *, 'select_reassuring' AS kind, row_number() OVER (PARTITION BY siret, periode "
    "ORDER BY value ASC, feature) - 1 AS pos FROM entries WHERE value <= " + repr(-_LIM) + ")",
    *_explain_ctes()))
def q_explain_selection(spark, sf):
    ex = _explained(spark, sf)
    parts = []
    for kind in ("select_concerning", "select_reassuring"):
        parts.append(ex.select("siret", "periode", F.lit(kind).alias("kind"),
                               F.posexplode(F.col(f"expl_selection.{kind}")).alias("pos", "e"))
                     .select("siret", "periode", "kind", "pos", F.col("e.group").alias("grp"),
                             F.col("e.feature").alias("feature")))
    return finalize(parts[0].unionByName(parts[1]))


def _exploded(spark, sf, column: str, key: str) -> DataFrame:
    ex = _explained(spark, sf)
    return finalize(ex.select("siret", "periode", F.explode(column).alias(key, "value")))


@register("explain_radar", with_panel(
    "SELECT siret, strftime(periode, '%Y-%m-%d') AS periode, grp, round(value, 6) AS value FROM radar",
    *_explain_ctes()))
def q_explain_radar(spark, sf):
    return _exploded(spark, sf, "macro_radar", "grp")


@register("explain_macro", with_panel(
    "SELECT siret, strftime(periode, '%Y-%m-%d') AS periode, grp, round(value, 6) AS value FROM macro",
    *_explain_ctes()))
def q_explain_macro(spark, sf):
    return _exploded(spark, sf, "macro_expl", "grp")


@register("explain_micro", with_panel(
    "SELECT siret, strftime(periode, '%Y-%m-%d') AS periode, feature, round(value, 6) AS value FROM micro",
    *_explain_ctes()))
def q_explain_micro(spark, sf):
    return _exploded(spark, sf, "micro_expl", "feature")


# ---- A14, A15 on the prepared training set

def _train_prepared(spark, sf) -> DataFrame:
    return _prepared(spark, sf, TRAIN.with_(fields=DEFAULT_VARIABLES), DEFAULT_PIPELINE)


def _train_prepared_sql() -> str:
    return _prepared_sql(P.TRAIN_FROM, P.TRAIN_TO)


@register("scaler_stats", with_panel(
    " UNION ALL ".join(f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std "
                       "FROM tp" for c in NUMERIC),
    "tp AS (" + _train_prepared_sql() + ")"))
def q_scaler_stats(spark, sf):
    one = _train_prepared(spark, sf).agg(*scaler_aggregates(NUMERIC))
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"m__{c}").alias("mean"),
                                        F.col(f"s__{c}").alias("std")) for c in NUMERIC]))
    return finalize(one.select(each.alias("r")).select("r.*"))


@register("onehot_levels", with_panel(
    "SELECT 'paydex_group' AS feature, paydex_group AS level, "
    "(row_number() OVER (ORDER BY paydex_group) - 1)::BIGINT AS position "
    "FROM (SELECT DISTINCT paydex_group FROM tp WHERE paydex_group IS NOT NULL)",
    "tp AS (" + _train_prepared_sql() + ")"))
def q_onehot_levels(spark, sf):
    one = _train_prepared(spark, sf).agg(*level_aggregates(DEFAULT_ONEHOT))
    each = [one.select(F.lit(f).alias("feature"), F.posexplode(f"l__{f}").alias("position", "level")) for f in DEFAULT_ONEHOT]
    return finalize(reduce(DataFrame.unionByName, each).select("feature", "level", F.col("position").cast("long")))


# ---- P9, P10, P14: rows-only checks

@register("logreg_fit_score")
def q_logreg_fit_score(spark, sf):
    train = _train_prepared(spark, sf)
    model = fit_logistic(train, DEFAULT_FEATURE_GROUPS, DEFAULT_ONEHOT)
    test = _prepared(spark, sf, TEST.with_(fields=DEFAULT_VARIABLES), DEFAULT_PIPELINE)
    return finalize(model.score(test).select("siret", "periode", "outcome", "predicted_probability"))


@register("model_run")
def q_model_run(spark, sf):
    from vigie.plans.run import run_model
    overrides = {"train_spl_size": "all", "test_spl_size": "all", "predict_spl_size": "all"}
    preds, _, _ = run_model(spark, panel(spark, sf), default_model(), overrides)
    return finalize(preds)


@register("model_run_small")
def q_model_run_small(spark, sf):
    """P14 with the "small" specification (no financial ratios, no payment delays)."""
    from vigie.plans.run import run_model
    from vigie.plans.specs import small_model
    overrides = {"train_spl_size": "all", "test_spl_size": "all", "predict_spl_size": "all"}
    preds, _, _ = run_model(spark, panel(spark, sf), small_model(), overrides)
    return finalize(preds)


@register("export_scores", with_panel(
    f"SELECT siret, '{MONTH_A}' AS periode, round(predicted_probability, 6) AS score, '{BATCH}' AS batch, "
    f"'{ALGO}' AS algo, {FLAG_SQL} AS alert FROM merged", *MODELS_CTES))
def q_export_scores(spark, sf):
    from vigie.operators.merge import merge_models
    records = score_list(merge_models(_model_scores(spark, sf)), MONTH_A, BATCH, ALGO, P.T_ROUGE, P.T_ORANGE)
    path = f"{checkpoint_dir(spark)}/exports/{uuid.uuid4().hex}"
    io.export_scores(records, path)
    return finalize(io.read_scores(spark, path))


# ---- P9 with an oracle: at the optimum the penalised gradient is zero

@register("logreg_gradient", with_panel(
    "SELECT name, 0.0::DOUBLE AS gradient FROM (SELECT 'intercept' AS name UNION ALL "
    + " UNION ALL ".join(f"SELECT '{c}'" for c in NUMERIC)
    + " UNION ALL SELECT DISTINCT 'paydex_group_x0_' || paydex_group FROM tp WHERE paydex_group IS NOT NULL)",
    "tp AS (" + _train_prepared_sql() + ")"))
def q_logreg_gradient(spark, sf):
    """Mean gradient of loss + penalty at the fitted weights, rounded to 6 digits."""
    train = _train_prepared(spark, sf)
    return finalize(_gradient(train, fit_logistic(train, DEFAULT_FEATURE_GROUPS, DEFAULT_ONEHOT)))


def _gradient(train: DataFrame, model: LinearModel) -> DataFrame:
    residual = F.col("p") - F.col("outcome").cast("double")
    enc = [(name, x) for _, name, x in model.encoded()]
    one = model.score(train, "p").agg(
        F.count(F.lit(1)).alias("n"), F.avg(residual).alias("g"),
        *[F.avg(residual * x).alias(f"g{i}") for i, (_, x) in enumerate(enc)])
    parts = [F.struct(F.lit("intercept").alias("name"), F.col("g").alias("g"))]
    parts += [F.struct(F.lit(name).alias("name"), (F.col(f"g{i}") + F.lit(model.coefs[name]) / F.col("n")).alias("g"))
              for i, (name, _) in enumerate(enc)]
    rounded = F.abs(F.round(F.col("r.g") * 1e6) / 1e6)
    return one.select(F.explode(F.array(*parts)).alias("r")).select("r.name", rounded.alias("gradient"))


# ---- P16: the small model, fitted

_SMALL_NAMES = [f for fs in SMALL_FEATURE_GROUPS.values() for f in fs]


@register("small_gradient", " UNION ALL ".join(f"SELECT '{c}' AS name, 0.0::DOUBLE AS gradient" for c in ["intercept", *_SMALL_NAMES]))
def q_small_gradient(spark, sf):
    """Mean gradient of the small model at its fitted weights, on training rows of every establishment."""
    train = _prepared(spark, sf, TRAIN.with_(fields=SMALL_VARIABLES), SMALL_PIPELINE)
    return finalize(_gradient(train, fit_logistic(train, SMALL_FEATURE_GROUPS, ())))


# ---- P6, P9: the models of a cross-validation

@register("cv_gradient", with_panel(
    "SELECT fold, name, 0.0::DOUBLE AS gradient FROM range(" + str(P.N_FOLDS) + ") t(fold), (SELECT 'intercept' AS name UNION ALL "
    + " UNION ALL ".join(f"SELECT '{c}'" for c in NUMERIC)
    + " UNION ALL SELECT DISTINCT 'paydex_group_x0_' || paydex_group FROM tp WHERE paydex_group IS NOT NULL)",
    "tp AS (" + _train_prepared_sql() + ")"))
def q_cv_gradient(spark, sf):
    """For each fold the mean gradient of its model over its own training rows, rounded to 6 digits."""
    train = written_table(_train_prepared(spark, sf), "train")
    test = _prepared(spark, sf, TEST.with_(fields=DEFAULT_VARIABLES), DEFAULT_PIPELINE)
    folds = siren_folds(train, test, P.N_FOLDS, seed=P.SEED)
    models = fit_folds(train, folds, P.N_FOLDS, DEFAULT_FEATURE_GROUPS, DEFAULT_ONEHOT)
    parts = []
    for j, model in enumerate(models):
        train_on, _ = fold_sets(train, test, folds, j)
        parts.append(_gradient(train_on, model).select(F.lit(j).alias("fold"), "name", "gradient"))
    return finalize(reduce(DataFrame.unionByName, parts))


@register("cv_scored_rows", with_panel(
    "SELECT fold, count(*)::BIGINT AS n FROM te JOIN f USING (siren) GROUP BY fold",
    "tp AS (" + _train_prepared_sql() + ")", "te AS (" + _prepared_sql(P.TEST_FROM, P.TEST_TO) + ")",
    "f AS (SELECT siren, (ntile(" + str(P.N_FOLDS) + ") OVER (ORDER BY CAST(('0x' || substr(md5(siren || '|" + str(P.SEED)
    + "'), 1, 8)) AS BIGINT), siren) - 1)::BIGINT AS fold FROM (SELECT DISTINCT siren FROM tp))"))
def q_cv_scored_rows(spark, sf):
    """Rows that each fold's model scores: test rows of the firms it has not seen."""
    train = written_table(_train_prepared(spark, sf), "train")
    test = _prepared(spark, sf, TEST.with_(fields=DEFAULT_VARIABLES), DEFAULT_PIPELINE)
    result = cross_validate(train, test, P.N_FOLDS, DEFAULT_FEATURE_GROUPS, DEFAULT_ONEHOT, seed=P.SEED)
    return finalize(result.where("n > 0").select("fold", "n"))


# ---- P14, S6, S7, S10: what a run writes, read back

@register("model_run_files", with_panel(
    "SELECT siret, siren, true AS scored FROM (" + _prepared_sql(P.PREDICT_ON, month_window_end(P.PREDICT_ON)) + ") UNION ALL "
    "SELECT 'statistics', 'aucpr,balanced_accuracy,confusion_matrix,fbeta', true"))
def q_model_run_files(spark, sf):
    from vigie.plans.run import run_model
    out_dir = f"{checkpoint_dir(spark)}/runs/{uuid.uuid4().hex}"
    _, stats, _ = run_model(spark, panel(spark, sf), default_model(), {"train_spl_size": "all"}, out_dir=out_dir)
    p = F.col("predicted_probability").cast("double")
    rows = io.read_predictions(spark, f"{stats['output']}/predictions").select("siret", "siren", ((p > 0) & (p < 1)).alias("scored"))
    back = io.read_stats(spark, f"{stats['output']}/stats")
    keys = ",".join(sorted(k.lower() for k in back["test"]))
    return finalize(rows.unionByName(spark.createDataFrame([("statistics", keys, True)], rows.schema)))


# ---- S1, S2: a ready table of nested records with NaN

@register("scan_nested", with_panel(
    scan_sql(ALL_FROM, ALL_TO, cols="siret, siren, strftime(periode, '%Y-%m-%d') AS periode, round(effectif, 6) AS effectif, "
             "round(paydex_nb_jours, 6) AS paydex_nb_jours, outcome", extra="AND siret NOT LIKE '%1'")))
def q_scan_nested(spark, sf):
    """Records {_id, value} whose staff is NaN for some: those do not pass the staff filter."""
    fields = ("siret", "siren", "periode", "effectif", "paydex_nb_jours", "outcome")
    wide = panel(spark, sf).withColumn("effectif", F.when(F.col("siret").endswith("1"), F.lit(float("nan"))).otherwise(F.col("effectif")))
    wide = wide.withColumn("paydex_nb_jours", F.coalesce("paydex_nb_jours", F.lit(float("nan"))))
    path = f"{checkpoint_dir(spark)}/nested/{uuid.uuid4().hex}"
    wide.select(F.struct("siret", "periode").alias("_id"), F.struct(*fields, "random_order").alias("value")).write.parquet(path)
    return finalize(fetch(io.read_features(spark, path), WHOLE.with_(fields=fields)))


# ---- S3-S5, S8, S9, F11, O2: files and lists, written and read back

@register("files_extract", with_panel(
    "SELECT siret, siren, strftime(periode, '%Y-%m-%d') AS periode, round(effectif, 6) AS effectif FROM panel"))
def q_files_extract(spark, sf):
    path = f"{checkpoint_dir(spark)}/extracts/{uuid.uuid4().hex}"
    io.write_extract_csv(panel(spark, sf).select("siret", "siren", "periode", "effectif"), path)
    back = io.read_extract_csv(spark, path)
    return finalize(back.select("siret", "siren", F.col("periode").cast("date"), F.col("effectif").cast("double")))


@register("files_siret_list", with_panel(
    scan_sql(ALL_FROM, ALL_TO, cols="siret, strftime(periode, '%Y-%m-%d') AS periode", extra="AND siret LIKE '%2'")))
def q_files_siret_list(spark, sf):
    path = f"{checkpoint_dir(spark)}/lists/{uuid.uuid4().hex}"
    pan = panel(spark, sf)
    # as numbers, without leading zeros
    pan.where(F.col("siret").endswith("2")).select(F.col("siret").cast("long").cast("string")).distinct().write.text(path)
    return finalize(fetch(pan, WHOLE.with_(sirets=io.read_siret_list(spark, path), fields=("siret", "periode"))))


def _probability_sql(model: LinearModel) -> str:
    z = " + ".join([f"({model.intercept!r})::DOUBLE"] + [c for _, _, c, _ in _contrib_sql(model)])
    return f"1.0 / (1.0 + exp(-({z})))"


@register("files_model", with_panel(
    f"SELECT siret, strftime(periode, '%Y-%m-%d') AS periode, round({_probability_sql(fixed_explain_model())}, 6) AS predicted_probability "
    "FROM prep", "prep AS (" + _prepared_sql() + ")"))
def q_files_model(spark, sf):
    """A model saved, loaded and applied to every prepared row of the panel."""
    path = f"{checkpoint_dir(spark)}/models/{uuid.uuid4().hex}"
    fixed_explain_model().save(spark, path)
    rows = _prepared(spark, sf, WHOLE.with_(fields=DEFAULT_VARIABLES), DEFAULT_PIPELINE)
    return finalize(LinearModel.load(spark, path).score(rows).select("siret", "periode", "predicted_probability"))


@register("remove_listed_firms", with_panel(
    "SELECT siret, strftime(periode, '%Y-%m-%d') AS periode FROM panel WHERE siren NOT IN "
    "(SELECT DISTINCT siren FROM panel WHERE coalesce(code_naf = 'A', false))"))
def q_remove_listed_firms(spark, sf):
    pan = panel(spark, sf).select("siret", "siren", "periode", "code_naf")
    return finalize(remove_siren(pan, pan.where("code_naf = 'A'").select("siren")).select("siret", "periode"))


@register("sample_topk_cut", with_panel(
    scan_sql(ALL_FROM, ALL_TO, cols="siret, strftime(periode, '%Y-%m-%d') AS periode, round(random_order, 6) AS random_order",
             extra=f"ORDER BY random_order DESC, siret, periode LIMIT {P.SAMPLE_N}")))
def q_sample_topk_cut(spark, sf):
    """The histogram path of the sample, forced by a small budget."""
    rows = fetch(panel(spark, sf), WHOLE.with_(fields=("siret", "periode", "random_order")))
    return finalize(top_n(rows, P.SAMPLE_N, direct_limit=50))


# ---- S1: a panel that grows by months

_GROWN = [c for c in PANEL_COLUMNS if c not in ("siret", "siren", "periode", "code_naf", "code_ape_niveau3", "region",
                                                "time_til_outcome", "outcome")]


@register("panel_append", with_panel(
    "SELECT siret, siren, strftime(periode, '%Y-%m-%d') AS periode, code_naf, code_ape_niveau3, region, "
    "time_til_outcome::BIGINT AS time_til_outcome, outcome, " + ", ".join(f"round({c}, 6) AS {c}" for c in _GROWN) + " FROM panel"))
def q_panel_append(spark, sf):
    """Old orders first, then two appends, the second of which also replaces months of the first."""
    store = PanelStore(spark, f"{checkpoint_dir(spark)}/panel-store/{uuid.uuid4().hex}")
    store.append(sf, until=P.TEST_FROM)
    store.append(sf, since=P.TEST_FROM, until=P.PREDICT_ON)
    store.append(sf, since=P.TEST_TO)
    return finalize(store.read())
