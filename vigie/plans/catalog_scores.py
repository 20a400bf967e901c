"""Registered queries on scored data: metrics, thresholds, merge, adjustment,
folds and synthetic firms (with their DuckDB oracles).

Scores come from the fixed linear score of ``params`` (rounded to 6 digits,
so ties exist and tie handling is exercised).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigie.functions.features import round_to, sigmoid
from vigie.operators import metrics, thresholds
from vigie.operators.adjust import adjust_pipeline, attach_debt_snapshots
from vigie.operators.dataset import DatasetSpec, fetch, month_window_end
from vigie.operators.merge import flag_scores, merge_models, score_list
from vigie.operators.split import exclude_train_firms, fold_sets, fold_sizes, siren_folds, with_fold
from vigie.operators.synthetic import build_synthetic_dataset
from vigie.plans import params as P
from vigie.plans.catalog import (ALL_FROM, ALL_TO, FIXED_SCORE_SQL, PREDICT, WHOLE, TEST, TRAIN, _prepared, finalize, fixed_score,
                                 panel, register, scan_sql)
from vigie.plans.oracle_panel import with_panel
from vigie.plans.pipeline import DEFAULT_PIPELINE, run_pipeline

# --------------------------------------------------------------------------- scored evaluation set

EVAL = WHOLE.with_(fields=("siret", "siren", "periode", "outcome") + tuple(n for n, _ in P.FIXED_COEFS))


def scored(spark, sf) -> DataFrame:
    return fetch(panel(spark, sf), EVAL).withColumn("score", fixed_score())


SCORED_CTE = ("scored AS (" + scan_sql(ALL_FROM, ALL_TO,
                                       cols=f"siret, siren, periode, outcome, {FIXED_SCORE_SQL} AS score") + ")")


def _w(body: str, *ctes: str) -> str:
    return with_panel(body, SCORED_CTE, *ctes)


# --------------------------------------------------------------------------- A5, A6, A7, A9

@register("class_balance", _w(
    "SELECT outcome, count(*) AS n_rows, "
    "round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM scored), 6) AS percent FROM scored GROUP BY outcome"))
def q_class_balance(spark, sf):
    return finalize(metrics.class_balance(scored(spark, sf)))


CONF_CTE = ("conf AS (SELECT "
            "sum(CASE WHEN NOT outcome AND score < 0.5 THEN 1 ELSE 0 END)::BIGINT AS tn, "
            "sum(CASE WHEN NOT outcome AND score >= 0.5 THEN 1 ELSE 0 END)::BIGINT AS fp, "
            "sum(CASE WHEN outcome AND score < 0.5 THEN 1 ELSE 0 END)::BIGINT AS fn, "
            "sum(CASE WHEN outcome AND score >= 0.5 THEN 1 ELSE 0 END)::BIGINT AS tp FROM scored)")


@register("confusion", _w("SELECT * FROM conf", CONF_CTE))
def q_confusion(spark, sf):
    return finalize(metrics.confusion(scored(spark, sf), 0.5))


CURVE_CTES = (
    "st AS (SELECT score AS threshold, sum(CASE WHEN outcome THEN 1 ELSE 0 END)::BIGINT AS tp_at, "
    "sum(CASE WHEN outcome THEN 0 ELSE 1 END)::BIGINT AS fp_at FROM scored GROUP BY score)",
    "cum AS (SELECT threshold, tp_at, fp_at, "
    "sum(tp_at) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS tps, "
    "sum(fp_at) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS fps, "
    "(SELECT sum(tp_at) FROM st)::BIGINT AS n_pos FROM st)",
    "ap AS (SELECT coalesce(sum(CASE WHEN n_pos > 0 THEN (tp_at::DOUBLE / n_pos::DOUBLE) * "
    "(tps::DOUBLE / (tps + fps)::DOUBLE) END), 0.0) AS average_precision FROM cum)",
    "curve AS (SELECT threshold, CASE WHEN tps + fps > 0 THEN tps::DOUBLE / (tps + fps)::DOUBLE ELSE 0.0 END "
    "AS precision, tps::DOUBLE / n_pos::DOUBLE AS recall FROM cum "
    "WHERE threshold >= (SELECT max(threshold) FROM cum WHERE tps = n_pos) "
    "UNION ALL SELECT NULL::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE)",
)


@register("average_precision", _w("SELECT round(average_precision, 6) AS average_precision FROM ap",
                                  *CURVE_CTES))
def q_average_precision(spark, sf):
    return finalize(metrics.average_precision(scored(spark, sf)))


@register("pr_curve", _w("SELECT round(threshold, 6) AS threshold, round(precision, 6) AS precision, "
                         "round(recall, 6) AS recall FROM curve", *CURVE_CTES))
def q_pr_curve(spark, sf):
    return finalize(metrics.pr_curve(scored(spark, sf)))


def _metrics_sql(beta: float) -> str:
    b2 = float(beta) ** 2
    p = "CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp)::DOUBLE ELSE 0.0 END"
    r = "CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn)::DOUBLE ELSE 0.0 END"
    spec = "CASE WHEN tn + fp > 0 THEN tn::DOUBLE / (tn + fp)::DOUBLE ELSE 0.0 END"
    f = (f"CASE WHEN {b2}::DOUBLE * ({p}) + ({r}) <> 0 THEN (1.0 + {b2})::DOUBLE * ({p}) * ({r}) / "
         f"({b2}::DOUBLE * ({p}) + ({r})) ELSE 0.0 END")
    return (f"SELECT round(average_precision, 6) AS aucpr, round((({r}) + ({spec})) / 2.0, 6) AS balanced_accuracy, "
            f"tn, fp, fn, tp, round({f}, 6) AS f2, round({p}, 6) AS precision, round({r}, 6) AS recall "
            "FROM conf, ap")


@register("evaluate_metrics", _w(_metrics_sql(2.0), CONF_CTE, *CURVE_CTES))
def q_evaluate_metrics(spark, sf):
    return finalize(metrics.evaluate(scored(spark, sf), beta=2, thresh=0.5))


# --------------------------------------------------------------------------- A11, A12, W4, X14

N_THR = 1000
GRID_CTE = (f"grid AS (SELECT j AS position, CASE WHEN j = {N_THR - 1} THEN 1.0::DOUBLE "
            f"ELSE j::DOUBLE * (1.0::DOUBLE / {N_THR - 1}.0::DOUBLE) END AS threshold "
            f"FROM range(0, {N_THR}) t(j))")


def _fb(beta: float) -> str:
    b2 = float(beta) ** 2
    p = "CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp)::DOUBLE ELSE 0.0 END"
    r = "CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn)::DOUBLE ELSE 0.0 END"
    return (f"CASE WHEN {b2}::DOUBLE * ({p}) + ({r}) <> 0 THEN (1.0 + {b2})::DOUBLE * ({p}) * ({r}) / "
            f"({b2}::DOUBLE * ({p}) + ({r})) ELSE 0.0 END")


SWEEP_CTE = (
    "sweep AS (SELECT position, threshold, tp, fp, n_pos - tp AS fn FROM ("
    "SELECT g.position, g.threshold, "
    "sum(CASE WHEN s.outcome THEN 1 ELSE 0 END)::BIGINT AS tp, "
    "sum(CASE WHEN s.outcome THEN 0 ELSE 1 END)::BIGINT AS fp, "
    "(SELECT sum(CASE WHEN outcome THEN 1 ELSE 0 END) FROM scored)::BIGINT AS n_pos "
    "FROM grid g LEFT JOIN scored s ON s.score >= g.threshold GROUP BY g.position, g.threshold) x)")


@register("threshold_fbeta", _w(
    "SELECT * FROM "
    f"(SELECT round(threshold, 6) AS t_f1, round({_fb(0.5)}, 6) AS fbeta_f1 FROM sweep "
    f" ORDER BY {_fb(0.5)} DESC, position ASC LIMIT 1), "
    f"(SELECT round(threshold, 6) AS t_f2, round({_fb(2.0)}, 6) AS fbeta_f2 FROM sweep "
    f" ORDER BY {_fb(2.0)} DESC, position ASC LIMIT 1)",
    GRID_CTE, SWEEP_CTE))
def q_threshold_fbeta(spark, sf):
    return finalize(thresholds.thresholds_from_fbeta(scored(spark, sf), 0.5, 2.0, N_THR))


MIN_PRECISION, MIN_RECALL = 0.6, 0.63


@register("threshold_conditions", _w(
    "SELECT round((SELECT threshold FROM arr WHERE idx = coalesce((SELECT min(idx) FROM arr "
    f"  WHERE precision >= {MIN_PRECISION}), 0)), 6) AS t_f1, "
    "round((SELECT threshold FROM arr WHERE idx = coalesce((SELECT max(idx) FROM arr "
    f"  WHERE idx >= 1 AND recall >= {MIN_RECALL}), (SELECT max(idx) FROM arr)) - 1), 6) AS t_f2",
    *CURVE_CTES,
    "arr AS (SELECT threshold, precision, recall, "
    "row_number() OVER (ORDER BY threshold ASC NULLS LAST) - 1 AS idx FROM curve)"))
def q_threshold_conditions(spark, sf):
    curve = metrics.pr_curve(scored(spark, sf))
    return finalize(thresholds.thresholds_from_conditions(curve, MIN_PRECISION, MIN_RECALL))


@register("recall_gradient", _w(
    "SELECT round(threshold, 6) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall, "
    "round(1.0 - precision, 6) AS type1_error, round(1.0 - recall, 6) AS type2_error, "
    "round((recall - pr) / (threshold - pt), 6) AS recall_gradient FROM ("
    "SELECT *, lag(recall) OVER (ORDER BY threshold) AS pr, lag(threshold) OVER (ORDER BY threshold) AS pt "
    "FROM curve WHERE threshold IS NOT NULL) WHERE pt IS NOT NULL", *CURVE_CTES))
def q_recall_gradient(spark, sf):
    curve = metrics.pr_curve(scored(spark, sf))
    return finalize(thresholds.recall_gradient(curve))


# --------------------------------------------------------------------------- J3, X6, A4, P17, S11

MONTH_A = P.PREDICT_ON
MONTH_C = "2000-06-01"


def _model_scores(spark, sf):
    pan = panel(spark, sf)
    fields = ("siret", "siren", "periode", "ratio_dette", "paydex_nb_jours", "endettement",
              "apart_heures_consommees")
    month_a = fetch(pan, DatasetSpec(date_min=MONTH_A, date_max=month_window_end(MONTH_A),
                                     sample_size=None, fields=fields))
    month_c = fetch(pan, DatasetSpec(date_min=MONTH_C, date_max=month_window_end(MONTH_C),
                                     sample_size=None, fields=fields))
    a = month_a.filter(F.col("endettement").isNotNull()).select(
        "siret", "siren", fixed_score().alias("predicted_probability"))
    b = month_a.select("siret", "siren", round_to(sigmoid(F.lit(-1.0) + F.lit(2.0) * F.col("ratio_dette")), 6)
                       .alias("predicted_probability"))
    c = month_c.select("siret", "siren", round_to(
        sigmoid(F.lit(-0.5) + F.lit(0.01) * F.col("paydex_nb_jours")), 6).alias("predicted_probability"))
    return [a, b, c]


def _month_scan(month: str) -> str:
    return scan_sql(month, month_window_end(month), cols="*")


MODELS_CTES = (
    "ma AS (SELECT siret, " + FIXED_SCORE_SQL + " AS p FROM (" + _month_scan(MONTH_A) + ") "
    "WHERE endettement IS NOT NULL)",
    "mb AS (SELECT siret, round(1.0 / (1.0 + exp(-((-1.0)::DOUBLE + (2.0)::DOUBLE * ratio_dette))), 6) AS p "
    "FROM (" + _month_scan(MONTH_A) + "))",
    "mc AS (SELECT siret, round(1.0 / (1.0 + exp(-((-0.5)::DOUBLE + (0.01)::DOUBLE * paydex_nb_jours))), 6) AS p "
    "FROM (" + _month_scan(MONTH_C) + "))",
    "merged AS (SELECT coalesce(ma.siret, mb.siret, mc.siret) AS siret, "
    "coalesce(ma.p, mb.p, mc.p) AS predicted_probability FROM ma "
    "FULL OUTER JOIN mb ON ma.siret = mb.siret "
    "FULL OUTER JOIN mc ON coalesce(ma.siret, mb.siret) = mc.siret)",
)

FLAG_SQL = (f"CASE WHEN predicted_probability > {P.T_ROUGE} THEN 'Alerte seuil F1' "
            f"WHEN predicted_probability > {P.T_ORANGE} THEN 'Alerte seuil F2' ELSE 'Pas d''alerte' END")


@register("merge_models", with_panel(
    "SELECT siret, round(predicted_probability, 6) AS predicted_probability FROM merged", *MODELS_CTES))
def q_merge_models(spark, sf):
    return finalize(merge_models(_model_scores(spark, sf)))


@register("assign_flag", with_panel(
    f"SELECT siret, round(predicted_probability, 6) AS predicted_probability, {FLAG_SQL} AS alert FROM merged",
    *MODELS_CTES))
def q_assign_flag(spark, sf):
    return finalize(flag_scores(merge_models(_model_scores(spark, sf)), P.T_ROUGE, P.T_ORANGE))


@register("alert_counts", with_panel(
    "SELECT n_total, n_red, n_above - n_red AS n_orange, round(n_red * 100.0 / n_total, 2) AS pct_red, "
    "round((n_above - n_red) * 100.0 / n_total, 2) AS pct_orange FROM (SELECT count(*) AS n_total, "
    f"sum(CASE WHEN predicted_probability > {P.T_ROUGE} THEN 1 ELSE 0 END)::BIGINT AS n_red, "
    f"sum(CASE WHEN predicted_probability > {P.T_ORANGE} THEN 1 ELSE 0 END)::BIGINT AS n_above FROM merged)",
    *MODELS_CTES))
def q_alert_counts(spark, sf):
    return finalize(metrics.alert_counts(merge_models(_model_scores(spark, sf)), P.T_ROUGE, P.T_ORANGE))


BATCH, ALGO = "2000-07", "default_merged"


@register("alert_list", with_panel(
    f"SELECT siret, '{MONTH_A}' AS periode, round(predicted_probability, 6) AS score, '{BATCH}' AS batch, "
    f"'{ALGO}' AS algo, {FLAG_SQL} AS alert FROM merged", *MODELS_CTES))
def q_alert_list(spark, sf):
    merged = merge_models(_model_scores(spark, sf))
    return finalize(score_list(merged, MONTH_A, BATCH, ALGO, P.T_ROUGE, P.T_ORANGE))


# --------------------------------------------------------------------------- J2, X4, X5, P4

def _predict_scored(spark, sf):
    fields = ("siret", "siren", "periode") + tuple(n for n, _ in P.FIXED_COEFS)
    df = fetch(panel(spark, sf), PREDICT.with_(fields=fields))
    return df.select("siret", "siren", "periode", fixed_score().alias("predicted_probability"))


def _snap_sql(month: str, date_max: str, cols: str) -> str:
    return scan_sql(month, date_max, cols=f"siret, siren, {cols}")


SNAP_CTES = (
    "pred AS (SELECT siret, siren, periode, " + FIXED_SCORE_SQL + " AS predicted_probability FROM ("
    + scan_sql(P.PREDICT_ON, month_window_end(P.PREDICT_ON)) + "))",
    "july AS (" + _snap_sql(P.JULY_SNAPSHOT, P.JULY_SNAPSHOT[:-2] + "31",
                            "montant_part_ouvriere AS montant_part_ouvriere_july2020, "
                            "montant_part_patronale AS montant_part_patronale_july2020") + ")",
    "latest AS (" + _snap_sql(P.LATEST_SNAPSHOT, month_window_end(P.LATEST_SNAPSHOT),
                              "montant_part_ouvriere AS montant_part_ouvriere_latest, "
                              "montant_part_patronale AS montant_part_patronale_latest, "
                              "cotisation_moy12m AS cotisation_moy12m_latest") + ")",
    "snap AS (SELECT p.*, j.montant_part_ouvriere_july2020, j.montant_part_patronale_july2020, "
    "l.montant_part_ouvriere_latest, l.montant_part_patronale_latest, l.cotisation_moy12m_latest "
    "FROM pred p LEFT JOIN july j ON p.siret = j.siret AND p.siren = j.siren "
    "LEFT JOIN latest l ON p.siret = l.siret AND p.siren = l.siren)",
)


@register("debt_snapshots", with_panel(
    "SELECT siret, siren, strftime(periode, '%Y-%m-%d') AS periode, "
    "round(predicted_probability, 6) AS predicted_probability, "
    "round(montant_part_ouvriere_latest, 6) AS montant_part_ouvriere_latest, "
    "round(montant_part_patronale_latest, 6) AS montant_part_patronale_latest, "
    "round(montant_part_ouvriere_july2020, 6) AS montant_part_ouvriere_july2020, "
    "round(montant_part_patronale_july2020, 6) AS montant_part_patronale_july2020, "
    "round(cotisation_moy12m_latest, 6) AS cotisation_moy12m_latest FROM snap", *SNAP_CTES))
def q_debt_snapshots(spark, sf):
    out = attach_debt_snapshots(_predict_scored(spark, sf), panel(spark, sf),
                                july=P.JULY_SNAPSHOT, latest=P.LATEST_SNAPSHOT)
    return finalize(out)


def _level_col():
    p = F.col("predicted_probability")
    return F.when(p > P.T_ROUGE, "rouge").when(p > P.T_ORANGE, "orange").otherwise("vert")


_DEBTS = ("montant_part_ouvriere_july2020", "montant_part_patronale_july2020",
          "montant_part_ouvriere_latest", "montant_part_patronale_latest")


@register("debt_rule", with_panel(
    "SELECT siret, group_final, " + ", ".join(f"round(coalesce({c}, 0.0), 6) AS {c}" for c in _DEBTS) + ", "
    "round(dj, 6) AS dette_sociale_july2020, round(dl, 6) AS dette_sociale_latest, "
    "round(CASE WHEN cotisation_moy12m_latest <> 0 THEN (dl - dj) / cotisation_moy12m_latest END, 6) AS delta_dette, "
    "CASE WHEN ((dl - dj) / NULLIF(cotisation_moy12m_latest, 0) > 0.2 "
    "           OR (cotisation_moy12m_latest = 0 AND dl - dj > 0)) "
    "     THEN CASE group_final WHEN 'vert' THEN 'orange' WHEN 'orange' THEN 'rouge' WHEN 'rouge' THEN 'rouge' "
    "          ELSE group_final END ELSE group_final END AS group_final_regle_urssaf FROM ("
    "SELECT siret, coalesce(montant_part_ouvriere_july2020, 0.0) + coalesce(montant_part_patronale_july2020, 0.0) AS dj, "
    "coalesce(montant_part_ouvriere_latest, 0.0) + coalesce(montant_part_patronale_latest, 0.0) AS dl, "
    "cotisation_moy12m_latest, " + ", ".join(_DEBTS) + ", "
    f"CASE WHEN predicted_probability > {P.T_ROUGE} THEN 'rouge' WHEN predicted_probability > {P.T_ORANGE} "
    "THEN 'orange' ELSE 'vert' END AS group_final FROM snap)", *SNAP_CTES))
def q_debt_rule(spark, sf):
    """The adjustment pipeline (snapshots, then the rule) on alert levels."""
    steps = adjust_pipeline(panel(spark, sf), july=P.JULY_SNAPSHOT, latest=P.LATEST_SNAPSHOT)
    out = run_pipeline(_predict_scored(spark, sf).withColumn("group_final", _level_col()), steps)
    return finalize(out.select("siret", "group_final", *_DEBTS, "dette_sociale_july2020", "dette_sociale_latest",
                               "delta_dette", "group_final_regle_urssaf"))


# --------------------------------------------------------------------------- J1, F11, F18, P6, W5, J5

_TRAIN_FIELDS = ("siret", "siren", "periode", "outcome", "time_til_outcome", "code_naf", "effectif",
                 "montant_part_ouvriere", "montant_part_patronale", "montant_part_ouvriere_past_3",
                 "montant_part_patronale_past_3", "paydex_nb_jours", "paydex_nb_jours_past_12")

TRAIN_CLEAN_CTE = (
    "train_clean AS (SELECT siren FROM (" + scan_sql(P.TRAIN_FROM, P.TRAIN_TO) + ") "
    "WHERE paydex_nb_jours IS NOT NULL AND paydex_nb_jours_past_12 IS NOT NULL "
    "AND NOT coalesce(code_naf IN ('O', 'P'), false))")


@register("exclude_train_firms", with_panel(
    "SELECT siret, siren, strftime(periode, '%Y-%m-%d') AS periode FROM (" + scan_sql(P.TEST_FROM, P.TEST_TO) + ") t "
    "WHERE NOT EXISTS (SELECT 1 FROM train_clean c WHERE c.siren = t.siren)", TRAIN_CLEAN_CTE))
def q_exclude_train_firms(spark, sf):
    train = _prepared(spark, sf, TRAIN.with_(fields=_TRAIN_FIELDS), DEFAULT_PIPELINE)
    test = fetch(panel(spark, sf), TEST.with_(fields=("siret", "siren", "periode")))
    return finalize(exclude_train_firms(test, train))


N_FOLDS = P.N_FOLDS
FOLD_CTES = (
    "tr AS (" + scan_sql(P.TRAIN_FROM, P.TRAIN_TO, cols="siret, siren, periode") + ")",
    "te AS (" + scan_sql(P.TEST_FROM, P.TEST_TO, cols="siret, siren, periode") + ")",
    f"folds AS (SELECT siren, ntile({N_FOLDS}) OVER (ORDER BY "
    f"CAST(('0x' || substr(md5(siren || '|' || '{P.SEED}'), 1, 8)) AS BIGINT)::DOUBLE / 4294967296.0::DOUBLE, "
    "siren) - 1 AS fold FROM (SELECT DISTINCT siren FROM tr))",
)


def _fold_inputs(spark, sf):
    pan = panel(spark, sf)
    return (fetch(pan, TRAIN.with_(fields=("siret", "siren", "periode"))),
            fetch(pan, TEST.with_(fields=("siret", "siren", "periode"))))


@register("siren_folds", with_panel("SELECT siren, fold::BIGINT AS fold FROM folds", *FOLD_CTES))
def q_siren_folds(spark, sf):
    train, test = _fold_inputs(spark, sf)
    return finalize(siren_folds(train, test, N_FOLDS, seed=P.SEED))


@register("siren_fold_sizes", with_panel(
    "SELECT f.fold::BIGINT AS fold, "
    "((SELECT count(*) FROM tr) - coalesce((SELECT count(*) FROM tr JOIN folds x ON tr.siren = x.siren "
    "  WHERE x.fold = f.fold), 0))::BIGINT AS n_train_on, "
    "coalesce((SELECT count(*) FROM te JOIN folds x ON te.siren = x.siren WHERE x.fold = f.fold), 0)::BIGINT "
    "AS n_test_on FROM (SELECT range AS fold FROM range(0, 5)) f", *FOLD_CTES))
def q_siren_fold_sizes(spark, sf):
    train, test = _fold_inputs(spark, sf)
    folds = siren_folds(train, test, N_FOLDS, seed=P.SEED)
    return finalize(fold_sizes(train, test, folds, N_FOLDS))


# --------------------------------------------------------------------------- P7

SYN_CONT = ("effectif", "ratio_dette", "cotisation", "paydex_nb_jours")
SYN_CAT = ("outcome", "code_naf", "region")
GROUP_SIZE = 5


def _hash_sql(expr: str) -> str:
    return f"CAST(('0x' || substr(md5({expr}), 1, 8)) AS BIGINT)::DOUBLE / 4294967296.0::DOUBLE"


@register("synthetic_firms", with_panel(
    "SELECT CAST(100000000 + ((id % 900000000) * 633910099) % 900000000 AS VARCHAR) || lpad(CAST(id // 900000000 AS VARCHAR), 5, '0') AS siret, "
    "CAST(100000000 + ((id % 900000000) * 633910099) % 900000000 AS VARCHAR) AS siren, "
    "strftime(periode, '%Y-%m-%d') AS periode, outcome, code_naf, region, "
    + ", ".join(f"round({c}, 6) AS {c}" for c in SYN_CONT) + " FROM ("
    "SELECT g.*, r.outcome, r.code_naf, r.region, row_number() OVER (ORDER BY "
    + _hash_sql("g.code_ape_niveau3 || '|' || CAST(g.gid AS VARCHAR) || '|' || '" + str(P.SEED) + "'")
    + ", g.code_ape_niveau3, g.gid) AS id FROM g JOIN m r ON r.code_ape_niveau3 = g.code_ape_niveau3 "
    "AND r.rk = g.min_rk)",
    "base AS (" + scan_sql(ALL_FROM, ALL_TO) + ")",
    f"big AS (SELECT code_ape_niveau3 FROM base WHERE code_ape_niveau3 IS NOT NULL GROUP BY code_ape_niveau3 "
    f"HAVING count(siret) > {GROUP_SIZE})",
    "m AS (SELECT *, row_number() OVER (PARTITION BY code_ape_niveau3 ORDER BY "
    + _hash_sql("siret || '|' || CAST(periode AS VARCHAR) || '|' || '" + str(P.SEED) + "'")
    + ", siret, periode) AS rk FROM base WHERE code_ape_niveau3 IN (SELECT code_ape_niveau3 FROM big))",
    "g AS (SELECT code_ape_niveau3, rk % " + str(GROUP_SIZE) + " AS gid, "
    + ", ".join(f"avg({c}) AS {c}" for c in SYN_CONT)
    + ", max(periode) AS periode, min(rk) AS min_rk FROM m GROUP BY code_ape_niveau3, rk % "
    + str(GROUP_SIZE) + ")"))
def q_synthetic_firms(spark, sf):
    base = fetch(panel(spark, sf), WHOLE)
    return finalize(build_synthetic_dataset(base, list(SYN_CONT), list(SYN_CAT), GROUP_SIZE, seed=P.SEED))


@register("synthetic_ids", with_panel(
    "SELECT n AS n_rows, n AS n_sirets, n AS n_sirens, 14::BIGINT AS siret_len, 9::BIGINT AS siren_len FROM ("
    f"SELECT coalesce(sum({GROUP_SIZE}), 0)::BIGINT AS n FROM (SELECT code_ape_niveau3 FROM ("
    + scan_sql(ALL_FROM, ALL_TO) + ") WHERE code_ape_niveau3 IS NOT NULL GROUP BY code_ape_niveau3 "
    f"HAVING count(siret) > {GROUP_SIZE}))"))
def q_synthetic_ids(spark, sf):
    """Every mock establishment has a siret and a siren of its own."""
    out = build_synthetic_dataset(fetch(panel(spark, sf), WHOLE), list(SYN_CONT), list(SYN_CAT), GROUP_SIZE, seed=P.SEED)
    return finalize(out.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("siret").alias("n_sirets"),
                            F.count_distinct("siren").alias("n_sirens"), F.max(F.length("siret")).alias("siret_len"),
                            F.min(F.length("siren")).alias("siren_len")))


# --------------------------------------------------------------------------- rows without a score

def scored_with_gaps(spark, sf) -> DataFrame:
    """The scored set without the scores of establishments whose siret ends in 2."""
    return scored(spark, sf).withColumn("score", F.when(F.substring("siret", -1, 1) != "2", F.col("score")))


GAPS_CTE = ("scored AS (" + scan_sql(ALL_FROM, ALL_TO, cols="siret, siren, periode, outcome, "
            f"CASE WHEN substr(siret, -1, 1) <> '2' THEN {FIXED_SCORE_SQL} END AS score") + " AND substr(siret, -1, 1) <> '2')")


@register("pr_curve_null_scores", with_panel(
    "SELECT round(threshold, 6) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall FROM curve",
    GAPS_CTE, *CURVE_CTES))
def q_pr_curve_null_scores(spark, sf):
    return finalize(metrics.pr_curve(scored_with_gaps(spark, sf)))


@register("evaluate_null_scores", with_panel(_metrics_sql(2.0), GAPS_CTE, CONF_CTE, *CURVE_CTES))
def q_evaluate_null_scores(spark, sf):
    return finalize(metrics.evaluate(scored_with_gaps(spark, sf), beta=2, thresh=0.5))


# --------------------------------------------------------------------------- J5: the sets of every fold

@register("fold_sets", with_panel(
    "SELECT f.fold::BIGINT AS fold, 'train' AS part, siret, strftime(periode, '%Y-%m-%d') AS periode "
    "FROM (SELECT range AS fold FROM range(0, 5)) f, tr JOIN folds x ON tr.siren = x.siren WHERE x.fold <> f.fold "
    "UNION ALL SELECT x.fold::BIGINT, 'test', siret, strftime(periode, '%Y-%m-%d') FROM te JOIN folds x ON te.siren = x.siren",
    *FOLD_CTES))
def q_fold_sets(spark, sf):
    """Training and test rows of all folds; each set meets the fold map once."""
    train, test = _fold_inputs(spark, sf)
    folds = siren_folds(train, test, N_FOLDS, seed=P.SEED)
    train, test = with_fold(train, folds), with_fold(test, folds)
    out = None
    for i in range(N_FOLDS):
        for part, df in zip(("train", "test"), fold_sets(train, test, folds, i)):
            rows = df.select(F.lit(i).cast("long").alias("fold"), F.lit(part).alias("part"), "siret", "periode")
            out = rows if out is None else out.unionByName(rows)
    return finalize(out)
