"""Registered queries: one per operator group of SURVEY §2, each with the
DuckDB text that computes the same result independently.

Every query starts from the panel derived from the driver's tables (whole
tables, no id subsets or row caps; a limit appears only where sampling is the
operator under test).  Outputs are normalised for comparison: dates as
'YYYY-MM-DD' strings, doubles rounded to 6 decimals, integers as bigint.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigie.functions.features import pad_id, round_to, sigmoid
from vigie.operators import clean
from vigie.operators.dataset import DatasetSpec, fetch, month_window_end, quota_sizes
from vigie.operators.sampling import sample_rows, split_column
from vigie.plans import params as P
from vigie.plans.oracle_panel import with_panel
from vigie.plans.pipeline import DEFAULT_PIPELINE, SMALL_PIPELINE, run_pipeline
from vigie.schema import IGNORE_NA
from vigie.sources.panel import load_panel, read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --------------------------------------------------------------------------- helpers

def finalize(df: DataFrame) -> DataFrame:
    """Comparable output: date -> string, double -> round 6, int -> bigint."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        t = f.dataType
        if isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.DoubleType, T.FloatType)):
            c = round_to(c, 6)
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_panel(spark, sf_dir)


def fixed_score() -> Column:
    z = F.lit(P.FIXED_INTERCEPT)
    for name, b in P.FIXED_COEFS:
        z = z + F.lit(b) * F.coalesce(F.col(name), F.lit(0.0))
    return round_to(sigmoid(z), 6)


FIXED_SCORE_SQL = "round(1.0 / (1.0 + exp(-({z}))), 6)".format(
    z=" + ".join([f"({P.FIXED_INTERCEPT})::DOUBLE"]
                 + [f"({b})::DOUBLE * coalesce({n}, 0.0::DOUBLE)" for n, b in P.FIXED_COEFS]))


def scan_sql(date_min: str, date_max: str, min_eff: int = 10, outcome: bool | None = None,
             extra: str = "", cols: str = "*", src: str = "panel") -> str:
    oc = "outcome IS NOT NULL" if outcome is None else f"outcome = {str(outcome).lower()}"
    return (f"SELECT {cols} FROM {src} WHERE random_order >= 0 AND periode >= DATE '{date_min}' "
            f"AND periode < DATE '{date_max}' AND effectif >= {min_eff} AND {oc} {extra}")


TRAIN = DatasetSpec(date_min=P.TRAIN_FROM, date_max=P.TRAIN_TO, sample_size=None)
TEST = DatasetSpec(date_min=P.TEST_FROM, date_max=P.TEST_TO, sample_size=None)
PREDICT = DatasetSpec(date_min=P.PREDICT_ON, date_max=month_window_end(P.PREDICT_ON), sample_size=None)

#: every period of the panel
ALL_FROM, ALL_TO = "1970-01-01", "3000-01-01"
WHOLE = DatasetSpec(date_min=ALL_FROM, date_max=ALL_TO, sample_size=None)

KEY_FIELDS = ("siret", "siren", "periode")


# --------------------------------------------------------------------------- S1, F1-F9

@register("scan_period_effectif", with_panel(
    scan_sql(P.TRAIN_FROM, P.TRAIN_TO,
             cols="siret, siren, strftime(periode, '%Y-%m-%d') AS periode, round(effectif, 6) AS effectif, "
                  "outcome, round(random_order, 6) AS random_order")))
def q_scan_period_effectif(spark, sf):
    spec = TRAIN.with_(fields=("siret", "siren", "periode", "effectif", "outcome", "random_order"))
    return finalize(fetch(panel(spark, sf), spec))


@register("filter_ids", with_panel(
    scan_sql(P.TRAIN_FROM, P.TEST_TO,
             extra="AND siret IN (SELECT lpad(CAST(c_custkey // 3 AS VARCHAR), 9, '0') || "
                   "lpad(CAST(c_custkey % 3 AS VARCHAR), 5, '0') FROM customer WHERE c_mktsegment = 'AUTOMOBILE') "
                   "AND siren IN (SELECT lpad(CAST(c_custkey // 3 AS VARCHAR), 9, '0') FROM customer "
                   "WHERE c_nationkey < 15)",
             cols="siret, siren, strftime(periode, '%Y-%m-%d') AS periode")))
def q_filter_ids(spark, sf):
    cust = read_table(spark, sf, "customer")
    siren = F.lpad(F.floor(F.col("c_custkey") / 3).cast("string"), 9, "0")
    sirets = cust.filter(F.col("c_mktsegment") == "AUTOMOBILE").select(
        F.concat(siren, F.lpad((F.col("c_custkey") % 3).cast("string"), 5, "0")).alias("siret"))
    sirens = cust.filter(F.col("c_nationkey") < 15).select(siren.alias("siren"))
    spec = DatasetSpec(date_min=P.TRAIN_FROM, date_max=P.TEST_TO, sample_size=None,
                       sirets=sirets, sirens=sirens, fields=KEY_FIELDS)
    return finalize(fetch(panel(spark, sf), spec))


@register("filter_categorical", with_panel(
    scan_sql(P.TRAIN_FROM, P.TEST_TO,
             extra="AND code_naf IN ('A', 'B', 'C', 'D', 'E') AND region = 'EUROPE'",
             cols="siret, siren, strftime(periode, '%Y-%m-%d') AS periode, code_naf, region")))
def q_filter_categorical(spark, sf):
    spec = DatasetSpec(date_min=P.TRAIN_FROM, date_max=P.TEST_TO, sample_size=None,
                       categorical_filters={"code_naf": ["A", "B", "C", "D", "E"], "region": "EUROPE",
                                            "ignored": {"not": "a filter"}},
                       fields=KEY_FIELDS + ("code_naf", "region"))
    return finalize(fetch(panel(spark, sf), spec))


@register("filter_outcome", with_panel(
    scan_sql(P.TRAIN_FROM, P.TEST_TO, outcome=True, min_eff=20,
             cols="siret, siren, strftime(periode, '%Y-%m-%d') AS periode, outcome, time_til_outcome::BIGINT AS time_til_outcome")))
def q_filter_outcome(spark, sf):
    spec = DatasetSpec(date_min=P.TRAIN_FROM, date_max=P.TEST_TO, sample_size=None, outcome=True,
                       min_effectif=20, fields=KEY_FIELDS + ("outcome", "time_til_outcome"))
    return finalize(fetch(panel(spark, sf), spec))


@register("project_missing_fields", with_panel(
    scan_sql(ALL_FROM, ALL_TO,
             cols="siret, strftime(periode, '%Y-%m-%d') AS periode, round(ratio_dette, 6) AS ratio_dette, "
                  "CAST(NULL AS DOUBLE) AS effectif_ent, CAST(NULL AS BOOLEAN) AS tag_debit")))
def q_project_missing_fields(spark, sf):
    spec = WHOLE.with_(fields=("siret", "periode", "ratio_dette", "effectif_ent", "tag_debit"))
    return finalize(fetch(panel(spark, sf), spec))


@register("pad_ids", with_panel(
    "SELECT CAST(CAST(siret AS BIGINT) AS VARCHAR) AS siret_raw, "
    "CASE WHEN length(CAST(CAST(siret AS BIGINT) AS VARCHAR)) < 14 "
    "     THEN lpad(CAST(CAST(siret AS BIGINT) AS VARCHAR), 14, '0') ELSE CAST(CAST(siret AS BIGINT) AS VARCHAR) END AS siret, "
    "CASE WHEN length(CAST(CAST(siren AS BIGINT) AS VARCHAR)) < 9 "
    "     THEN lpad(CAST(CAST(siren AS BIGINT) AS VARCHAR), 9, '0') ELSE CAST(CAST(siren AS BIGINT) AS VARCHAR) END AS siren, "
    "strftime(periode, '%Y-%m-%d') AS periode FROM panel"))
def q_pad_ids(spark, sf):
    """F9 on ids that lost their leading zeros (as after a numeric CSV read)."""
    raw = panel(spark, sf).select(
        F.col("siret").cast("long").cast("string").alias("siret_raw"),
        F.col("siret").cast("long").alias("siret"), F.col("siren").cast("long").alias("siren"), "periode")
    return finalize(raw.withColumn("siret", pad_id("siret", 14)).withColumn("siren", pad_id("siren", 9)))


# --------------------------------------------------------------------------- O1-O3, O5, O6, U1

@register("sample_topk", with_panel(
    scan_sql(P.TRAIN_FROM, P.TEST_TO,
             cols="siret, strftime(periode, '%Y-%m-%d') AS periode, round(random_order, 6) AS random_order",
             extra=f"ORDER BY random_order DESC, siret, periode LIMIT {P.SAMPLE_N}")))
def q_sample_topk(spark, sf):
    spec = DatasetSpec(date_min=P.TRAIN_FROM, date_max=P.TEST_TO, sample_size=P.SAMPLE_N,
                       fields=("siret", "periode", "random_order"))
    return finalize(fetch(panel(spark, sf), spec))


_N_TRUE = round(P.QUOTA_P * P.SAMPLE_N)
_N_FALSE = P.SAMPLE_N - _N_TRUE


@register("sample_quota", with_panel(
    "SELECT * FROM (" + scan_sql(P.TRAIN_FROM, P.TRAIN_TO, outcome=True,
                                 cols="siret, strftime(periode, '%Y-%m-%d') AS periode, outcome",
                                 extra=f"ORDER BY random_order DESC, siret, periode LIMIT {_N_TRUE}") + ") "
    "UNION ALL SELECT * FROM (" + scan_sql(P.TRAIN_FROM, P.TRAIN_TO, outcome=False,
                                           cols="siret, strftime(periode, '%Y-%m-%d') AS periode, outcome",
                                           extra=f"ORDER BY random_order DESC, siret, periode LIMIT {_N_FALSE}")
    + ")"))
def q_sample_quota(spark, sf):
    spec = DatasetSpec(date_min=P.TRAIN_FROM, date_max=P.TRAIN_TO, sample_size=P.SAMPLE_N,
                       proportion_positive_class=P.QUOTA_P, fields=("siret", "periode", "outcome"))
    return finalize(fetch(panel(spark, sf), spec))


def _top_sql(n: int, outcome: bool, cols: str = "siret, strftime(periode, '%Y-%m-%d') AS periode, outcome") -> str:
    return "SELECT * FROM (" + scan_sql(ALL_FROM, ALL_TO, outcome=outcome, cols=cols,
                                        extra=f"ORDER BY random_order DESC, siret, periode LIMIT {n}") + ")"


_LARGE_TRUE, _LARGE_FALSE = quota_sizes(P.LARGE_SAMPLE_N, P.QUOTA_P)


@register("sample_quota_cut", with_panel(_top_sql(_LARGE_TRUE, True) + " UNION ALL " + _top_sql(_LARGE_FALSE, False)))
def q_sample_quota_cut(spark, sf):
    """Quotas beyond what one task sorts: both classes by one histogram and ranks inside the last ranges."""
    return finalize(fetch(panel(spark, sf), WHOLE.with_(sample_size=P.LARGE_SAMPLE_N, proportion_positive_class=P.QUOTA_P,
                                                        fields=("siret", "periode", "outcome"))))


_HASH_SQL = ("CAST(('0x' || substr(md5({k}), 1, 8)) AS BIGINT)::DOUBLE / 4294967296.0::DOUBLE")
ROW_HASH_SQL = _HASH_SQL.format(k="siret || '|' || CAST(periode AS VARCHAR) || '|' || '{seed}'")


@register("sample_rows", with_panel(
    "SELECT siret, strftime(periode, '%Y-%m-%d') AS periode FROM panel "
    f"ORDER BY {ROW_HASH_SQL.format(seed=P.SEED)}, siret, periode LIMIT 500"))
def q_sample_rows(spark, sf):
    return finalize(sample_rows(panel(spark, sf).select("siret", "periode"), 500, seed=P.SEED))


@register("sample_rows_cut", with_panel(
    "SELECT siret, strftime(periode, '%Y-%m-%d') AS periode FROM panel "
    f"ORDER BY {ROW_HASH_SQL.format(seed=P.SEED)}, siret, periode LIMIT {P.LARGE_SAMPLE_N}"))
def q_sample_rows_cut(spark, sf):
    return finalize(sample_rows(panel(spark, sf).select("siret", "periode"), P.LARGE_SAMPLE_N, seed=P.SEED))


@register("split_train_test", with_panel(
    "SELECT siret, strftime(periode, '%Y-%m-%d') AS periode, "
    f"CASE WHEN {ROW_HASH_SQL.format(seed=42)} < 0.67 THEN 'train' ELSE 'test' END AS split FROM panel"))
def q_split_train_test(spark, sf):
    return finalize(panel(spark, sf).select("siret", "periode", split_column(0.67, 42).alias("split")))


# --------------------------------------------------------------------------- F10-F14

_ALL = scan_sql(ALL_FROM, ALL_TO)


@register("clean_strong_signals", with_panel(
    f"SELECT siret, strftime(periode, '%Y-%m-%d') AS periode, time_til_outcome::BIGINT AS time_til_outcome "
    f"FROM ({_ALL}) WHERE NOT coalesce(time_til_outcome <= 0, false)"))
def q_clean_strong_signals(spark, sf):
    df = fetch(panel(spark, sf), WHOLE)
    return finalize(clean.remove_strong_signals(df).select("siret", "periode", "time_til_outcome"))


_FILL_COLS = ("montant_part_ouvriere", "montant_part_patronale", "montant_part_ouvriere_past_3",
              "apart_heures_consommees", "paydex_nb_jours")


@register("clean_fill", with_panel(
    "SELECT siret, strftime(periode, '%Y-%m-%d') AS periode, "
    "round(coalesce(montant_part_ouvriere, 0.0), 6) AS montant_part_ouvriere, "
    "round(coalesce(montant_part_patronale, 0.0), 6) AS montant_part_patronale, "
    "round(coalesce(montant_part_ouvriere_past_3, 0.0), 6) AS montant_part_ouvriere_past_3, "
    "round(coalesce(apart_heures_consommees, 0.0), 6) AS apart_heures_consommees, "
    "round(paydex_nb_jours, 6) AS paydex_nb_jours "
    f"FROM ({_ALL})"))
def q_clean_fill(spark, sf):
    df = fetch(panel(spark, sf), WHOLE.with_(fields=("siret", "periode") + _FILL_COLS))
    return finalize(clean.replace_missing_data(df))


@register("clean_drop_na", with_panel(
    "SELECT siret, strftime(periode, '%Y-%m-%d') AS periode, code_naf, time_til_outcome::BIGINT AS time_til_outcome, "
    "round(paydex_nb_jours, 6) AS paydex_nb_jours, round(coalesce(montant_part_ouvriere, 0.0), 6) AS montant_part_ouvriere "
    f"FROM ({_ALL}) WHERE paydex_nb_jours IS NOT NULL AND effectif IS NOT NULL"))
def q_clean_drop_na(spark, sf):
    df = fetch(panel(spark, sf), WHOLE.with_(
        fields=("siret", "periode", "code_naf", "time_til_outcome", "paydex_nb_jours", "montant_part_ouvriere",
                "effectif")))
    out = clean.remove_na(clean.replace_missing_data(df), IGNORE_NA)
    return finalize(out.drop("effectif"))


@register("remove_administrations", with_panel(
    "SELECT siret, strftime(periode, '%Y-%m-%d') AS periode, code_naf FROM panel "
    "WHERE NOT coalesce(code_naf IN ('O', 'P'), false)"))
def q_remove_administrations(spark, sf):
    return finalize(clean.remove_administrations(panel(spark, sf).select("siret", "periode", "code_naf")))


@register("paydex_yoy", with_panel(
    "SELECT siret, strftime(periode, '%Y-%m-%d') AS periode, "
    "round(paydex_nb_jours - paydex_nb_jours_past_12, 6) AS paydex_yoy FROM panel"))
def q_paydex_yoy(spark, sf):
    from vigie.functions.features import paydex_yoy
    return finalize(panel(spark, sf).select("siret", "periode", paydex_yoy().alias("paydex_yoy")))


PAYDEX_GROUP_SQL = (
    "CASE WHEN paydex_nb_jours IS NULL OR paydex_nb_jours = '-inf'::DOUBLE THEN NULL "
    "WHEN paydex_nb_jours <= 0 THEN '(-inf, 0.0]' WHEN paydex_nb_jours <= 15 THEN '(0.0, 15.0]' "
    "WHEN paydex_nb_jours <= 30 THEN '(15.0, 30.0]' WHEN paydex_nb_jours <= 60 THEN '(30.0, 60.0]' "
    "WHEN paydex_nb_jours <= 90 THEN '(60.0, 90.0]' ELSE '(90.0, inf]' END")


@register("paydex_group", with_panel(
    f"SELECT siret, strftime(periode, '%Y-%m-%d') AS periode, {PAYDEX_GROUP_SQL} AS paydex_group FROM panel"))
def q_paydex_group(spark, sf):
    from vigie.functions.features import paydex_group
    return finalize(panel(spark, sf).select("siret", "periode", paydex_group().alias("paydex_group")))


DEBT_DELTA_SQL = (
    "((coalesce((montant_part_ouvriere + montant_part_patronale) / NULLIF(effectif, 0), 0.0) "
    "- coalesce((montant_part_ouvriere_past_3 + montant_part_patronale_past_3) / NULLIF(effectif, 0), 0.0)) / 3.0)")


@register("debt_per_head_delta", with_panel(
    "SELECT siret, strftime(periode, '%Y-%m-%d') AS periode, "
    f"round({DEBT_DELTA_SQL}, 6) AS avg_delta_dette_par_effectif FROM panel"))
def q_debt_per_head_delta(spark, sf):
    from vigie.functions.features import debt_per_head_delta
    return finalize(panel(spark, sf).select("siret", "periode",
                                            debt_per_head_delta().alias("avg_delta_dette_par_effectif")))


# --------------------------------------------------------------------------- P1-P3

def _prepared(spark, sf, spec: DatasetSpec, steps=DEFAULT_PIPELINE, strong=False) -> DataFrame:
    df = fetch(panel(spark, sf), spec)
    df = clean.remove_na(clean.replace_missing_data(df), IGNORE_NA)
    if strong:
        df = clean.remove_strong_signals(df)
    return run_pipeline(df, steps)


_PIPE_FIELDS = ("siret", "siren", "periode", "outcome", "time_til_outcome", "code_naf", "effectif",
                "montant_part_ouvriere", "montant_part_patronale", "montant_part_ouvriere_past_3",
                "montant_part_patronale_past_3", "paydex_nb_jours", "paydex_nb_jours_past_12")


def _clean_sql(date_min, date_max, cols: str) -> str:
    """fill (defaults of the listed columns) + drop-na on the listed columns."""
    return (
        "SELECT siret, siren, periode, outcome, time_til_outcome, code_naf, "
        "coalesce(effectif, 0.0) AS effectif, coalesce(montant_part_ouvriere, 0.0) AS montant_part_ouvriere, "
        "coalesce(montant_part_patronale, 0.0) AS montant_part_patronale, "
        "coalesce(montant_part_ouvriere_past_3, 0.0) AS montant_part_ouvriere_past_3, "
        "coalesce(montant_part_patronale_past_3, 0.0) AS montant_part_patronale_past_3, "
        f"paydex_nb_jours, paydex_nb_jours_past_12 FROM ({scan_sql(date_min, date_max)}) "
        f"WHERE {cols}")


@register("pipeline_default", with_panel(
    "SELECT siret, siren, strftime(periode, '%Y-%m-%d') AS periode, outcome, code_naf, "
    "round(paydex_nb_jours - paydex_nb_jours_past_12, 6) AS paydex_yoy, "
    f"{PAYDEX_GROUP_SQL} AS paydex_group, round({DEBT_DELTA_SQL}, 6) AS avg_delta_dette_par_effectif "
    "FROM (" + _clean_sql(ALL_FROM, ALL_TO,
                          "paydex_nb_jours IS NOT NULL AND paydex_nb_jours_past_12 IS NOT NULL") + ") "
    "WHERE NOT coalesce(code_naf IN ('O', 'P'), false)"))
def q_pipeline_default(spark, sf):
    spec = WHOLE.with_(fields=_PIPE_FIELDS)
    out = _prepared(spark, sf, spec, DEFAULT_PIPELINE)
    return finalize(out.select("siret", "siren", "periode", "outcome", "code_naf", "paydex_yoy",
                               "paydex_group", "avg_delta_dette_par_effectif"))


@register("pipeline_small", with_panel(
    "SELECT siret, siren, strftime(periode, '%Y-%m-%d') AS periode, outcome, code_naf, "
    f"round({DEBT_DELTA_SQL}, 6) AS avg_delta_dette_par_effectif "
    "FROM (" + _clean_sql(ALL_FROM, ALL_TO,
                          "paydex_nb_jours IS NOT NULL AND paydex_nb_jours_past_12 IS NOT NULL") + ") "
    "WHERE NOT coalesce(code_naf IN ('O', 'P'), false)"))
def q_pipeline_small(spark, sf):
    spec = WHOLE.with_(fields=_PIPE_FIELDS)
    out = _prepared(spark, sf, spec, SMALL_PIPELINE)
    return finalize(out.select("siret", "siren", "periode", "outcome", "code_naf",
                               "avg_delta_dette_par_effectif"))


# --------------------------------------------------------------------------- flagship (M0)

@register("paydex_outcome_summary", with_panel(
    "SELECT paydex_group, outcome, count(*) AS n_rows, round(avg(avg_delta_dette_par_effectif), 6) AS mean_delta "
    "FROM (SELECT outcome, " + PAYDEX_GROUP_SQL + " AS paydex_group, " + DEBT_DELTA_SQL +
    " AS avg_delta_dette_par_effectif FROM (" + _clean_sql(
        ALL_FROM, ALL_TO, "paydex_nb_jours IS NOT NULL AND paydex_nb_jours_past_12 IS NOT NULL") +
    ") WHERE NOT coalesce(code_naf IN ('O', 'P'), false)) GROUP BY paydex_group, outcome"))
def q_paydex_outcome_summary(spark, sf):
    """Flagship: scan -> clean -> default pipeline -> count and mean debt change
    per (payment-delay group, outcome)."""
    spec = WHOLE.with_(fields=_PIPE_FIELDS)
    out = _prepared(spark, sf, spec, DEFAULT_PIPELINE)
    return finalize(out.groupBy("paydex_group", "outcome").agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg("avg_delta_dette_par_effectif").alias("mean_delta")))


# Further registrations live in sibling modules; importing them fills QUERIES/ORACLE.
from vigie.plans import catalog_scores  # noqa: E402,F401
from vigie.plans import catalog_model  # noqa: E402,F401
from vigie.plans import catalog_store  # noqa: E402,F401
