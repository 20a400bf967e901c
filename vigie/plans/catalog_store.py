"""Registered queries on stored states and files: merged curves, quarantine, typed exports, publication."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigie.operators import clean, curves, metrics
from vigie.operators.adjust import attach_debt_snapshots
from vigie.operators.dataset import fetch
from vigie.operators.split import exclude_train_firms
from vigie.plans import params as P
from vigie.plans.catalog import (ALL_FROM, ALL_TO, FIXED_SCORE_SQL, KEY_FIELDS, ORACLE, PREDICT, TEST, TRAIN, WHOLE, finalize, fixed_score, panel,
                                 register, scan_sql)
from vigie.plans.catalog_scores import _TRAIN_FIELDS as TRAIN_FIELDS
from vigie.plans.catalog_scores import CURVE_CTES, SCORED_CTE, scored
from vigie.plans.catalog_scores import _predict_scored as predict_scored
from vigie.plans.oracle_panel import with_panel
from vigie.plans.pipeline import DEFAULT_PIPELINE, run_pipeline
from vigie.schema import IGNORE_NA
from vigie.session import checkpoint_dir
from vigie.sources import io
from vigie.sources.bucketed import bucketed_table
from vigie.sources.exports import read_export
from vigie.sources.publish import Publication
from vigie.sources.quarantine import read_checked, siret_rules


def _folder(spark, tag: str) -> str:
    return f"{checkpoint_dir(spark)}/{tag}/{uuid.uuid4().hex}"


# ---- A8-A11, W3: states by month

def _stored_states(spark, sf) -> curves.StateStore:
    """States put in two parts; the months of the second are put twice, first with half of their rows."""
    rows, store = scored(spark, sf), curves.StateStore(spark, _folder(spark, "curve-states"))
    old, new = F.col("periode") < F.lit(P.TEST_FROM).cast("date"), F.col("periode") >= F.lit(P.TEST_FROM).cast("date")
    store.put(curves.month_states(rows.where(old)))
    part = F.col("siret").endswith("1")
    half = curves.month_states(rows.where(new & part))
    store.put(half)
    store.put(curves.merge_states(half, curves.month_states(rows.where(new & ~part))))
    return store


@register("curve_states", with_panel(
    "SELECT strftime(periode, '%Y-%m-%d') AS periode, round(score, 6) AS threshold, sum(CASE WHEN outcome THEN 1 ELSE 0 END)::BIGINT AS tp_at, "
    "sum(CASE WHEN outcome THEN 0 ELSE 1 END)::BIGINT AS fp_at FROM scored GROUP BY periode, score", SCORED_CTE))
def q_curve_states(spark, sf):
    return finalize(_stored_states(spark, sf).read())


_SOME_MONTHS = "scored AS (" + scan_sql(P.RANGE_FROM, P.RANGE_TO, cols=f"siret, siren, periode, outcome, {FIXED_SCORE_SQL} AS score") + ")"


@register("curve_of_months", with_panel(
    "SELECT round(threshold, 6) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall, "
    "round((SELECT average_precision FROM ap), 6) AS average_precision FROM curve", _SOME_MONTHS, *CURVE_CTES))
def q_curve_of_months(spark, sf):
    """Curve and average precision of a range of months from their states."""
    table = curves.curve_table(_stored_states(spark, sf).read(), P.RANGE_FROM, P.RANGE_TO)
    ap = metrics.average_precision_of(table).scalar()
    return finalize(metrics.curve_of(table).select("*", ap.alias("average_precision")))


# ---- S3, S5: broken lines

@register("files_quarantine", with_panel(
    "SELECT 'good' AS kind, siret, strftime(periode, '%Y-%m-%d') AS periode, round(effectif, 6) AS effectif, CAST(NULL AS VARCHAR) AS reasons "
    "FROM panel WHERE siret LIKE '%0' UNION ALL "
    "SELECT 'broken', siret, NULL, NULL, CASE WHEN siret LIKE '%1' THEN 'wrong number of fields' "
    "WHEN effectif IS NULL THEN 'siret is longer than 14' ELSE 'effectif is not a double; siret is longer than 14' END "
    "FROM panel WHERE siret NOT LIKE '%0'"))
def q_files_quarantine(spark, sf):
    """Lines that lack a field, or hold a wrong number and a siret that is too long."""
    s, path = F.col("siret"), _folder(spark, "lines")
    number = F.when(s.endswith("2"), F.concat(F.col("effectif").cast("string"), F.lit(" persons"))).otherwise(F.col("effectif").cast("string"))
    ident = F.when(s.endswith("2"), F.concat(s, F.lit("99"))).otherwise(s)
    whole = F.concat_ws(",", ident, "siren", F.col("periode").cast("string"), F.coalesce(number, F.lit("")))
    short = F.concat_ws(",", s, "siren", F.col("periode").cast("string"))
    panel(spark, sf).select(F.when(s.endswith("1"), short).otherwise(whole).alias("value")).write.text(path)
    kinds = {"siret": T.StringType(), "siren": T.StringType(), "periode": T.DateType(), "effectif": T.DoubleType()}
    found = read_checked(spark, path, kinds, header=False, rules=siret_rules())
    good = found.good.select(F.lit("good").alias("kind"), "siret", "periode", "effectif", F.lit(None).cast("string").alias("reasons"))
    broken = found.broken.select(F.lit("broken").alias("kind"), F.substring(F.substring_index("line", ",", 1), 1, 14).alias("siret"),
                                 F.lit(None).cast("date").alias("periode"), F.lit(None).cast("double").alias("effectif"),
                                 F.array_join("reasons", "; ").alias("reasons"))
    return finalize(good.unionByName(broken))


# ---- S1, S2: the store's typed export

@register("scan_export", with_panel(
    scan_sql(ALL_FROM, ALL_TO, cols="siret, siren, strftime(periode, '%Y-%m-%d') AS periode, round(effectif, 6) AS effectif, "
             "time_til_outcome::BIGINT AS time_til_outcome, outcome, round(effectif, 6) AS amount_0, round(cotisation, 6) AS amount_1",
             extra="AND siret NOT LIKE '%1'")))
def q_scan_export(spark, sf):
    """Records with wrapped dates and numbers, alone, in arrays, and NaN as staff of some."""
    wrap = lambda name, c: F.when(c.isNotNull(), F.struct(c.cast("string").alias(name)))
    staff = F.when(F.col("siret").endswith("1"), F.lit("NaN")).otherwise(F.col("effectif").cast("string"))
    value = F.struct(
        "siret", "siren", "outcome", "random_order", wrap("$date", F.concat(F.col("periode").cast("string"), F.lit("T00:00:00Z"))).alias("periode"),
        wrap("$numberDouble", staff).alias("effectif"), wrap("$numberInt", F.col("time_til_outcome")).alias("time_til_outcome"),
        F.array(wrap("$numberDouble", F.col("effectif")), wrap("$numberDouble", F.col("cotisation"))).alias("amounts"))
    path = _folder(spark, "export")
    panel(spark, sf).select(F.to_json(F.struct(F.struct(F.md5("siret").alias("$oid")).alias("_id"), value.alias("value"))).alias("value")).write.text(path)
    fields = ("siret", "siren", "periode", "effectif", "time_til_outcome", "outcome", "amounts")
    rows = fetch(read_export(spark, path), WHOLE.with_(fields=fields))
    return finalize(rows.select(*fields[:-1], *[F.get("amounts", F.lit(i)).alias(f"amount_{i}") for i in range(2)]))


# ---- S6, S7, S11, P14: runs that readers see

@register("run_publication", with_panel(
    " UNION ALL ".join(f"SELECT '{run}' AS run, siret, siren, {FIXED_SCORE_SQL} AS predicted_probability FROM month WHERE siret {which}"
                       for run, which in (("monthly", "NOT LIKE '%0'"), ("check", "LIKE '%0'"))),
    "month AS (" + scan_sql(PREDICT.date_min, PREDICT.date_max) + ")"))
def q_run_publication(spark, sf):
    """A run published twice, one that never got its manifest, and a further one."""
    rows = fetch(panel(spark, sf), PREDICT).select("siren", "siret", fixed_score().alias("predicted_probability"))
    publication = Publication(spark, _folder(spark, "published"))
    zero = F.col("siret").endswith("0")
    for run, part, finished in (("monthly", rows, True), ("killed", rows, False), ("monthly", rows.where(~zero), True), ("check", rows.where(zero), True)):
        path = publication.stage(run)
        io.write_predictions(part, f"{path}/predictions")
        if finished:
            publication.commit(run, path)
    read = [io.read_predictions(spark, f"{path}/predictions").select(F.lit(run).alias("run"), "siret", "siren", "predicted_probability")
            for run, path in publication.runs().items() if publication.verify(run)]
    return finalize(reduce(DataFrame.unionByName, read))


# ---- J1, J2: the panel stored by firm, and by establishment

@register("bucketed_exclude", ORACLE["exclude_train_firms"])
def q_bucketed_exclude(spark, sf):
    """Test rows of firms not seen in training, from a panel stored by firm: neither side is dealt again."""
    rows = bucketed_table(panel(spark, sf), "siren")
    train = clean.remove_na(clean.replace_missing_data(fetch(rows, TRAIN.with_(fields=TRAIN_FIELDS))), IGNORE_NA)
    return finalize(exclude_train_firms(fetch(rows, TEST.with_(fields=KEY_FIELDS)), run_pipeline(train, DEFAULT_PIPELINE)))


@register("bucketed_snapshots", ORACLE["debt_snapshots"])
def q_bucketed_snapshots(spark, sf):
    """Debt snapshots joined to rows stored by establishment."""
    rows = bucketed_table(predict_scored(spark, sf), "siret")
    return finalize(attach_debt_snapshots(rows, panel(spark, sf), P.JULY_SNAPSHOT, P.LATEST_SNAPSHOT))
