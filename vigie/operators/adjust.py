"""Expert correction of alert levels by the change of social debt.

``attach_debt_snapshots`` left-joins two one-month snapshots of the panel (the
"July" month and the latest month) on (siret, siren).  Each snapshot is one narrow
month, written once; the pass that writes it counts its rows (none is an error) and
the rows per establishment (a second one is an error), so the joins never multiply
rows and read tables of known size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigie.operators.checks import Checks, require_rows
from vigie.operators.dataset import DatasetSpec, fetch, month_window_end

# --- fixed values (alert levels of the reference) ------------------------------
GREEN, ORANGE, RED = "vert", "orange", "rouge"
DEBT_TOLERANCE = 0.2
# --- end of fixed values -------------------------------------------------------

SNAPSHOT_COLUMNS = (
    "montant_part_ouvriere_latest",
    "montant_part_patronale_latest",
    "montant_part_ouvriere_july2020",
    "montant_part_patronale_july2020",
    "cotisation_moy12m_latest",
)


def snapshot(panel: DataFrame, month: str, date_max: str | None, columns: tuple[str, ...],
             suffix: str, sample_size: int | None = None) -> DataFrame:
    """One month of the panel through the standard scan, columns suffixed."""
    spec = DatasetSpec(date_min=month, date_max=date_max or month_window_end(month),
                       fields=("siren", "siret") + columns, sample_size=sample_size)
    checks = Checks()
    snap = checks.on(fetch(panel, spec), "fetched")
    named = [f"{c}{suffix}" for c in columns]
    once = snap.groupBy("siret", "siren").agg(F.count(F.lit(1)).alias("__n"), *[F.first(c).alias(n) for c, n in zip(columns, named)])
    table, noted = checks.written(checks.on(once, "firms", most=F.max("__n")).drop("__n"), "snapshot")
    require_rows(noted["fetched"]["rows"], f"snapshot of {month}")
    if noted["firms"]["most"] > 1:
        raise ValueError(f"an establishment occurs twice in the snapshot of {month}")
    return table


def _with_snapshot(df: DataFrame, snap: DataFrame) -> DataFrame:
    """Left join on siret and siren.  Only siret is a join key, so a table stored by siret is joined as it lies."""
    snap = snap.withColumnsRenamed({"siret": "__siret", "siren": "__siren"})
    same_firm = F.coalesce(df["siren"] == snap["__siren"], F.lit(False))
    return df.join(snap, (df["siret"] == snap["__siret"]) & same_firm, "left").drop("__siret", "__siren")


def attach_debt_snapshots(df: DataFrame, panel: DataFrame, july: str = "2020-07-01",
                          latest: str = "2021-01-01", sample_size: int | None = None) -> DataFrame:
    """``df`` + the five snapshot columns (left joins on siret, siren)."""
    july_snap = snapshot(panel, july, july[:-2] + "31",
                         ("montant_part_ouvriere", "montant_part_patronale"), "_july2020", sample_size)
    latest_snap = snapshot(panel, latest, None,
                           ("montant_part_ouvriere", "montant_part_patronale", "cotisation_moy12m"),
                           "_latest", sample_size)
    out = _with_snapshot(_with_snapshot(df, july_snap), latest_snap)
    return out.select(*df.columns, *SNAPSHOT_COLUMNS)


def apply_debt_rule(df: DataFrame, tol: float = DEBT_TOLERANCE, level: str = "group_final",
                    out: str = "group_final_regle_urssaf") -> DataFrame:
    """X4 + X5: raise the alert level by one when the debt grew by more than
    ``tol`` x the latest 12-month average contribution.

    Missing debts become 0 (also in the output).  ``delta_dette`` is null when the denominator is null or
    0; a zero denominator with a debt increase still escalates (as +inf would).
    """
    debts = [c for c in SNAPSHOT_COLUMNS if c.startswith("montant_part_")]
    df = df.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in debts})
    july = F.col("montant_part_ouvriere_july2020") + F.col("montant_part_patronale_july2020")
    latest = F.col("montant_part_ouvriere_latest") + F.col("montant_part_patronale_latest")
    den = F.col("cotisation_moy12m_latest")
    staged = df.withColumn("dette_sociale_july2020", july).withColumn("dette_sociale_latest", latest)
    num = F.col("dette_sociale_latest") - F.col("dette_sociale_july2020")
    staged = staged.withColumn("delta_dette", F.try_divide(num, den))
    up = (F.coalesce(F.col("delta_dette") > F.lit(float(tol)), F.lit(False))
          | F.coalesce((den == 0) & (num > 0), F.lit(False)))
    g = F.col(level)
    return staged.withColumn(
        out,
        F.when(up & (g == GREEN), F.lit(ORANGE)).when(up & g.isin(ORANGE, RED), F.lit(RED)).otherwise(g))


def adjust_pipeline(panel: DataFrame, july: str = "2020-07-01", latest: str = "2021-01-01",
                    sample_size: int | None = None):
    """The two adjustment steps (attach snapshots, apply the rule).

    The rule's inputs are made by the first step; ``run_pipeline`` accepts that
    because it checks inputs against earlier steps' outputs too.
    """
    from vigie.plans.pipeline import Step

    return (
        Step("Prepare debt adjustment",
             lambda df: attach_debt_snapshots(df, panel, july, latest, sample_size),
             ("siret", "siren"), SNAPSHOT_COLUMNS),
        Step("Debt adjustment since July", apply_debt_rule,
             SNAPSHOT_COLUMNS + ("group_final",), ("group_final_regle_urssaf",)),
    )
