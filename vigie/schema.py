"""Panel vocabulary: key columns, default fill values, columns allowed to stay null.

The panel is keyed by (siret, periode): one establishment, one month.  ``siren``
(the firm) is the first nine characters of ``siret``.  Missing data is null only
(NaN is normalised to null where data enter).
"""

from __future__ import annotations

from pyspark.sql import types as T

KEYS = ("siret", "periode")

# --- fixed values (must equal the reference's configuration) -----------------
# Default fill values per column: booleans -> False, social debt and
# short-time-work hours -> 0.0, staff -> 0.
DEFAULT_DATA_VALUES = {
    "tag_debit": False,
    "tag_default": False,
    "montant_part_ouvriere_past_12": 0.0,
    "montant_part_patronale_past_12": 0.0,
    "montant_part_ouvriere_past_6": 0.0,
    "montant_part_patronale_past_6": 0.0,
    "montant_part_ouvriere_past_3": 0.0,
    "montant_part_patronale_past_3": 0.0,
    "montant_part_ouvriere_past_2": 0.0,
    "montant_part_patronale_past_2": 0.0,
    "montant_part_ouvriere_past_1": 0.0,
    "montant_part_patronale_past_1": 0.0,
    "cotisation": 0.0,
    "montant_part_ouvriere": 0.0,
    "montant_part_patronale": 0.0,
    "cotisation_moy12m": 0.0,
    "ratio_dette": 0.0,
    "ratio_dette_moy12m": 0.0,
    "apart_heures_autorisees": 0.0,
    "apart_heures_consommees_cumulees": 0.0,
    "apart_heures_consommees": 0.0,
    "effectif": 0,
    "effectif_ent": 0,
}
# Columns whose nulls are tolerated when incomplete rows are dropped.
IGNORE_NA = ["time_til_outcome", "code_naf"]
# Minimum staff of a scanned row when the caller gives none (module default).
MIN_EFFECTIF = 10
# --- end of fixed values -------------------------------------------------------

DEBT_LAGS = (1, 2, 3, 6, 12)

# --- fixed values (the reference's financial ratios) ---------------------------
FINANCIAL_RATIOS = [
    "financier_court_terme",
    "interets",
    "ca",
    "equilibre_financier",
    "endettement",
    "degre_immo_corporelle",
    "liquidite_reduite",
    "poids_bfr_exploitation",
    "productivite_capital_investi",
    "rentabilite_economique",
    "rentabilite_nette",
]
# --- end of fixed values -------------------------------------------------------

DEBT_COLUMNS = (
    ["cotisation", "cotisation_moy12m", "montant_part_ouvriere"]
    + [f"montant_part_ouvriere_past_{k}" for k in DEBT_LAGS]
    + ["montant_part_patronale"]
    + [f"montant_part_patronale_past_{k}" for k in DEBT_LAGS]
    + ["ratio_dette", "ratio_dette_moy12m"]
)

# Column order of the panel table.
PANEL_COLUMNS = (
    ["siret", "siren", "periode", "random_order", "outcome", "time_til_outcome",
     "effectif", "code_naf", "code_ape_niveau3", "region"]
    + FINANCIAL_RATIOS
    + DEBT_COLUMNS
    + ["apart_heures_consommees", "apart_heures_consommees_cumulees",
       "paydex_nb_jours", "paydex_nb_jours_past_12"]
)

_STRING = {"siret", "siren", "code_naf", "code_ape_niveau3", "region"}


def panel_type(column: str) -> T.DataType:
    """Spark type of a panel column (numerics are double, see SURVEY §1.3)."""
    if column in _STRING:
        return T.StringType()
    if column == "periode":
        return T.DateType()
    if column == "outcome":
        return T.BooleanType()
    if column == "time_til_outcome":
        return T.IntegerType()
    if column in ("tag_debit", "tag_default"):
        return T.BooleanType()
    return T.DoubleType()


PANEL_SCHEMA = T.StructType([T.StructField(c, panel_type(c), True) for c in PANEL_COLUMNS])
