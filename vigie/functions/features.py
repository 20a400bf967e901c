"""Column expressions: feature recipes, id padding, flags.  All JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (labels must equal the reference's) ------------------------
# Right-closed payment-delay bins (-inf,0], (0,15], (15,30], (30,60], (60,90], (90,inf].
PAYDEX_BIN_EDGES = (0.0, 15.0, 30.0, 60.0, 90.0)
PAYDEX_LABELS = (
    "(-inf, 0.0]",
    "(0.0, 15.0]",
    "(15.0, 30.0]",
    "(30.0, 60.0]",
    "(60.0, 90.0]",
    "(90.0, inf]",
)
FLAG_RED = "Alerte seuil F1"
FLAG_ORANGE = "Alerte seuil F2"
FLAG_NONE = "Pas d'alerte"
# --- end of fixed values -------------------------------------------------------


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_to(c: str | Column, digits: int) -> Column:
    """Round half away from zero on the binary value: ``round(x * 10^d) / 10^d``.

    Spark's ``round(x, d)`` rounds the shortest decimal text of ``x`` (so
    0.285 -> 0.29 although the double is below 0.285); rounding to an integer
    has no such ambiguity, which makes this form agree with other engines.
    """
    m = float(10 ** digits)
    return F.round(col(c) * F.lit(m)) / F.lit(m)


def nan_to_null(c: str | Column) -> Column:
    """Normalise NaN to null (the engine keeps a single notion of missing)."""
    c = col(c)
    return F.when(~F.isnan(c), c)


def pad_id(c: str | Column, width: int) -> Column:
    """Left-pad an id with zeros to ``width`` without ever truncating it;
    null stays null."""
    s = col(c).cast("string")
    return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)


def paydex_yoy(current: str = "paydex_nb_jours", past: str = "paydex_nb_jours_past_12") -> Column:
    return F.col(current) - F.col(past)


def paydex_group(c: str | Column = "paydex_nb_jours") -> Column:
    """Right-closed bin label; null and -inf give null."""
    x = col(c)
    expr = F.when(x.isNull() | (x == float("-inf")), F.lit(None).cast("string"))
    for edge, label in zip(PAYDEX_BIN_EDGES, PAYDEX_LABELS):
        expr = expr.when(x <= edge, label)
    return expr.otherwise(PAYDEX_LABELS[-1])


def _ratio_or_zero(num: Column, den: Column) -> Column:
    # pandas: x / 0 -> ±inf or NaN, then replaced by 0; null operands -> 0.
    return F.coalesce(F.try_divide(num, den), F.lit(0.0))


def debt_per_head_delta(
    staff: str = "effectif",
    workers: str = "montant_part_ouvriere",
    employer: str = "montant_part_patronale",
    workers_past: str = "montant_part_ouvriere_past_3",
    employer_past: str = "montant_part_patronale_past_3",
) -> Column:
    """((o+p)/e - (o3+p3)/e) / 3 with every undefined ratio set to 0."""
    e = F.col(staff).cast("double")
    now = _ratio_or_zero(F.col(workers) + F.col(employer), e)
    past = _ratio_or_zero(F.col(workers_past) + F.col(employer_past), e)
    return (now - past) / 3.0


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def check_flag_thresholds(t_rouge: float, t_orange: float) -> None:
    if not 0 <= t_rouge <= 1:
        raise ValueError(f"red threshold outside [0, 1]: {t_rouge}")
    if not 0 <= t_orange <= 1:
        raise ValueError(f"orange threshold outside [0, 1]: {t_orange}")
    if t_orange > t_rouge:
        raise ValueError(f"the red threshold {t_rouge} is below the orange one {t_orange}")


def assign_flag(pred: str | Column, t_rouge: float, t_orange: float) -> Column:
    """Three alert levels, strict ``>``; a missing score gives no alert."""
    check_flag_thresholds(t_rouge, t_orange)
    p = col(pred)
    return (F.when(p > F.lit(float(t_rouge)), FLAG_RED)
            .when(p > F.lit(float(t_orange)), FLAG_ORANGE)
            .otherwise(FLAG_NONE))
