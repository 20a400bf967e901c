"""Per-row explanation of a linear score by feature and feature group (P11-P13,
A13, O7, X7-X10).

For encoded column i with weight b_i and value x_i, the contribution is
``c_i = b_i * x_i``; the intercept b_0 is a contribution of a constant 1
(label ``model_offset``).  Four outputs per row:

* ``expl_selection``: features whose contribution is >= 4*thr (concerning,
  descending) or <= -4*thr (reassuring, ascending), offset excluded, the
  ``retards_paiement`` group collapsed into one entry;
* ``macro_radar``: per group, sigmoid of sum(c_i - b_0/(N+1)) (N encoded columns);
* ``macro_expl``: per group (offset included), sum(c_i) / (|b_0| + sum |b_j||x_j|);
* ``micro_expl``: the same per feature, ``retards_paiement`` collapsed.

Everything is a column expression over the row (arrays of structs, ``filter``,
``array_sort``, ``map_from_arrays``): no shuffle, no UDF, plan size linear in
the number of features.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigie.functions.features import sigmoid
from vigie.operators.model import OFFSET, LinearModel

COLLAPSED_GROUP = "retards_paiement"


def _sum(cols: list[Column]) -> Column:
    total = cols[0]
    for c in cols[1:]:
        total = total + c
    return total


def contribution_columns(model: LinearModel) -> list[tuple[str, str, str, Column]]:
    """[(group, encoded name, temp column name, b_i * x_i)] in encoded order."""
    return [(g, n, f"__c{i}", F.lit(float(model.coefs[n])) * e)
            for i, (g, n, e) in enumerate(model.encoded())]


def _entries(model: LinearModel, contr: list[tuple[str, str, str, Column]], scale: Column | None = None):
    """(group, feature, value) of the offset-free selection, collapsed group last."""
    collapse = COLLAPSED_GROUP in model.groups
    members = [F.col(t) for g, _, t, _ in contr if g == COLLAPSED_GROUP]
    out = []
    for g, n, t, _ in contr:
        if collapse and g == COLLAPSED_GROUP:
            continue
        v = F.col(t) if scale is None else F.col(t) / scale
        out.append((g, n, v))
    if collapse and members:
        v = _sum(members) if scale is None else _sum(members) / scale
        out.append((COLLAPSED_GROUP, COLLAPSED_GROUP, v))
    return out


def _sorted_names(entries, keep, descending: bool) -> Column:
    arr = F.array(*[F.struct(v.alias("value"), F.lit(g).alias("group"), F.lit(n).alias("feature"))
                    for g, n, v in entries])
    return _sort_entries(arr, keep, descending)


def explain(df: DataFrame, model: LinearModel, thresh_micro: float = 0.07) -> DataFrame:
    """Add ``expl_selection``, ``macro_radar``, ``macro_expl``, ``micro_expl``.

    Three projections: contributions, then the entry array and the norm, then
    the four outputs; each stage reads columns of the previous one, which keeps
    every generated method small whatever the number of features.
    """
    contr = contribution_columns(model)
    temps = [t for _, _, t, _ in contr]
    b0 = float(model.intercept)
    n_plus_1 = len(contr) + 1
    groups = [g for g in model.groups if any(cg == g for cg, _, _, _ in contr)]
    lim = 4.0 * thresh_micro

    # stage 1: c_i = b_i * x_i
    staged = df.select("*", *[e.alias(t) for _, _, t, e in contr])

    # stage 2: selection entries, norm = |b_0| + sum |b_i x_i|, group sums
    entries = _entries(model, contr)
    arr = F.array(*[F.struct(v.alias("value"), F.lit(g).alias("group"), F.lit(n).alias("feature"))
                    for g, n, v in entries])
    norm = _sum([F.lit(abs(b0))] + [F.abs(F.col(t)) for t in temps])
    shift = F.lit(b0 / n_plus_1)
    radar_vals = [sigmoid(_sum([F.col(t) - shift for g, _, t, _ in contr if g == grp])) for grp in groups]
    group_sums = [_sum([F.col(t) for g, _, t, _ in contr if g == grp]) for grp in groups]
    staged = staged.select("*", arr.alias("__entries"), norm.alias("__norm"),
                           F.array(*radar_vals).alias("__radar"), F.array(*group_sums).alias("__gsum"))

    # stage 3: outputs
    nrm = F.col("__norm")
    selection = F.struct(
        _sort_entries(F.col("__entries"), lambda e: e["value"] >= F.lit(lim), True).alias("select_concerning"),
        _sort_entries(F.col("__entries"), lambda e: e["value"] <= F.lit(-lim), False).alias("select_reassuring"),
    )
    macro_radar = F.map_from_arrays(F.array(*[F.lit(g) for g in groups]), F.col("__radar"))
    macro_keys = F.array(*[F.lit(k) for k in groups + [OFFSET]])
    macro_vals = F.concat(F.transform(F.col("__gsum"), lambda v: F.try_divide(v, nrm)),
                          F.array(F.try_divide(F.lit(b0), nrm)))
    micro_keys = F.array(*[F.lit(n) for _, n, _ in entries] + [F.lit(OFFSET)])
    micro_vals = F.concat(F.transform(F.col("__entries"), lambda e: F.try_divide(e["value"], nrm)),
                          F.array(F.try_divide(F.lit(b0), nrm)))
    return staged.select(
        *[F.col(c) for c in df.columns],
        selection.alias("expl_selection"),
        macro_radar.alias("macro_radar"),
        F.map_from_arrays(macro_keys, macro_vals).alias("macro_expl"),
        F.map_from_arrays(micro_keys, micro_vals).alias("micro_expl"),
    )


def _sort_entries(arr: Column, keep, descending: bool) -> Column:
    sign = -1 if descending else 1

    def cmp(left, right):
        return (F.when(left["value"] < right["value"], F.lit(-sign))
                .when(left["value"] > right["value"], F.lit(sign))
                .when(left["feature"] < right["feature"], F.lit(-1))
                .when(left["feature"] > right["feature"], F.lit(1))
                .otherwise(F.lit(0)))

    return F.transform(F.array_sort(F.filter(arr, keep), cmp),
                       lambda e: F.struct(e["group"].alias("group"), e["feature"].alias("feature")))


def list_concerning(df: DataFrame, columns: list[str], thr: float = 0.07, out: str = "concerning") -> DataFrame:
    """P13 on plain contribution columns: names with value >= 4*thr, descending."""
    entries = [("", c, F.col(c)) for c in columns]
    names = _sorted_names(entries, lambda e: e["value"] >= F.lit(4.0 * thr), True)
    return df.withColumn(out, F.transform(names, lambda e: e["feature"]))


def list_reassuring(df: DataFrame, columns: list[str], thr: float = 0.07, out: str = "reassuring") -> DataFrame:
    """P13 on plain contribution columns: names with value <= -4*thr, ascending."""
    entries = [("", c, F.col(c)) for c in columns]
    names = _sorted_names(entries, lambda e: e["value"] <= F.lit(-4.0 * thr), False)
    return df.withColumn(out, F.transform(names, lambda e: e["feature"]))


def collapse_group(df: DataFrame, groups: dict[str, list[str]], group: str = COLLAPSED_GROUP,
                   out: str | None = None) -> DataFrame:
    """Replace the member columns of ``group`` by one column, their sum."""
    members = groups.get(group, [])
    if not members:
        return df
    total = _sum([F.col(m) for m in members])
    return df.withColumn(out or group, total).drop(*members)
