"""DuckDB text of the panel recipe (the independent oracle for every query).

Written by hand from the recipe, not generated from the Spark plan, so that a
mistake on one side shows up as a mismatch.  ``with_panel(body)`` prefixes a
query with the ``panel`` CTE.
"""

from __future__ import annotations

from vigie.schema import DEBT_LAGS, PANEL_COLUMNS

_LAGS = ",\n".join(
    f"    max(montant_part_{part}) OVER (PARTITION BY o_custkey ORDER BY mi "
    f"RANGE BETWEEN {k} PRECEDING AND {k} PRECEDING) AS montant_part_{part}_past_{k}"
    for k in DEBT_LAGS for part in ("ouvriere", "patronale")
)

PANEL_CTE = f"""
panel_lines AS (
  SELECT o.o_custkey, o.o_orderstatus, o.o_orderdate,
         l.l_quantity, l.l_extendedprice, l.l_discount, l.l_tax, l.l_returnflag,
         l.l_linestatus, l.l_shipdate
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
panel_monthly AS (
  SELECT o_custkey,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS periode,
         sum(CASE WHEN l_returnflag = 'N' THEN l_quantity END) AS effectif,
         round(sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice * l_tax END), 4) AS montant_part_ouvriere,
         round(sum(CASE WHEN l_returnflag = 'A' THEN l_extendedprice * l_discount END), 4) AS montant_part_patronale,
         round(sum(l_extendedprice), 2) AS ca_,
         sum(CASE WHEN l_linestatus = 'O' THEN l_quantity END) AS apart_heures_consommees,
         avg(CASE WHEN l_linestatus = 'F'
                  THEN abs(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) % 121 END)
             AS paydex_nb_jours,
         bool_or(o_orderstatus = 'F') AS has_f,
         count(*) AS n_,
         min(l_quantity) AS qmin, max(l_quantity) AS qmax,
         min(l_discount) AS dmin, max(l_discount) AS dmax,
         min(l_tax) AS tmin, max(l_tax) AS tmax,
         min(l_extendedprice) AS emin, max(l_extendedprice) AS emax
  FROM panel_lines
  GROUP BY o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE)
),
panel_base AS (
  SELECT m.*,
         year(periode) * 12 + month(periode) AS mi,
         lpad(CAST(o_custkey // 3 AS VARCHAR), 9, '0') AS siren,
         lpad(CAST(o_custkey // 3 AS VARCHAR), 9, '0') || lpad(CAST(o_custkey % 3 AS VARCHAR), 5, '0') AS siret,
         ca_ / 10.0::DOUBLE AS cotisation,
         c.c_acctbal,
         CASE WHEN c.c_nationkey <> 24 THEN chr(CAST(65 + c.c_nationkey AS INTEGER)) END AS code_naf,
         c.c_mktsegment || '-' || CAST(c.c_nationkey % 5 AS VARCHAR) AS code_ape_niveau3,
         r.r_name AS region,
         CASE WHEN c.c_mktsegment <> 'FURNITURE' THEN tmax - tmin END AS financier_court_terme,
         CASE WHEN c.c_mktsegment <> 'FURNITURE' THEN dmax END AS interets,
         CASE WHEN c.c_mktsegment <> 'FURNITURE' THEN ca_ END AS ca,
         CASE WHEN c.c_mktsegment <> 'FURNITURE' THEN dmin - tmax END AS equilibre_financier,
         CASE WHEN c.c_mktsegment <> 'FURNITURE' THEN c.c_acctbal / 1000.0::DOUBLE END AS endettement,
         CASE WHEN c.c_mktsegment <> 'FURNITURE' THEN qmin / 50.0::DOUBLE END AS degre_immo_corporelle,
         CASE WHEN c.c_mktsegment <> 'FURNITURE' THEN CAST(n_ AS DOUBLE) / CAST(n_ + 1 AS DOUBLE) END
             AS liquidite_reduite,
         CASE WHEN c.c_mktsegment <> 'FURNITURE' THEN tmax + dmin END AS poids_bfr_exploitation,
         CASE WHEN c.c_mktsegment <> 'FURNITURE' THEN emax / 100000.0::DOUBLE END AS productivite_capital_investi,
         CASE WHEN c.c_mktsegment <> 'FURNITURE' THEN emin / emax END AS rentabilite_economique,
         CASE WHEN c.c_mktsegment <> 'FURNITURE' THEN (qmax - qmin) / 50.0::DOUBLE END AS rentabilite_nette,
         (coalesce(montant_part_ouvriere, 0.0::DOUBLE) + coalesce(montant_part_patronale, 0.0::DOUBLE))
             / (ca_ / 10.0::DOUBLE) AS ratio_dette
  FROM panel_monthly m
  JOIN customer c ON m.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
),
panel_win AS (
  SELECT *,
    avg(cotisation) OVER (PARTITION BY o_custkey ORDER BY mi RANGE BETWEEN 11 PRECEDING AND CURRENT ROW)
        AS cotisation_moy12m,
    avg(ratio_dette) OVER (PARTITION BY o_custkey ORDER BY mi RANGE BETWEEN 11 PRECEDING AND CURRENT ROW)
        AS ratio_dette_moy12m,
    sum(apart_heures_consommees) OVER (PARTITION BY o_custkey ORDER BY mi
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS apart_heures_consommees_cumulees,
    lag(paydex_nb_jours) OVER (PARTITION BY o_custkey ORDER BY mi) AS paydex_nb_jours_past_12,
    CAST(CASE WHEN c_acctbal < 3000
              THEN max(CASE WHEN has_f THEN mi END) OVER (PARTITION BY o_custkey) - mi END AS INTEGER)
        AS time_til_outcome,
{_LAGS}
  FROM panel_base
),
panel AS (
  SELECT {", ".join(c for c in PANEL_COLUMNS if c not in ("outcome", "random_order"))},
         coalesce(time_til_outcome <= 18, false) AS outcome,
         CAST(('0x' || substr(md5(siret || '|' || CAST(periode AS VARCHAR)), 1, 8)) AS BIGINT)::DOUBLE
             / 4294967296.0::DOUBLE AS random_order
  FROM panel_win
)"""


def with_panel(body: str, *ctes: str) -> str:
    """``WITH panel AS (...), <ctes> <body>``."""
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH {PANEL_CTE}{extra}\n{body}"
