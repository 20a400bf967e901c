"""Expert debt rule."""

from vigie.operators.adjust import apply_debt_rule

SCHEMA = ("montant_part_ouvriere_latest double, montant_part_patronale_latest double, "
          "montant_part_ouvriere_july2020 double, montant_part_patronale_july2020 double, "
          "cotisation_moy12m_latest double, group_final string")


def test_reference_rows(spark):
    rows = [(50, 75, 50, 50, 100, "vert"), (60, 50, 50, 50, 100, "vert"), (100, 100, 50, 0, 75, "rouge")]
    df = spark.createDataFrame([tuple(float(v) for v in r[:5]) + (r[5],) for r in rows], SCHEMA)
    got = [r.group_final_regle_urssaf for r in apply_debt_rule(df).collect()]
    assert got == ["orange", "vert", "rouge"]


def test_edges(spark):
    rows = [
        (10.0, 0.0, 0.0, 0.0, 0.0, "vert"),     # zero denominator, debt rising -> escalates
        (0.0, 0.0, 0.0, 0.0, 0.0, "vert"),      # zero denominator, no change -> kept
        (0.0, 0.0, 10.0, 0.0, 0.0, "orange"),   # zero denominator, falling -> kept
        (None, None, None, None, None, "orange"),  # all missing -> kept
        (100.0, 0.0, 0.0, 0.0, 10.0, "gris"),   # unknown level passes through
        (100.0, 0.0, 0.0, 0.0, 10.0, "orange"),  # orange -> rouge
        (20.0, 0.0, 0.0, 0.0, 100.0, "vert"),   # exactly 0.2: strict, kept
    ]
    out = apply_debt_rule(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [r.group_final_regle_urssaf for r in out] == ["orange", "vert", "orange", "orange", "gris", "rouge", "vert"]
    assert out[0].delta_dette is None and out[3].dette_sociale_latest == 0.0


def test_adjust_pipeline_runs_in_order(spark):
    from vigie.operators.adjust import adjust_pipeline
    from vigie.plans.pipeline import run_pipeline

    panel = spark.createDataFrame(
        [("00000000100001", "000000001", "2020-07-01", 50.0, 50.0, 100.0, 10.0),
         ("00000000100001", "000000001", "2021-01-01", 50.0, 75.0, 100.0, 10.0)],
        "siret string, siren string, periode string, montant_part_ouvriere double, "
        "montant_part_patronale double, cotisation_moy12m double, effectif double",
    ).selectExpr("*", "cast(periode as date) as p2", "0.5 as random_order", "false as outcome") \
        .drop("periode").withColumnRenamed("p2", "periode")
    data = spark.createDataFrame([("00000000100001", "000000001", "vert"), ("00000000200001", "000000002", "orange")],
                                 "siret string, siren string, group_final string")
    out = run_pipeline(data, adjust_pipeline(panel)).orderBy("siret").collect()
    assert [r.group_final_regle_urssaf for r in out] == ["orange", "orange"]
    assert out[0].montant_part_patronale_latest == 75.0 and out[1].cotisation_moy12m_latest is None
