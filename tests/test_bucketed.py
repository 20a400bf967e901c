"""Joins on tables stored by their key."""

import re

import pytest
from pyspark.sql import functions as F

from vigie.operators.adjust import attach_debt_snapshots
from vigie.operators.split import distinct_sirens, exclude_train_firms
from vigie.sources.bucketed import bucketed_table, open_bucketed

SCHEMA = "siret string, siren string, periode date, montant_part_ouvriere double, montant_part_patronale double, " \
         "cotisation_moy12m double, effectif double, random_order double, outcome boolean"


@pytest.fixture(scope="module")
def rows(spark):
    i = F.col("id")
    return spark.range(4000).select(
        F.format_string("%014d", i % 500).alias("siret"), F.format_string("%09d", (i % 500 / 3).cast("int")).alias("siren"),
        F.add_months(F.lit("2020-07-01").cast("date"), (i / 500).cast("int")).alias("periode"), (i * 1.0).alias("montant_part_ouvriere"),
        F.lit(1.0).alias("montant_part_patronale"), F.lit(2.0).alias("cotisation_moy12m"), F.lit(20.0).alias("effectif"),
        F.lit(0.5).alias("random_order"), F.lit(False).alias("outcome")).cache()


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def exchanges(df):
    """Exchanges of the plan that ran."""
    got = sorted(map(tuple, df.collect()), key=str)
    plan = df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    return got, len(re.findall(r"[-+ ]Exchange ", plan))


def test_firms_are_excluded_without_an_exchange(spark, rows, no_broadcast):
    train, test = rows.where("siren < '000000090' and periode < '2020-10-01'"), rows.where("periode >= '2020-10-01'")
    want, n = exchanges(exclude_train_firms(test, train))
    assert n == 2
    stored = bucketed_table(rows, "siren")
    got, n = exchanges(exclude_train_firms(stored.where("periode >= '2020-10-01'"), stored.where("siren < '000000090' and periode < '2020-10-01'")))
    assert got == want and n == 0
    got, n = exchanges(exclude_train_firms(stored.where("periode >= '2020-10-01'"), train))  # the other side alone is dealt
    assert got == want and n == 1
    assert exchanges(distinct_sirens(stored))[1] == 0


def test_snapshots_meet_rows_stored_by_establishment(spark, rows, no_broadcast):
    data = rows.where("periode = '2020-09-01'").select("siret", "siren")
    odd = spark.createDataFrame([("00000000000001", "999999999"), ("00000000000002", None)], "siret string, siren string")
    data = data.unionByName(odd)
    out = attach_debt_snapshots(data, rows, "2020-07-01", "2021-01-01")
    want, n = exchanges(out)
    stored = attach_debt_snapshots(bucketed_table(data, "siret"), rows, "2020-07-01", "2021-01-01")
    got, m = exchanges(stored)
    assert got == want and m == n - 1 == 2  # each snapshot is dealt, the rows are not
    assert sum(r[2] is None for r in got) == 2  # another firm's establishment, and none


def test_buckets_by_month_opened_again(spark, rows, scratch, no_broadcast):
    stored = bucketed_table(rows, "siren", buckets=8, partition="periode", path=f"{scratch}/t")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stored.schema.fields)
    again = open_bucketed(spark, f"{scratch}/t", schema, "siren", 8, "periode")
    july = again.where("periode = '2020-07-01'")
    got, n = exchanges(july.join(again.where("periode = '2020-08-01'").select("siren").distinct(), "siren", "left_semi").select("siret"))
    assert len(got) == 500 and n == 0
    assert "PartitionFilters: [isnotnull(periode" in july._jdf.queryExecution().executedPlan().toString()
