"""Counts taken while a table is written."""

import pytest
from pyspark.sql import functions as F

from vigie.operators.adjust import attach_debt_snapshots
from vigie.operators.checks import Checks, require_rows
from vigie.operators.dataset import EmptyDataset


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("checks") / "t")
    spark.range(1000).withColumn("k", F.col("id") % 7).repartition(4).write.parquet(path)
    return spark.read.parquet(path)


def test_counts_along_one_plan(table):
    checks = Checks()
    df = checks.on(table, "read", odd=F.count(F.when(F.col("id") % 2 == 1, F.lit(1))))
    df = checks.on(df.where("k < 3").groupBy("k").count(), "groups", most=F.max("count"))
    out, noted = checks.written(df.select("k"), "checks")  # the counted column isn't written
    assert noted == {"read": {"rows": 1000, "odd": 500}, "groups": {"rows": 3, "most": 143}} and out.count() == 3


@pytest.mark.parametrize("cut", ["id < 0", "false"])
def test_parts_of_the_plan_without_rows(table, cut):
    """Spark may leave such parts out of the plan it runs."""
    none = table.where(cut)
    for make in (lambda d: d, lambda d: d.groupBy("k").count(), lambda d: d.join(table.select("k").distinct(), "k", "left_anti"),
                 lambda d: d.repartition(3).join(table.select("k").distinct(), "k")):
        checks = Checks()
        _, noted = checks.written(make(checks.on(none, "none", most=F.max("id"))), "checks")
        assert noted["none"] == {"rows": 0, "most": None}
    checks = Checks()
    _, noted = checks.written(checks.on(table, "all").join(none.select("k").distinct(), "k", "left_semi"), "checks")
    assert noted["all"]["rows"] == 1000
    with pytest.raises(EmptyDataset):
        require_rows(0, "x")


def test_one_scan_per_snapshot(spark, tmp_path):
    """Files of the panel that jobs read while the snapshots are taken: each month once."""
    rows = [(f"{i:014d}", f"{i:09d}", m, float(i), 1.0, 1.0, 20.0, 0.5, False)
            for i in range(40) for m in ("2020-07-01", "2021-01-01", "2021-02-01")]
    path = str(tmp_path / "panel")
    spark.createDataFrame(rows, "siret string, siren string, periode string, montant_part_ouvriere double, montant_part_patronale double, "
                          "cotisation_moy12m double, effectif double, random_order double, outcome boolean") \
        .withColumn("periode", F.to_date("periode")).repartition(1).write.partitionBy("periode").parquet(path)
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    panel = spark.read.parquet(path)
    panel = panel.where("periode < '2021-02-01'").mapInArrow(seen, panel.schema)
    data = spark.createDataFrame([(f"{i:014d}", f"{i:09d}") for i in range(40)], "siret string, siren string")
    out = attach_debt_snapshots(data, panel)
    assert out.count() == 40 and out.where("montant_part_ouvriere_latest is null").count() == 0
    assert read.value == 160  # both months pass once for each of the two snapshots
