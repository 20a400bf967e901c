"""Hot keys: a sector (or partition key) holding most rows is ranked by many
buckets, and results equal the single-window definition."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from vigie.operators import ranking, synthetic
from vigie.sources.panel import hash_unit


def _skewed(spark, n=3000):
    # 70 % of rows in sector "HOT", the rest spread over 9 sectors
    return spark.range(n).select(
        F.format_string("%014d", F.col("id")).alias("siret"),
        F.lit("2000-01-01").cast("date").alias("periode"),
        F.when(F.col("id") % 10 < 7, F.lit("HOT")).otherwise(F.concat(F.lit("S"), (F.col("id") % 9).cast("string")))
        .alias("code_ape_niveau3"),
        (F.col("id") % 2 == 0).alias("outcome"),
        F.lit("A").alias("code_naf"),
        (F.col("id") % 97).cast("double").alias("effectif"),
    )


def test_partitioned_rank_with_hot_key(spark):
    df = _skewed(spark).withColumn("h", hash_unit(F.col("siret"), F.lit("1")))
    got = ranking.global_rank(df, [F.col("h"), F.col("siret")], F.floor(F.col("h") * 37),
                              partition_cols=["code_ape_niveau3"], out="rk")
    want = df.withColumn("rk", F.row_number().over(
        Window.partitionBy("code_ape_niveau3").orderBy("h", "siret")).cast("long"))
    cols = ["siret", "code_ape_niveau3", "rk"]
    assert sorted(got.select(*cols).collect()) == sorted(want.select(*cols).collect())


def test_synthetic_independent_of_bucket_count(spark, monkeypatch):
    base = _skewed(spark)
    args = (["effectif"], ["outcome", "code_naf"], 5)
    one = sorted(synthetic.build_synthetic_dataset(base, *args, seed=3).collect())
    monkeypatch.setattr(synthetic, "_ROWS_PER_BUCKET", 50)
    many = sorted(synthetic.build_synthetic_dataset(base, *args, seed=3).collect())
    assert one == many and len(one) == 10 * 5


def test_synthetic_members_per_group(spark):
    base = _skewed(spark, n=1000)
    out = synthetic.build_synthetic_dataset(base, ["effectif"], ["outcome"], 5, seed=1, members_per_group=True)
    # 700 rows in HOT -> 140 groups; the 9 other sectors hold 33 or 34 rows -> 7 groups each
    assert out.count() == 140 + 9 * 7
