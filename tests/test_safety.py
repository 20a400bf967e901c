"""Session, panel table, exact order and error rules."""

import os
import shutil
import uuid
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from vigie import session
from vigie.operators import metrics, ranking, thresholds
from vigie.operators.adjust import attach_debt_snapshots
from vigie.operators.dataset import DatasetSpec, EmptyDataset, match, top_n
from vigie.operators.merge import merge_models
from vigie.operators.model import fit_levels
from vigie.operators.synthetic import mock_siren, mock_siret
from vigie.sources import io, panel

SF = "/root/testdata/sf0.001"


def test_session_is_the_launchers(spark):
    assert session.get_spark() is spark


def test_a_cluster_needs_a_shared_folder():
    def fake(master):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: None),
                               sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None))
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(ValueError):
            session.checkpoint_dir(fake(master))


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables absent")
def test_panel_follows_its_input_files(spark, scratch):
    for name in ("lineitem", "customer", "nation", "region"):
        os.symlink(f"{SF}/{name}.parquet", f"{scratch}/{name}.parquet")
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    orders.repartition(2).write.parquet(f"{scratch}/orders.parquet")
    first = panel.load_panel(spark, scratch)
    n, one = first.count(), panel._fingerprint(spark, scratch)
    assert panel.load_panel(spark, scratch) is first
    part = sorted(f for f in os.listdir(f"{scratch}/orders.parquet") if f.endswith(".parquet"))[0]
    orders.limit(10).coalesce(1).write.parquet(f"{scratch}/few")
    few = [f for f in os.listdir(f"{scratch}/few") if f.endswith(".parquet")][0]
    shutil.copyfile(f"{scratch}/few/{few}", f"{scratch}/orders.parquet/{part}")
    crc = f"{scratch}/orders.parquet/.{part}.crc"
    if os.path.exists(crc):
        os.remove(crc)
    assert panel._fingerprint(spark, scratch) != one
    assert panel.load_panel(spark, scratch) is first  # one listing a session, unless asked for
    assert panel.load_panel(spark, scratch, recheck=True).count() < n


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables absent")
def test_an_unfinished_panel_is_not_read(spark, monkeypatch):
    monkeypatch.setattr(panel, "_cache", {})
    monkeypatch.setattr(panel, "_tables", {})
    monkeypatch.setattr(panel, "RECIPE_VERSION", f"unfinished-{uuid.uuid4().hex}")
    root, key = session.checkpoint_dir(spark), panel._fingerprint(spark, SF)
    spark.createDataFrame([("1",)], "siret string").write.parquet(f"{root}/panel/{key}-half")
    assert panel.load_panel(spark, SF).count() > 1


def test_top_n_of_equal_scores_is_cut_by_ties(spark):
    rows = [(f"{i % 700:05d}" if i % 50 else None, 1.0, i % 3) for i in range(2000)]
    df = spark.createDataFrame(rows, "siret string, random_order double, periode int")
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[2]))
    for n in (1, 60, 333, 1999):
        got = sorted(map(str, ((r.siret, r.periode) for r in top_n(df, n, direct_limit=25).collect())))
        assert got == sorted(str((r[0], r[2])) for r in order[:n])


def test_missing_scores_and_outcomes_take_no_part(spark, monkeypatch):
    rows = [(i % 3 == 0, i / 40) for i in range(40)]
    gaps = rows + [(True, None), (False, None), (None, 0.99), (True, float("nan"))]
    schema = "outcome boolean, score double"
    clean, holes = spark.createDataFrame(rows, schema), spark.createDataFrame(gaps, schema)
    want = sorted(map(str, metrics.pr_curve(clean).collect())), metrics.evaluate(clean, 2).first()
    for size in (3, 200_000):
        monkeypatch.setattr(ranking, "_TARGET_ROWS_PER_BUCKET", size)
        assert sorted(map(str, metrics.pr_curve(holes).collect())) == want[0]
        got = metrics.evaluate(holes, 2).first()
        assert got.aucpr == pytest.approx(want[1].aucpr) and got[1:] == want[1][1:]


def test_equal_betas(spark):
    df = spark.createDataFrame([(i % 2 == 0, i / 20) for i in range(20)], "outcome boolean, score double")
    row = thresholds.thresholds_from_fbeta(df, 1, 1, n_thr=11).first()
    assert row.t_f1 == row.t_f2 and row.fbeta_f1 == row.fbeta_f2


def test_repeated_siret_in_a_model_is_an_error(spark):
    schema = "siret string, predicted_probability double"
    a = spark.createDataFrame([("a", 0.1), ("a", 0.9)], schema)
    b = spark.createDataFrame([("b", 0.5)], schema)
    with pytest.raises(Exception, match="occurs twice"):
        merge_models([a, b]).collect()
    with pytest.raises(Exception, match="occurs twice"):
        merge_models([a, b]).count()  # reads no column
    assert merge_models([a.limit(1), b]).count() == 2


def _month(spark, rows):
    return spark.createDataFrame(rows, "siret string, siren string, periode string, montant_part_ouvriere double, "
                                 "montant_part_patronale double, cotisation_moy12m double, effectif double") \
        .withColumns({"periode": F.to_date("periode"), "random_order": F.lit(0.5), "outcome": F.lit(False)})


def test_snapshots_empty_or_repeated(spark):
    data = spark.createDataFrame([("1", "2")], "siret string, siren string")
    july = ("00000000000001", "000000002", "2020-07-01", 1.0, 1.0, 1.0, 20.0)
    with pytest.raises(EmptyDataset):
        attach_debt_snapshots(data, _month(spark, [july]))
    late = july[:2] + ("2021-01-01",) + july[3:]
    data = spark.createDataFrame([("00000000000001", "000000002")], "siret string, siren string")
    with pytest.raises(Exception, match="twice in the snapshot"):
        attach_debt_snapshots(data, _month(spark, [july, july, late])).collect()
    assert attach_debt_snapshots(data, _month(spark, [july, late])).first().cotisation_moy12m_latest == 1.0


def test_nan_staff_does_not_pass(spark, scratch):
    rows = _month(spark, [("1", "2", "2020-07-01", 1.0, 1.0, 1.0, float("nan"))])
    assert match(rows, DatasetSpec()).count() == 0
    rows.select(F.struct("siret").alias("_id"), F.struct("*").alias("value")).write.parquet(f"{scratch}/nested")
    row = io.read_features(spark, f"{scratch}/nested").first()
    assert row.effectif is None and row.siret == "00000000000001" and row.siren == "000000002"


def test_json_feature_table(spark, scratch):
    spark.createDataFrame([("7", "2020-01-01", 2.0)], "siret string, periode string, effectif double").write.json(f"{scratch}/f.json")
    row = io.read_features(spark, f"{scratch}/f.json").first()
    assert (row.siret, str(row.periode), row.effectif) == ("00000000000007", "2020-01-01", 2.0)


def test_mock_ids_are_spread_and_distinct(spark):
    n = F.col("id") * 1_000_003 + F.when(F.col("id") % 2 == 0, 900_000_000).otherwise(0)
    d = spark.range(5000).select(mock_siren(n).alias("a"), mock_siret(n).alias("b"))
    row = d.agg(F.count_distinct("b"), F.min(F.length("a")), F.max(F.length("a")), F.min(F.length("b")), F.max(F.length("b"))).first()
    assert tuple(row) == (5000, 9, 9, 14, 14)
    assert spark.range(1, 1001).select(F.count_distinct(mock_siren(F.col("id")))).first()[0] == 1000


def test_too_many_levels_is_an_error(spark, monkeypatch):
    monkeypatch.setattr("vigie.operators.model.MAX_LEVELS", 3)
    with pytest.raises(ValueError):
        fit_levels(spark.range(10).select(F.col("id").cast("string").alias("c")), ["c"])


def test_command_line_sizes():
    from vigie.__main__ import make_parser
    args = make_parser().parse_args(["--features", "x.json", "--predict_spl_size", "all", "--test_spl_size", "7", "--predict_siret_list", "l"])
    assert (args.predict_spl_size, args.test_spl_size, args.predict_siret_list, args.tables) == ("all", 7, "l", None)
