"""The pipeline's stages on a small corpus, and the registered queries against their SQL."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as P
from tools.compare import compare_frames, duck
from vigie.llm import decontaminate, mixing, quality_rules, queries, simhash
from vigie.llm.common import read, written

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables absent")


def test_every_stage_keeps_the_columns_and_does_its_work(spark):
    docs = read(spark, SF, "documents")
    columns, before = docs.columns, docs
    assert [name for name, _ in P.STAGES] == ["quality rules", "simhash near-dedup", "benchmark decontamination",
                                              "mixing sources to target weights", "token-id binary output"]
    kept = {}
    for name, stage in P.STAGES[:-1]:
        before, docs = docs, written(stage(spark, docs, SF), "stage")
        assert docs.columns == columns
        kept[name] = (before, docs)
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    before, after = kept["quality rules"]
    assert ids(after) == ids(quality_rules.judge(before).where("kept"))
    before, after = kept["simhash near-dedup"]
    classes = simhash.with_components(before.select("doc_id", "text"))
    assert ids(after) == ids(classes.where("doc_id = component_id"))
    before, after = kept["benchmark decontamination"]
    assert ids(after) == ids(decontaminate.decontaminate(before, read(spark, SF, "benchmark")).where("not contaminated"))
    before, after = kept["mixing sources to target weights"]
    copies = mixing.mix(before).where("copies > 0").select("doc_id", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    assert ids(after) == ids(copies)
    out = P.STAGES[-1][1](spark, docs, SF).orderBy("start").collect()
    assert [r.doc_id for r in out] == ids(docs)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(out, out[1:]))
    run = P.run(spark, SF)
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, out))


def test_no_documents(spark):
    docs = read(spark, SF, "documents").where("false")
    for name, stage in P.STAGES:
        if name != P.STAGES[-1][0]:
            docs = written(stage(spark, docs, SF), "stage")
            assert docs.count() == 0
    assert P.STAGES[-1][1](spark, docs, SF).count() == 0


def test_one_query_for_each_operator():
    assert sorted(int(n.split("_")[0][2:]) for n in queries.QUERIES) == list(range(1, 14))
    assert {"pipeline", *queries.QUERIES} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    got = queries.QUERIES[name](spark, SF).toPandas()
    ok, msg = compare_frames(got, duck(SF).sql(queries.ORACLE[name]).df())
    assert ok, msg
