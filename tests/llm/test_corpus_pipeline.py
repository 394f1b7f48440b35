"""The pipeline stage by stage, each against what its operator says and brute force."""

import corpus_pipeline
from glimmer.llm._common import stage
from glimmer.llm.quality_classifier import classify
from glimmer.llm.quality_rules import quality_rules

from test_corpus_operators import linked, sets_of, texts

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    seen = [docs]
    for _, f in corpus_pipeline.STAGES:
        seen.append(stage(f(spark, seen[-1], SF)))
    raw, ruled, scored, cut, single, packed = seen
    assert all(d.columns == docs.columns for d in seen[:-1])
    assert ids(ruled) == {r.doc_id for r in quality_rules(raw).filter("kept").collect()}
    assert ids(scored) == {r.doc_id for r in classify(ruled, spark.read.parquet(f"{SF}/labels.parquet")).filter("predicted = 1").collect()}
    lines = [x for _, t in texts(cut) for x in t.split("\n") if len(x.strip()) >= 40]
    assert len(lines) == len(set(lines)) and ids(cut) <= ids(scored)
    want = linked(sets_of(texts(cut), 5), 80)
    assert ids(single) == {i for i, c in want.items() if i == c}
    assert ids(packed) == ids(single)


def test_one_row_of_an_id_stays(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(7, text), (7, text), (7, "another text of this id"), (9, text + " more"), (2, "short"), (None, text), (4, None), (5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as component_id", "2 as count", "3 as _row")
    got = corpus_pipeline.near_duplicate_documents(spark, df, SF)
    assert got.columns == df.columns and sorted(r.doc_id or 0 for r in got.collect()) == [0, 2, 4, 5, 7]
    assert corpus_pipeline.near_duplicate_documents(spark, df.limit(0), SF).count() == 0


def test_stages_of_no_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, f in corpus_pipeline.STAGES:
        docs = stage(f(spark, docs, SF))
        assert docs.count() == 0, name
