"""The pipeline against the stages' own definitions, stage by stage."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from framesift.llm import compression_quality

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not (os.path.isdir(SF_DIR) and os.path.exists(corpus_pipeline.PIECES)), reason="test tables not here")


def test_stages_keep_their_contract(spark, tmp_path):
    from llm.test_corpus_operators import brute_lines, brute_targets
    from llm.test_near_stage import brute_kept

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "line_dedup", "ngram_jaccard_join", "mix_sources", "sentencepiece"]
    tables = {"documents": docs}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_DIR)
        out.write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        tables[name] = docs
        if k < 4:
            assert docs.columns == before.columns

    def texts(name):
        return {r["doc_id"]: r["text"] for r in tables[name].collect()}

    model = compression_quality.fit(tables["documents"], spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    scores = {i: model.scores([t])[0] for i, t in texts("documents").items()}
    assert set(texts("quality_classifier")) == {i for i, s in scores.items() if s >= 0.7}

    before = texts("quality_classifier")
    want = brute_lines(list(before.items()))
    want = {i: t for i, t in want.items() if t == before[i] or t.split()}
    assert texts("line_dedup") == want
    assert all(r["n_chars"] == len(r["text"]) for r in tables["line_dedup"].collect())

    assert set(texts("ngram_jaccard_join")) == brute_kept(list(want.items()))

    sizes = {}
    kept = tables["ngram_jaccard_join"].collect()
    for r in kept:
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(r["text"].split())
    targets = brute_targets(sizes)
    copies = {r["doc_id"]: r["count"] for r in tables["mix_sources"].groupBy("doc_id").count().collect()}
    for r in kept:
        rate = targets[r["source"]] / sizes[r["source"]]
        assert int(rate - 1e-9) <= copies.get(r["doc_id"], 0) <= int(rate + 1e-9) + 1

    last = tables["sentencepiece"]
    assert last.count() == tables["mix_sources"].count() and last.filter(~F.col("restored")).count() == 0
    again = corpus_pipeline.run(spark, SF_DIR)
    assert again.count() == last.count() and again.exceptAll(last).count() == 0
