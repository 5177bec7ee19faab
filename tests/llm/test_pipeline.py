from __future__ import annotations

import corpus_pipeline
from pyspark.sql import functions as F
from fareloom.llm.common import stored
from fareloom.llm.jaccard_join import one_of_each
from tests.llm.test_jaccard_join import brute
from tests.llm.test_packing import check_pieces, library_ids


def test_stages_equal_plain_versions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    before = docs
    results = {}
    for name, stage in corpus_pipeline.STAGES[:3]:
        after = stored(stage(spark, before, sf_dir), "stage")
        assert after.schema.names == docs.columns
        results[name] = ({r.doc_id for r in before.collect()}, {r.doc_id for r in after.collect()})
        assert results[name][1] <= results[name][0]
        before = after
    for name, label, bad in (("toxicity", "toxic", 1), ("quality classifier", "quality", 0)):
        seen, kept = results[name]
        clean = {i for i in seen if i in labels and labels[i][label] != bad}
        assert len(clean & kept) >= 0.97 * len(clean)
        if name == "quality classifier":
            poor = {i for i in seen if i in labels and labels[i][label] == bad}
            assert len(poor & kept) <= 0.2 * len(poor)
    texts = {r.doc_id: r.text for r in docs.collect()}
    seen, kept = results["n-gram Jaccard join"]
    rows = sorted((i, texts[i]) for i in seen)
    assert kept == {least for _, _, least in brute(rows, corpus_pipeline.NEAR)}
    pieces = [tuple(r) for r in corpus_pipeline.packing(spark, before, sf_dir).collect()]
    check_pieces(pieces, {i: library_ids(texts[i]) for i in kept})


def test_run(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0


def test_stages_take_empty_and_odd_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0), (2, "a b", None, "s", 3)],
        docs.schema,
    ).selectExpr("*", "1 AS _own_id", "'x' AS text_hash")
    for name, stage in corpus_pipeline.STAGES:
        for table in (odd, odd.limit(0)):
            out = stage(spark, table, sf_dir)
            assert name == "packing" or out.columns == odd.columns
            out.collect()
    assert one_of_each(odd, corpus_pipeline.NEAR).count() == 4


def test_stages_take_columns_of_any_name(spark, sf_dir):
    """Further columns that are called as internal ones, in another case, or oddly."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    inner = "p host path row own_id own_hash c0 c1 key component n s a b label found share rank P TEXT Doc_Id"
    odd = [*inner.split(), "p.q", "back`tick", "a b"]
    wide = docs.select("*", *(F.lit(i).alias(f"x{i}") for i in range(len(odd))))
    wide = wide.toDF(*docs.columns, *odd)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, wide, sf_dir)
        if name == "packing":
            assert out.count() > 0
            continue
        assert out.columns == wide.columns
        rows = out.collect()
        assert rows and all(tuple(r)[len(docs.columns) :] == tuple(range(len(odd))) for r in rows)
