from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F

from tests.llm.conftest import EDGE_ROWS, documents

SF = "/root/testdata/sf0.01"


def test_stages_over_given_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
            assert docs.count() <= before
            before = docs.count()
    last = spark.read.parquet(str(tmp_path / corpus_pipeline.STAGES[-2][0]))
    sizes = docs.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert {r.doc_id for r in sizes} == {r.doc_id for r in last.select("doc_id").collect()}
    assert all(r["sum(length)"] == r["max(doc_tokens)"] for r in sizes)
    clean = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1 AND toxic = 0").collect()}
    kept = {r.doc_id for r in spark.read.parquet(str(tmp_path / "quality")).select("doc_id").collect()}
    assert len(clean & kept) >= 0.97 * len(clean)


def test_stages_over_edges_and_nothing(spark, edge_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, edge_docs, SF)
        assert out.columns == edge_docs.columns
        assert out.filter("doc_id IS NULL").count() == 2 or name == "quality"
        assert stage(spark, no_docs, SF).collect() == []
    assert corpus_pipeline.STAGES[-1][1](spark, no_docs, SF).collect() == []
    assert corpus_pipeline.STAGES[-1][1](spark, documents(spark, EDGE_ROWS), SF).select("doc_id").distinct().count() == 12


def test_rows_are_judged_one_by_one(spark, tmp_path):
    """Without ids, and with ids that rows share, each row stays or goes by its own text."""
    stages = dict(corpus_pipeline.STAGES)
    (item,) = spark.read.parquet(f"{SF}/benchmark.parquet").filter("length(text) > 60").orderBy("item_id").limit(1).collect()
    plain = [" ".join(f"{w}{k}" for w in "all of these words tell one text from any other text there is".split()) for k in range(4)]
    rows = [(None, plain[0]), (None, plain[0]), (None, plain[1]), (1, plain[2]), (1, plain[3]), (1, plain[3]), (9, plain[3]), (-4, plain[1])]
    documents(spark, rows, clashing=True).withColumn("_row", F.lit("x")).write.parquet(str(tmp_path / "near"))
    out = stages["near_dedup"](spark, spark.read.parquet(str(tmp_path / "near")), SF)
    assert "_row" in out.columns
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter([(None, plain[0]), (-4, plain[1]), (1, plain[2]), (1, plain[3])])

    rows = [(None, item.text), (None, plain[0]), (1, f"Before. {item.text}"), (1, plain[1]), (1, plain[1])]
    documents(spark, rows).write.parquet(str(tmp_path / "leaks"))
    out = stages["decontamination"](spark, spark.read.parquet(str(tmp_path / "leaks")), SF)
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter(r for r in rows if item.text not in r[1])
