"""The stages of the corpus pipeline, each against a plain version on its own input."""

import collections

import pytest

import corpus_pipeline
from sparkassay.llm.weighted_minhash import near_documents
from sparkassay.session import cut_lineage

SF = "/root/testdata/sf0.001"


def test_stages_in_order_and_effective(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = cut_lineage(stage(spark, docs, SF), "test")
        assert docs.columns == columns
        seen[name] = (before, docs)
    assert list(seen) == ["toxicity", "near duplicates", "personal data", "source mix"]
    before, after = seen["near duplicates"]
    classes = {r["doc_id"]: r["class_id"] for r in near_documents(before).collect()}
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(set(classes.values()))
    before, after = seen["personal data"]
    assert before.count() == after.count() and not after.where("text rlike '[a-z]@mail[0-9]*[.]example'").count()
    assert not after.where("n_chars <> char_length(text)").count()
    before, after = seen["source mix"]
    copies = collections.Counter(r["doc_id"] for r in after.collect())
    assert set(copies) <= {r["doc_id"] for r in before.collect()} and max(copies.values()) <= 3
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert collections.Counter(r["doc_id"] for r in packed if r["piece"] == 0) == copies


@pytest.mark.parametrize("rows", [0, None])
def test_stages_on_odd_and_empty_tables(spark, docs, rows):
    table = docs.limit(0) if rows == 0 else docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = cut_lineage(stage(spark, table, SF), "test")
        assert out.columns == docs.columns
        table = out
    total = corpus_pipeline.STAGES[-1][1](spark, table, SF).count()
    assert (total == 0) == (rows == 0)
