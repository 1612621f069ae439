"""The registered queries against their SQL, and the pipeline stage by stage."""

import pytest

import corpus_pipeline
from compare import connect, differences
from granary.llm import queries as llm

QUERIES, SQL = llm.queries(), llm.oracle_sql()


@pytest.mark.parametrize("name", SQL)
def test_query_matches_sql(spark, sf, name):
    assert differences(connect(sf), SQL[name], QUERIES[name](spark, sf).toArrow()) == ""


def test_pipeline_stages_keep_the_columns_of_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "ngram_join", "passage_dedup", "source_mix", "packing"]
    before = docs.count()
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stage(function(spark, docs, sf))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name != "source_mix":
            assert docs.count() <= before
            before = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert packed.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0
    assert packed.count() >= docs.count() > 0


def test_pipeline_of_no_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, function in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(function(spark, docs, sf))
        assert docs.count() == 0
