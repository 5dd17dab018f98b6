import pytest
from oracle_compare import compare, connect

import corpus_pipeline
from agorakit.llm import queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_equal_their_sql(spark, small, name):
    assert compare(queries.QUERIES[name](spark, small), connect(small), queries.SQL[name]) is None


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_pipeline(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    seen = {}
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.materialize(stage(spark, before, small), name)
        seen[name] = after
        if name != "packing":
            assert after.columns == docs.columns
            assert after.join(before, docs.columns, "left_anti").count() == 0
        before = after
    packed = seen["packing"]
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in seen["benchmark_decontamination"].collect()}
    assert packed.where("length != size(ids)").count() == 0
