"""Every registered query of the operators on the given tables, against SQL where there is some."""

import pytest
from oracle import compare, connect

import corpus_pipeline
from starloom.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"op5_segmentations"}))
def test_query_has_a_row_for_each_of_its_table(spark, name):
    rows = spark.read.parquet(f"/root/testdata/sf0.001/{'pages' if name[:4] in ('op1_', 'op3_') else 'documents'}.parquet")
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() == rows.count()


def test_pipeline(spark):
    small = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, small)
        assert out.schema.names == docs.schema.names and (k == 3 or out.count() <= docs.count())
    out = corpus_pipeline.run(spark, small)
    assert out.where("sample = 0").count() > 100
    assert out.select("doc_id", "sample").distinct().count() == out.count()
