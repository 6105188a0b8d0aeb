import re

import pytest

import __spark_entry__ as contract
import corpus_pipeline as pipeline
from oracle import connect, differences
from stellate.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(name, spark, sf_dir):
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) == []


def test_every_operator_is_registered():
    numbers = sorted(int(m[1]) for m in (re.match(r"op(\d+)_", n) for n in contract.queries()) if m)
    assert numbers == list(range(1, 14)) and "pipeline" in contract.queries()


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    for name, function in pipeline.STAGES[:4]:
        out = pipeline.stage(function(spark, docs, sf_dir), "test-stage")
        assert out.columns == columns and out.schema == docs.schema, name
        assert 0 < out.count() <= docs.count()
        assert out.select("doc_id").join(docs, "doc_id", "left_anti").count() == 0
        docs = out
    packed = pipeline.STAGES[4][1](spark, docs, sf_dir).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_stages_on_awkward_and_empty(spark, sf_dir, awkward):
    for docs in (awkward, awkward.limit(0)):
        for name, function in pipeline.STAGES:
            out = function(spark, docs, sf_dir)
            assert out.count() >= 0, name


def test_repeated_lines(spark, sf_dir, documents):
    line = "a line that is long enough to be compared"
    docs = documents([(1, f"{line}\nanother line that is also long enough"), (2, line), (3, f"{line}!\nshort"), (4, None), (5, "")])
    out = {r.doc_id: (r.text, r.n_chars) for r in pipeline.drop_repeated_lines(spark, docs, sf_dir).collect()}
    assert out == {1: (docs.first().text, docs.first().n_chars), 3: ("short", 5), 4: (None, None), 5: ("", 0)}


def test_stages_keep_clashing_columns(spark, sf_dir, documents):
    line = "a line that is long enough to be compared"
    docs = documents([(1, line), (2, f"{line}\nanother")]).selectExpr("*", "1 AS _n_lines", "2 AS _n_dropped", "3 AS _key")
    out = pipeline.drop_repeated_lines(spark, docs, sf_dir)
    assert out.columns == docs.columns and {r._n_lines for r in out.collect()} == {1}


def test_short_repeated_lines(spark, sf_dir, documents):
    docs = documents([(1, "Les.\nfirst"), (2, "Les.\nLe."), (3, "Les.")])
    out = {r.doc_id: (r.text, r.n_chars) for r in pipeline.drop_repeated_lines(spark, docs, sf_dir).collect()}
    assert out == {1: ("Les.\nfirst", 10), 2: ("Le.", 3)}
