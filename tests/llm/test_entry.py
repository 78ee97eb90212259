"""The registered queries and the pipeline as a whole."""

import __spark_entry__ as entry
import corpus_pipeline
import pytest

from orderloom.llm import queries
from tools.check import compare, connect

from .rough import documents, nothing

FOLDER = "/root/testdata/sf0.001"


def test_each_operator_has_one_query():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]
    assert {*names, "pipeline"} <= set(entry.queries()) and set(queries.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", list(queries.queries()))
def test_queries_run(spark, name):
    got = queries.queries()[name](spark, FOLDER)
    sql = queries.oracle_sql().get(name)
    if sql:
        assert compare(got, connect(FOLDER), sql) == ""
    else:
        assert got.count() > 0 or name == "op1_substring_dedup"


def test_pipeline_runs(spark):
    got = corpus_pipeline.run(spark, FOLDER)
    assert {"doc_id", "sequence_id", "offset"} <= set(got.columns) and got.count() > 50


@pytest.mark.parametrize("number", range(5))
def test_stages_bear_rough_rows_and_none(spark, number):
    name, stage = corpus_pipeline.STAGES[number]
    for docs in (documents(spark), nothing(spark)):
        out = stage(spark, docs, FOLDER)
        out.count()
        if number < 4:
            assert out.columns == docs.columns
