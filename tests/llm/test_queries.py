"""Registered queries: against DuckDB where there is an oracle; the pipeline against its own operators."""

import importlib.util

import pytest

import __spark_entry__ as E
import corpus_pipeline
from compare import assert_same
from conftest import SF_ORACLE, SF_SMALL
from fleetlens.llm.catalog import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    assert_same(QUERIES[name](spark, SF_ORACLE).toPandas(), duck.execute(ORACLE[name]).df())


def test_all_are_registered():
    names = {x.split("_")[0] for x in E.queries() if x.startswith("op")}
    assert names == {f"op{n}" for n in range(1, 14)} and "pipeline" in E.queries()
    assert importlib.util.find_spec("fleetlens.llm.catalog")


def test_pipeline_stages_take_effect(spark):
    docs, sizes = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), []
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.keep(stage(spark, docs, SF_SMALL), "test-stage")
        assert docs.columns == columns
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] < 200 and sizes[-1] > 120
    packed = corpus_pipeline.run(spark, SF_SMALL)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
