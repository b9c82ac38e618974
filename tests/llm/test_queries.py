"""The registered queries against their SQL, the pipeline stage by stage, and what native plans must not contain."""

import pytest

import corpus_pipeline
from tallymart.llm.catalog import QUERIES, SQL
from tests.compare import differences, duck

PYTHON = ["PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroups"]


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_sql(name, spark, sf_dir):
    assert differences(QUERIES[name](spark, sf_dir), duck(sf_dir), SQL[name]) == []


@pytest.mark.parametrize("name", ["op2_mixing", "op7_url_blocks", "op8_quality_rules"])
def test_native_plans(name, spark, sf_dir):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert [w for w in [*PYTHON, "CartesianProduct"] if w in plan] == []


def test_stages_work_on_what_their_predecessors_kept(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[1] == counts[2] and counts[-1] > 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r["doc_id"] for r in pieces.select("doc_id").collect()} == {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert corpus_pipeline.run(spark, sf_dir).count() == pieces.count()


def test_stages_on_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0
