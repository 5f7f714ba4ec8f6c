"""Registered queries against SQL, and the pipeline stage by stage."""

import pytest

import corpus_pipeline
from millrace.llm.queries import QUERIES, SQL
from tests.compare import check
from tests.llm.conftest import by_id


def test_every_operator_has_a_query():
    assert [sum(k.startswith(f"op{n}_") for k in QUERIES) for n in range(1, 14)] == [1] * 13 and "pipeline" in QUERIES


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, sf_dir, name):
    ok, note = check(spark, duck, name, QUERIES[name], SQL[name], sf_dir)
    assert ok, note


def test_stages_keep_clean_documents_and_columns(spark, sf_dir, docs):
    lines = [f"alpha{i} beta{i * 7} gamma{i * 3} delta{i * 5}" for i in range(30)]
    clean = " ".join(lines)
    near = clean.replace("beta7 ", "changed ")
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first()["text"]
    rows = [(1, clean), (2, near), (3, clean), (4, " ".join(reversed(lines)) + " mail a.b@example.com now"), (5, clean.replace("a", "o") + " " + item), (6, None), (7, "short")]
    table = docs(rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        table = stage(spark, table, sf_dir)
        assert table.columns == docs([]).columns
        table = spark.createDataFrame(table.collect(), table.schema)
        left = [r.doc_id for r in by_id(table)]
        assert left == {"quality_rules": [1, 2, 3, 4, 5], "near_duplicates": [1, 4, 5], "decontaminated": [1, 4], "personal_data": [1, 4]}[name]
    assert by_id(table)[1].text == " ".join(reversed(lines)) + " mail [EMAIL] now"
    mixed = corpus_pipeline.STAGES[-1][1](spark, table, sf_dir)
    assert {r.doc_id for r in mixed.collect()} <= {1, 4}


def test_stages_take_columns_of_any_name(spark, sf_dir, docs, wide):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(40))) for i in range(3)] + [(4, None)]
    for name, stage in corpus_pipeline.STAGES:
        table = wide(docs(rows))
        out = stage(spark, table, sf_dir)
        assert set(out.columns) >= set(table.columns), name
        assert {r.doc_id for r in out.collect()} >= ({0, 1, 2} if name != "mixed" else set()), name


def test_empty_documents_pass_through(spark, sf_dir, docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs([]), sf_dir).collect() == []
