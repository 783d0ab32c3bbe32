"""Registered queries: against SQL where there is some, over empty tables, over tables of edge cases."""

from __future__ import annotations

import duckdb
import pytest

import check
import corpus_pipeline
from lakesales.llm import queries as llm

SF = "/root/testdata/sf0.001"
NAMES = [*llm.QUERIES, "pipeline"]


def run(spark, name, at):
    return (corpus_pipeline.run if name == "pipeline" else llm.QUERIES[name])(spark, at)


def compare(spark, name, at):
    db = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark"):
        try:
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{at}/{t}.parquet{'' if at == SF else '/*.parquet'}'")
        except duckdb.IOException:
            assert t == "pages"
    cur = db.execute(llm.SQL[name])
    want = check._rows([c[0] for c in cur.description], cur.fetchall())
    df = run(spark, name, at)
    assert check._rows(df.columns, [tuple(r) for r in df.collect()]) == want


@pytest.mark.parametrize("name", list(llm.SQL))
def test_query_matches_sql(spark, name):
    compare(spark, name, SF)


def test_all_operators_and_the_pipeline_are_registered():
    import __spark_entry__ as entry

    assert [n.split("_")[0] for n in sorted(llm.QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == [
        f"op{i}" for i in range(1, 14)]
    assert {*llm.QUERIES, "pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(spark, empty_dir, name):
    df = run(spark, name, empty_dir)
    assert df.collect() == [] and len(df.columns) > 1


@pytest.mark.parametrize("name", [n for n in NAMES if n != "op1_url_filters"])
def test_edge_tables_return_every_document(spark, edge_dir, name):
    n = len(run(spark, name, edge_dir).collect())
    if name not in ("op2_decontamination", "op9_token_counts", "op10_best_fit_packing", "op11_source_divergence",
                    "op13_filter_audit", "pipeline"):
        assert n == spark.read.parquet(f"{edge_dir}/documents.parquet").count()


@pytest.mark.parametrize("name", ["op11_source_divergence", "op13_filter_audit"])
def test_audits_of_edge_tables_match_sql(spark, edge_dir, name):
    compare(spark, name, edge_dir)


def test_native_operators_run_no_python(spark):
    for name in ("op1_url_filters", "op6_sharding", "op8_exact_dedup"):
        plan = llm.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
        assert "BroadcastNestedLoopJoin" not in plan
