"""Every registered query against its SQL, and what their plans must not hold."""

from __future__ import annotations

import re

import duckdb
import pytest

import check
from lakesales.checks import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    db = duckdb.connect()
    for t in check.TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return db


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query_matches_sql(spark, con, name):
    df = registry.QUERIES[name](spark, SF)
    cur = con.execute(registry.SQL[name])
    want = check._rows([c[0] for c in cur.description], cur.fetchall())
    assert check._rows(df.columns, [tuple(r) for r in df.collect()]) == want
    plan = df._jdf.queryExecution().executedPlan().toString()
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert banned not in plan, f"{banned} in the plan of {name}"


@pytest.mark.parametrize("name", ["orders_nested", "graph_edges", "graph_nodes", "items_exploded", "line_amounts",
                                  "order_item_counts", "scan_documents", "scan_graph", "to_response", "order_amounts",
                                  "validate_documents"])
def test_documents_of_three_lines_change_no_query(spark, con, monkeypatch, name):
    from lakesales.operators import keys

    monkeypatch.setattr(keys, "MAX_ITEMS", 3)
    df = registry.QUERIES[name](spark, SF)
    cur = con.execute(registry.SQL[name])
    want = check._rows([c[0] for c in cur.description], cur.fetchall())
    assert check._rows(df.columns, [tuple(r) for r in df.collect()]) == want


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.SQL)


def physical(df) -> str:
    return df._jdf.queryExecution().explainString(
        df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_filters_and_columns_reach_the_scan(spark):
    plan = physical(registry.QUERIES["filter_category"](spark, SF))
    assert "EqualTo(p_type,SMALL)" in plan and "ReadSchema: struct<p_partkey:bigint,p_type:string>" in plan
    plan = physical(registry.QUERIES["filter_date_range"](spark, SF))
    assert "GreaterThanOrEqual(ts," in plan and "LessThanOrEqual(ts," in plan
    plan = physical(registry.QUERIES["page_orders"](spark, SF))
    assert "TakeOrderedAndProject" in plan


def test_customer_lookup_runs_on_headers(spark):
    """Only one join sees the lines before the product lookup."""
    plan = physical(registry.QUERIES["fact_invoices"](spark, SF))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    lines = [s for s in schemas if "l_orderkey" in s]
    assert len(lines) == 1 and "l_tax" not in lines[0] and "l_shipdate" not in lines[0]


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    from lakesales.operators.joins import join_lines
    from lakesales.sources.sinks import save_bucketed

    for name in ("heads", "rows"):
        spark.sql(f"DROP TABLE IF EXISTS {name}_by_doc")
    heads = save_bucketed(spark.range(1000).withColumnRenamed("id", "DocEntry"), "heads_by_doc", "DocEntry", 4)
    lines = save_bucketed(spark.range(3000).selectExpr("id % 1000 as DocEntry", "id as n"), "rows_by_doc", "DocEntry", 4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_lines(lines, heads)
        assert joined.count() == 3000 and "Exchange" not in physical(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
