"""Steps that large tables pass once, or with few columns."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from lakesales.checks import shapes as S
from lakesales.operators import locale
from lakesales.plans import erp_warehouse as P
from lakesales.plans import unified_warehouse as W
from lakesales.schemas import ERP, LANDED_CUSTOMERS, LANDED_LINES, LANDED_PRODUCTS
from lakesales.sources import sinks
from table_rows import rows


def plan(df, kind="executedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def test_lines_are_dealt_out_once_for_monthly_records(spark, tmp_path):
    day = dt.datetime(2024, 1, 5)
    sinks.write_table(spark.createDataFrame(
        [(1, 2.0, 10.0, day), (1, 3.0, 12.0, day), (2, 1.0, 5.0, day), (501, 4.0, 7.0, day), (None, 1.0, 1.0, day),
         (1, 6.0, 9.0, dt.datetime(2024, 2, 1)), (1, 1.0, 1.0, None)],
        "l_partkey bigint, l_quantity double, l_extendedprice double, l_shipdate timestamp"), f"{tmp_path}/lineitem.parquet")
    t = S.Tables(spark, str(tmp_path))
    assert plan(S.agg_records(t)).count("hashpartitioning") == 1
    got = S.agg_sales(t).select("anio", "mes", F.explode("ventas").alias("v")).select("anio", "mes", "v.*")
    assert rows(got, "anio", "mes", "item") == [
        (None, None, "P1", D(1), D(1)), (2024, 1, None, D(1), D(1)), (2024, 1, "P1", D(5), D(12)),
        (2024, 1, "P2", D(1), D(5)), (2024, 1, "P501", D(4), D(7)), (2024, 2, "P1", D(6), D(9))]
    assert S.agg_records(t).count() == 5


def test_products_are_looked_up_before_lines_meet_headers(spark):
    make = spark.createDataFrame
    heads = make([(1, "C1", dt.datetime(2024, 1, 10), None, "USD", D(100), D(2))], ERP["OINV"])
    lines = make([(1, 0, "I1", D(2), D(10)), (1, 1, None, D(1), D(3)), (9, 0, "I1", D(1), D(1))], ERP["INV1"])
    customers = make([(1, "AGG000"), (2, "C1")], "CustomerKey bigint, CardCode string")
    products = make([(5, "i1 ")], "ProductKey bigint, ItemCode string")
    fact = P.fact_invoices(heads, lines, customers, products, P.dim_currency(spark))
    joins = [line for line in plan(fact, "optimizedPlan").splitlines() if "Join " in line]
    assert "Join Inner" in joins[0]
    assert rows(fact.select("CustomerKey", "ProductKey", "Qty"), "Qty") == [(2, None, D(1)), (2, 5, D(2))]


def test_amount_texts_are_parsed_once(spark):
    df = spark.createDataFrame([("en", "1,234.50", 1), ("es", "7,5", 2), (None, " ", 3)], "_file string, t string, n int")
    got = locale.read_amounts(df, {"t": "v"})
    assert "RLIKE" not in plan(got, "optimizedPlan")
    assert got.columns == ["_file", "t", "n", "v_locale", "v"]
    assert rows(got.select("n", "v_locale", "v"), "n") == [(1, "en", D("1234.50")), (2, "es", D("7.5")), (3, "unknown", None)]


def test_lines_are_not_dealt_out_by_day(spark, tmp_path):
    make, day = spark.createDataFrame, dt.date(2024, 1, 2)
    landed = make([(s, "o1", "c1", "p1", "2024-01-02", " web", "CRC", "2", "10.00", None) for s in ("MySQL", "Neo4j")],
                  ", ".join(f"{c} string" for c in LANDED_LINES))
    who = make([("MySQL", "c1", "Ana", "a@b.co", "F", "CR", "2024-01-01")], ", ".join(f"{c} string" for c in LANDED_CUSTOMERS))
    what = make([("MySQL", "p1", "A1", "S1", "A1", None, "Uno", "x")], ", ".join(f"{c} string" for c in LANDED_PRODUCTS))
    cal = make([(day, D(500)), (day, D(500))], "DateValue date, TipoCambio_USD_CRC decimal(18,6)").distinct()
    out = W.run_unified_dw(who, what, landed, cal, str(tmp_path))
    assert rows(spark.read.parquet(f"{tmp_path}/staging/Calendario")) == [(day, D(500))]
    assert rows(out["FactVentas"].select("TiempoID", "ClienteID", "ProductoID", "CanalID", "TotalVentaUSD")) == [
        (20240102, 1, 1, 1, D("0.04"))]
    assert [r.FuenteOrigen for r in out["rechazos"].collect()] == ["Neo4j"]
