"""Amounts that do not fit, locales of whole files, constraints of whole systems."""

from __future__ import annotations

from decimal import Decimal as D

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakesales.functions import money
from lakesales.operators import aggregates as A
from lakesales.operators import locale
from lakesales.plans import constraints as C
from lakesales.plans import loader as L
from lakesales.schemas import MSSQL_LOADER
from table_rows import rows


def test_nothing_is_rounded_on_the_way_in(spark):
    texts = ["1", " 12.34 ", "12.3400", "12.345", "-0.01", "1e1", "15%", "abc", "", None, "0.00000000000000000001",
             "123456", "1000000", "+7.5"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(money.exact_text("t", 8, 2)).collect()]
    assert got == [D("1"), D("12.34"), D("12.34"), None, D("-0.01"), None, None, None, None, None, None, D("123456"), None, D("7.5")]


def test_amounts_that_do_not_fit_leave_no_total(spark):
    lines = spark.createDataFrame([
        ("a", D("2.00000090"), "1", "0"), ("a", D("1"), "1", "0"), ("b", D("10"), "2", None), ("c", D("10"), "2", "abc"),
        ("d", D("10"), "2", "12.34567"), ("e", D("10"), "1.0000001", "0"), ("f", D("10"), "2", "10")],
        "k string, p decimal(20,8), q string, pct string")
    got = A.line_totals(lines, ["k"], F.col("p"), F.col("q"), F.col("pct")).select("k", "subtotal", "neto")
    assert rows(got, "k") == [("a", None, None), ("b", D("20.00"), D("20.00")), ("c", D("20.00"), None),
                              ("d", D("20.00"), None), ("e", None, None), ("f", D("20.00"), D("18.00"))]


@pytest.mark.parametrize("text,side", [
    ("1234", "same"), ("12.5", "en"), ("12,5", "es"), ("1,234.50", "en"), ("1.234,50", "es"), ("1.000", "either"), ("1,000", "either"),
    ("1.234", "es"), ("1,234", "en"), ("1.234.567", "es"), ("₡ 1.234,5", "es"), ("$1,000", "either"), ("12.34.56", None), ("x", None),
    ("", None), ("-1.000,00 CRC", "es"), ("0,00", "es"), ("1.0000", "en")])
def test_what_a_text_says_about_its_locale(spark, text, side):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(money.amount_side("t")).first()[0] == side


@settings(max_examples=12, deadline=None)
@given(st.sampled_from(["en", "es"]), st.lists(st.integers(-10**9, 10**9), min_size=1, max_size=8), st.booleans())
def test_a_column_with_one_telling_amount_is_read_back(spark, side, cents, grouped):
    texts = []
    for c in [*cents, 123456789]:  # the last one tells
        text = f"{D(c) / 100:,.2f}" if grouped else f"{D(c) / 100:.2f}"
        texts.append(text.translate(str.maketrans(",.", ".,")) if side == "es" else text)
    df = spark.createDataFrame([("f", t) for t in texts], "_file string, t string")
    got = sorted(r["v"] for r in locale.read_amounts(df, {"t": "v"}).collect())
    assert got == sorted(D(c) / 100 for c in [*cents, 123456789])


def test_files_are_decided_one_by_one(spark):
    df = spark.createDataFrame([
        ("en", "1,234.50", "5"), ("en", "1.000", "1.5"), ("es", "1.000", None), ("es", "7,5", ""), ("mixed", "7,5", "1,5"),
        ("mixed", "7.5", "x"), ("mixed", "1.000", "2"), ("none", "1.000", " "), ("none", "12", "3"), (None, "1,5", "1.5")],
        "_file string, a string, b string")
    found = locale.detect_locales(df, ["a", "b"])
    assert {(r["_file"], r["columna"]): r["locale"] for r in found.collect()} == {
        ("en", "a"): "en", ("en", "b"): "en", ("es", "a"): "es", ("es", "b"): "unknown", ("mixed", "a"): "mixed",
        ("mixed", "b"): "es", ("none", "a"): "unknown", ("none", "b"): "unknown", (None, "a"): "es", (None, "b"): "en"}
    got = {(r["_file"], r["a"]): r["v"] for r in locale.read_amounts(df, {"a": "v"}).collect()}
    assert got == {("en", "1,234.50"): D("1234.50"), ("en", "1.000"): D(1), ("es", "1.000"): D(1000), ("es", "7,5"): D("7.5"),
                   ("mixed", "7,5"): D("7.5"), ("mixed", "7.5"): D("7.5"), ("mixed", "1.000"): None, ("none", "1.000"): None,
                   ("none", "12"): D(12), (None, "1,5"): D("1.5")}
    assert locale.read_amounts(df, {"a": "v"}, default="es").where("_file = 'none' and a = '1.000'").first()["v"] == D(1000)


def test_loader_refuses_discounts_that_do_not_fit(spark):
    texts = ["12.34", "12.345", "10.005", "15%", "abc", "101", " ", "5.0"]
    raw = spark.createDataFrame([("f", i, t) for i, t in enumerate(texts)], "_file string, _row int, DescuentoPct string")
    raw = raw.withColumns({c: F.lit(None).cast("string") for c in MSSQL_LOADER if c != "DescuentoPct"})
    customers = spark.createDataFrame([], "ClienteID int, email string")
    bridge = spark.createDataFrame([], "FuenteOrigen string, CodigoFuente string, SKU_Oficial string")
    checked = L.check_rows(raw, "mssql", customers, bridge, bridge.select("SKU_Oficial"))
    bad = L.dry_run(checked).where("field = 'DescuentoPct'").select("row", "rule")
    assert rows(bad) == [(1, "format"), (2, "format"), (3, "format"), (4, "format"), (5, "range")]


def _system(spark):
    clients = spark.createDataFrame([("c1", "a@b.c"), ("c2", "a@b.c"), ("c2", None), (None, None)], "cliente_id string, email string")
    orders = spark.createDataFrame([("o1", "c1"), ("o2", "c9"), ("o2", None), ("o3", "c9")], "orden_id string, cliente_id string")
    return {name: df.withColumns({c: F.lit("x") for c in C.TABLES["Supabase", name].fields if c not in df.columns})
            for name, df in (("cliente", clients), ("orden", orders))}


def test_a_system_is_checked_together(spark):
    broken = C.check_tables(_system(spark), "Supabase").where("rule in ('unique', 'reference')")
    assert rows(broken.select("tabla", "row", "field", "rule", "message")) == [
        ("cliente", "a@b.c", "email", "unique", "occurs 2 times"), ("cliente", "c2", "cliente_id", "unique", "occurs 2 times"),
        ("orden", "o2", "cliente_id", "reference", "not in cliente"), ("orden", "o2", "orden_id", "unique", "occurs 2 times"),
        ("orden", "o3", "cliente_id", "reference", "not in cliente")]


def test_every_table_is_read_once(spark, tmp_path, monkeypatch):
    frames = {}
    for name, df in _system(spark).items():
        df.write.parquet(str(tmp_path / name))
        frames[name] = spark.read.parquet(str(tmp_path / name))
    plans = []
    monkeypatch.setattr(C, "write_table", lambda df, path: plans.append(
        df._jdf.queryExecution().executedPlan().toString()) or before(df, path))
    from lakesales.sources.sinks import write_table as before
    out = C.check_tables(frames, "Supabase")
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    # the tables themselves, and after that only what was written of them
    assert plans[0].count("FileScan parquet") == len(frames)
    assert all("FileScan parquet" in plan and "cliente_id#" not in plan for plan in plans[1:])
    assert "Exchange" not in plans[0] and plans[1].count("Exchange hashpartitioning") == 1


def test_keys_of_several_columns_and_of_other_number_types(spark):
    bridge = spark.createDataFrame([("a|b", "c", "S1"), ("a", "b|c", "S2"), ("x", "y", "S1"), ("x", "y", "S9"), (None, "y", "S1")],
                                   "FuenteOrigen string, CodigoFuente string, SKU_Oficial string")
    skus = spark.createDataFrame([("S1",), ("S2",)], "SKU_Oficial string")
    broken = C.check_table(bridge, "warehouse", "MapProducto", {"DimProducto": skus}).where("rule in ('unique', 'reference')")
    assert rows(broken.select("row", "field", "rule")) == [
        ("x|y", "FuenteOrigen,CodigoFuente", "unique"), ("y", "SKU_Oficial", "reference")]
    targets = spark.createDataFrame([(1, D("7.00"), 5, 2024, 1, 1.0), (2, D("8.50"), 5, 2024, 1, 1.0)],
                                    "MetaID int, ClienteID decimal(10,2), ProductoID int, Anio int, Mes int, MetaUSD double")
    known = {"DimCliente": spark.createDataFrame([(7,), (8,)], "ClienteID bigint"), "DimProducto": spark.createDataFrame([(5.0,)], "ProductoID double")}
    broken = C.check_table(targets, "warehouse", "MetasVentas", known)
    assert rows(broken.select("row", "field", "rule")) == [("2", "ClienteID", "reference")]
