from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from table_rows import rows
from lakesales.plans import erp_warehouse as P
from lakesales.plans import unified_warehouse as W
from lakesales.schemas import AGG_SALES, ERP
from lakesales.sources import landing, readers

T0 = dt.datetime(2024, 1, 10, 8, 30)


@pytest.fixture(scope="module")
def erp(spark):
    make = spark.createDataFrame
    return {
        "OINV": make([(1, "C1", T0, None, None, D("100"), D("0.2")), (2, "c2 ", T0, None, "usd", D("50"), D("50")),
                      (3, "NOBODY", T0, T0, "EUR", D("7"), None)], ERP["OINV"]),
        "INV1": make([(1, 0, "I1", D("2"), D("10")), (1, 1, "i1 ", D("8"), D("10")), (2, 0, "I2", D("1"), D("50")),
                      (3, 0, "NONE", D("1"), D("7")), (99, 0, "I1", D("1"), D("1"))], ERP["INV1"]),
        "ORIN": make([(1, "C1", T0, None, "COL", D("20"), None)], ERP["ORIN"]),
        "RIN1": make([(1, 0, "I1", D("2"), D("10"))], ERP["RIN1"]),
        "OCRD": make([("C1", "Ana", "C", "Z1", "CR"), ("C1", "Ana", "C", "Z1", "CR"), ("C2", "Bea", "S", "Z9", None),
                      ("C3", "Cai", "L", None, None)], ERP["OCRD"]),
        "ZONAS": make([("z1 ",), ("Z2",)], ERP["ZONAS"]),
        "OITM": make([("I1", "Item 1", "B", D("5")), ("I2", "Item 2", None, D("0"))], ERP["OITM"]),
        "OITW": make([("I1", "W1", D("4")), ("I1", "W2", D("4"))], ERP["OITW"]),
    }


RATES = [(dt.date(2023, 12, 31), D("500")), (dt.date(2024, 1, 2), D("510")), (dt.date(2024, 1, 4), None)]


def test_calendar_fills_from_the_newest_earlier_row(spark):
    rates = spark.createDataFrame(RATES, "Fecha date, TipoCambio_USD_CRC decimal(18,6)")
    cal = P.calendar_fx(P.date_bounds(spark, "2024-01-01", "2024-01-06"), rates).orderBy("DateKey").collect()
    assert [r.TipoCambio_USD_CRC for r in cal] == [D("500"), D("510"), D("510"), D("510"), None, None]
    assert [r.DateKey for r in cal][:2] == [20240101, 20240102] and cal[0].QuarterName == "Q1"
    assert [r.IsBusinessDay for r in cal] == [True] * 5 + [False]
    early = P.calendar_fx(P.date_bounds(spark, "2023-12-30", "2023-12-31"), rates).orderBy("DateKey").collect()
    assert [r.TipoCambio_USD_CRC for r in early] == [None, D("500")]


def test_calendar_span_is_checked(spark):
    assert P.date_spine(P.date_bounds(spark, "2024-01-02", "2024-01-01")).count() == 0
    with pytest.raises(Exception, match="span too long"):
        P.date_spine(P.date_bounds(spark, "0001-01-01", "2024-01-01")).collect()


def test_dimensions(spark, erp):
    cust = P.dim_customer(erp["OCRD"], erp["ZONAS"])
    got = {r.CardCode: r for r in cust.collect()}
    assert set(got) == {"AGG000", "C1", "C2"} and got["AGG000"].CustomerKey == 1
    assert sorted(r.CustomerKey for r in got.values()) == [1, 2, 3]
    assert (got["C1"].Zone, got["C2"].Zone) == ("z1 ", None)
    prod = P.dim_product(erp["OITM"], erp["OITW"])
    assert rows(prod.select("ItemCode", "AvgPrice")) == [("I1", D("4.0000")), ("I2", None)]
    split = erp["OITW"].unionByName(spark.createDataFrame([("I1", "W3", D("10"))], ERP["OITW"]))
    assert P.dim_product(erp["OITM"], split).count() == 3
    assert P.dim_product(erp["OITM"], split, "avg").where("ItemCode = 'I1'").first().AvgPrice == D("6.0000")


def test_fact_branches(spark, erp):
    cust, prod = P.dim_customer(erp["OCRD"], erp["ZONAS"]), P.dim_product(erp["OITM"], erp["OITW"])
    cur = P.dim_currency(spark)
    inv = P.fact_invoices(erp["OINV"], erp["INV1"], cust, prod, cur)
    keys = {r.CardCode: r.CustomerKey for r in cust.collect()}
    items = {r.ItemCode: r.ProductKey for r in prod.collect()}
    got = rows(inv.select("DateKey", "CustomerKey", "ProductKey", "CurrencyKey", "Qty", "DocTotal_CRC", "DocTotal_USD"))
    assert got == sorted([
        (20240110, keys["C1"], items["I1"], 1, D("2.0000"), D("100.0000"), D("0.2000")),
        (20240110, keys["C1"], items["I1"], 1, D("8.0000"), D("100.0000"), D("0.2000")),
        (20240110, keys["C2"], items["I2"], 2, D("1.0000"), D("50.0000"), D("50.0000")),
        (20240110, 1, None, None, D("1.0000"), D("7.0000"), None)], key=repr)
    note = P.fact_credit_notes(erp["ORIN"], erp["RIN1"], cust, prod, cur).first()
    assert (note.Qty, note.UnitPrice, note.DocTotal_CRC, note.DocTotal_USD) == (D("-2"), D("10"), D("-20"), None)
    by_line = P.fact_invoices(erp["OINV"], erp["INV1"], cust, prod, cur, grain="line")
    assert by_line.agg(F.sum("DocTotal_CRC")).first()[0] == D("100.0000")
    assert by_line.agg(F.sum("DocTotal_USD")).first()[0] == D("50.0000")


def test_whole_warehouse_runs_twice(spark, erp, tmp_path):
    agg = spark.createDataFrame([(2024, 1, [("I1", D("2"), D("3")), ("?", D("1"), D("1"))]), (2024, 2, [("I2", D("1"), D("2"))]),
                                 (2024, 13, [("I2", D("1"), D("2"))]), (2024, 1, [])], AGG_SALES)
    rates = spark.createDataFrame(RATES, "Fecha date, TipoCambio_USD_CRC decimal(18,6)")
    bounds = P.date_bounds(spark, "2024-01-01", "2024-01-31")
    for _ in range(2):
        out = P.run_sales_dw(spark, erp, rates, agg, bounds, str(tmp_path / "dw"))
    fact = out["Fact_Sales"]
    assert fact.count() == 8 and fact.select("SalesKey").distinct().count() == 8
    monthly = fact.where("UnitPrice in (3, 1, 2)").orderBy("DateKey", "Qty").collect()
    assert [(r.DateKey, r.CustomerKey, r.DocTotal_CRC, r.DocTotal_USD) for r in monthly] == [
        (20240101, 1, D("500"), D("1")), (20240101, 1, D("3000"), D("6")), (20240201, 1, D("2"), D("2"))]
    qa = P.qa_pack(fact, out["DimCustomer"], out["DimProduct"])
    assert qa["totals"].first().Filas == 8
    assert qa["null_keys"].first().ProductKey_null == 2 and qa["customer_orphans"].first().n == 0
    # invoices less credit notes plus monthly sales
    assert qa["totals"].first().Total_CRC == D("257") - D("20") + D("3502")


def test_two_prices_stop_the_run(spark, erp, tmp_path):
    bad = dict(erp, OITW=erp["OITW"].unionByName(spark.createDataFrame([("I1", "W3", D("9"))], ERP["OITW"])))
    rates = spark.createDataFrame(RATES, "Fecha date, TipoCambio_USD_CRC decimal(18,6)")
    with pytest.raises(ValueError, match="several stock prices"):
        P.run_sales_dw(spark, bad, rates, spark.createDataFrame([], AGG_SALES), P.date_bounds(spark, "2024-01-01", "2024-01-02"),
                       str(tmp_path / "dw"))


# --- five sources -----------------------------------------------------------------------------
@pytest.fixture(scope="module")
def five(spark):
    make = spark.createDataFrame
    customers = landing.unify([
        landing.land_customers("SQL Server", make([(1, "Ana", "Ana@x.co", "Femenino", "CR", dt.date(2024, 1, 1))],
                               "ClienteId int, Nombre string, Email string, Genero string, Pais string, FechaRegistro date")),
        landing.land_customers("MySQL", make([(1, " Beto ", None, "M", "CR", "2024-02-01"), (2, "Mal", None, "X", "CR", "01/02/2024")],
                               "id int, nombre string, correo string, genero string, pais string, created_at string")),
        landing.land_customers("Supabase", make([("u1", "Cai", "c@x.co", "M", "PA", dt.date(2024, 3, 1))],
                               "cliente_id string, nombre string, email string, genero string, pais string, fecha_registro date")),
        landing.land_customers("MongoDB", make([("m1", "Dov", None, "Otro", "CR", T0)],
                               "_id string, nombre string, email string, genero string, pais string, creado timestamp_ntz")),
        landing.land_customers("Neo4j", make([("C-1", "Eva", None)], "id string, nombre string, email string"))])
    products = landing.unify([
        landing.land_products("SQL Server", make([(10, "S1", "Pan", "Comida"), (11, "S2", "Té", "Bebida"), (12, "S3", "Té", "Bebida")],
                              "ProductoId int, SKU string, Nombre string, Categoria string")),
        landing.land_products("MySQL", make([(20, "A1", "pan", "comida"), (21, "A2", "x", "y"), (22, "A3", "té", "bebida")],
                              "id int, codigo_alt string, nombre string, categoria string")),
        landing.land_products("Supabase", make([("p1", "S2", "Té", "Bebida"), ("p2", "", "Pan", "Comida"), ("p3", None, "Té", "Bebida")],
                              "producto_id string, sku string, nombre string, categoria string")),
        landing.land_products("MongoDB", make([("m1", None, "M1", "Té", "Bebida", ("S3", "A2")), ("m2", "M2", None, "Pan", "Comida", None)],
                              "_id string, codigo string, codigo_mongo string, nombre string, categoria string, equivalencias struct<sku:string,codigo_alt:string>")),
        landing.land_products("Neo4j", make([("P-1", "Uva", "Fruta", None, None, "M1"), ("P-2", "Uva", "Fruta", "S9", None, None)],
                              "id string, nombre string, categoria string, sku string, codigo_alt string, codigo_mongo string"))])
    return customers, products


def test_customers_of_five_sources(five):
    good, rejects = W.clean_customers(five[0])
    got = {(r.FuenteOrigen, r.ClienteID_Natural): r for r in good.collect()}
    assert len(got) == 5
    assert (got["MySQL", "1"].Nombre, got["MySQL", "1"].Genero) == ("Beto", "Masculino")
    assert got["MongoDB", "m1"].FechaRegistro == T0.date() and got["MongoDB", "m1"].Genero == "No Especificado"
    assert (got["Neo4j", "C-1"].Pais, got["Neo4j", "C-1"].FechaRegistro) == ("No Especificado", dt.date(1900, 1, 1))
    assert got["SQL Server", "1"].Email == "ana@x.co"
    assert rows(rejects.select("row", "field")) == [("2", "FechaRegistro")]


def test_customers_without_key_are_all_reported(spark):
    raw = spark.createDataFrame([(None, "Ana", None), (None, "Ana", None), ("C-1", "Eva", None), ("C-1", "Eva", "e@x.co")],
                                "id string, nombre string, email string")
    good, rejects = W.clean_customers(landing.land_customers("Neo4j", raw))
    assert [(r.ClienteID_Natural, r.Email) for r in good.collect()] == [("C-1", "e@x.co")]
    assert rejects.where("field = 'ClienteID_Natural'").count() == 2


def test_products_of_five_sources(five):
    dim = W.dim_producto(five[1])
    assert rows(dim.select("SKU_Oficial", "FuenteOrigen")) == [
        ("S1", "SQL Server"), ("S2", "SQL Server"), ("S3", "SQL Server"), ("S9", "Neo4j")]
    resolved = W.resolve_products(five[1], dim)
    got = {(r.FuenteOrigen, r.producto_id): (r.SKU_Oficial, r.resolved_by, r.motivo) for r in resolved.collect()}
    assert got["MySQL", "20"] == ("S1", "nombre", None)
    assert got["MySQL", "21"] == ("S3", "codigo_alt", None)
    assert got["MySQL", "22"] == (None, None, "ambiguous")
    assert got["Supabase", "p1"] == ("S2", "SKU", None) and got["Supabase", "p2"] == ("S1", "nombre", None)
    assert got["Supabase", "p3"] == (None, None, "ambiguous")
    assert got["MongoDB", "m2"] == ("S1", "nombre", None)
    assert got["Neo4j", "P-1"] == ("S3", "codigo_mongo", None)
    bridge = W.product_bridge(resolved)
    assert {("MySQL", "A1", "S1"), ("MongoDB", "M2", "S1"), ("Neo4j", "P-2", "S9")} <= set(map(tuple, bridge.collect()))


def test_sales_of_five_sources(spark, five, tmp_path):
    make = spark.createDataFrame
    lines = landing.unify([
        landing.land_lines("SQL Server", make([(1, 1, T0, "WEB", "USD", D("9"))], "OrdenId int, ClienteId int, Fecha timestamp_ntz, Canal string, Moneda string, Total decimal(18,2)"),
                           make([(1, 1, 10, 2, D("10.00"), D("25"))], "OrdenDetalleId int, OrdenId int, ProductoId int, Cantidad int, PrecioUnit decimal(18,2), DescuentoPct decimal(5,2)")),
        landing.land_lines("MySQL", make([(1, 1, "2024-01-10 08:00:00", " web ", "CRC", "1,000.00"), (2, 1, "2024-01-31", "web", "CRC", "1")],
                                         "id int, cliente_id int, fecha string, canal string, moneda string, total string"),
                           make([(1, 1, 20, 3, "1,000.00"), (2, 2, 20, 1, "5"), (3, 1, 22, 1, "abc")],
                                "id int, orden_id int, producto_id int, cantidad int, precio_unit string")),
        landing.land_lines("MongoDB", make([("o1", "m1", "2024-01-10T23:00:00Z", "APP", "CRC", [("m2", 1, D("1020"), D("50"))]), ("o2", "m1", "2024-01-10", "APP", "CRC", [])],
                                           "_id string, cliente_id string, fecha string, canal string, moneda string, "
                                           "items array<struct<producto_id:string,cantidad:int,precio_unit:decimal(18,2),descuento_pct:decimal(5,2)>>")),
        landing.land_lines("Neo4j", make([(("C-9", "?", None), ("O-1", "2024-01-10", "WEB", "USD", D("1")), [(("P-2", "Uva", None), 0, D("1.005"))])],
                                         "cliente struct<id:string,nombre:string,email:string>, orden struct<id:string,fecha:string,canal:string,moneda:string,total:decimal(18,2)>, "
                                         "items array<struct<producto:struct<id:string,nombre:string,categoria:string>,cantidad:int,precio_unit:decimal(18,3)>>"))])
    customers, products = W.dim_cliente(five[0]), W.dim_producto(five[1])
    channels = W.dim_canal(lines)
    assert sorted(r.NombreCanal for r in channels.collect()) == ["APP", "WEB"]
    rates = make([(dt.date(2024, 1, 9), D("510"))], "Fecha date, TipoCambio_USD_CRC decimal(18,6)")
    cal = P.calendar_fx(P.date_bounds(spark, "2024-01-01", "2024-01-20"), rates)
    checked = W.check_sales(lines, customers, W.product_lookup(W.resolve_products(five[1], products), products), channels, cal)
    fact = W.fact_ventas(checked)
    assert rows(fact.select("FuenteOrigen", "TotalVentaUSD", "PrecioUnitUSD", "Cantidad", "TiempoID")) == sorted([
        ("SQL Server", D("15.00"), D("10.00"), 2, 20240110), ("MySQL", D("5.88"), D("1.96"), 3, 20240110),
        ("MongoDB", D("1.00"), D("2.00"), 1, 20240110)], key=repr)
    errors = checked.select("FuenteOrigen", F.explode("errors").alias("e")).select("FuenteOrigen", "e.field", "e.rule")
    assert rows(errors) == sorted([
        ("MySQL", "fecha", "rate"), ("MySQL", "precio_unit", "format"), ("MySQL", "producto_id", "reference"),
        ("Neo4j", "Cantidad", "range"), ("Neo4j", "ClienteID_Natural", "reference")], key=repr)


    out = W.run_unified_dw(five[0], five[1], lines, cal, str(tmp_path / "udw"))
    assert rows(out["FactVentas"].select("TotalVentaUSD")) == rows(fact.select("TotalVentaUSD"))
    assert out["FactVentas"].select("VentaID").distinct().count() == 3 and out["rechazos"].count() == 3
    assert out["DimTiempo"].count() == 20


# --- files ------------------------------------------------------------------------------------
def test_rates_file_with_mark_and_crlf(spark, tmp_path):
    file = tmp_path / "rates.csv"
    file.write_bytes("﻿Fecha,TipoCambio_USD_CRC\r\n2024-01-01 00:00:00,511.24\r\n2024-01-02 00:00:00,\r\n".encode())
    got, bad = readers.split_corrupt(readers.read_rates(spark, str(file)))
    assert bad.count() == 0
    assert rows(got, "Fecha") == [(dt.date(2024, 1, 1), D("511.240000")), (dt.date(2024, 1, 2), None)]


def test_array_file_and_missing_fields(spark, tmp_path):
    file = tmp_path / "agg.json"
    file.write_text('[{"anio": 2024, "mes": 1, "ventas": [{"item": "a", "cantidad": 2}]},\n {"anio": 2024, "mes": 2, "ventas": []}]')
    got = readers.read_agg_sales(spark, str(file), json_lines=False)
    assert rows(got.select("mes", F.size("ventas"))) == [(1, 1), (2, 0)]
    assert got.where("mes = 1").first().ventas[0].precio is None


def test_documents_keep_unreadable_text(spark, tmp_path):
    file = tmp_path / "c.json"
    file.write_text('{"_id": "1", "nombre": "Ana", "preferencias": {"canal": ["WEB", "APP"], "n": 5}}\n{"_id": \n')
    got = readers.read_documents(spark, str(file), "clientes").cache()
    assert got.where("_corrupt_record is not null").count() == 1
    assert got.where("_id = '1'").first().preferencias == {"canal": '["WEB", "APP"]', "n": "5"}


def test_read_any(spark, tmp_path):
    file = tmp_path / "x.CSV"
    file.write_text("a,b\n1,2\n")
    assert rows(readers.read_any(spark, str(file))) == [("1", "2")]
    for name in ("x.xlsx", "x.xls", "x.txt", "x"):
        with pytest.raises(ValueError, match="Unsupported file format"):
            readers.read_any(spark, str(tmp_path / name))


def test_row_numbers_over_splits(spark, tmp_path):
    for name in ("one", "two"):
        lines = "".join(f"{name}-{i},{i}\n" + ("\n" if i % 10 == 0 else "") for i in range(1, 2001))
        (tmp_path / f"{name}.csv").write_text("k,v\n" + lines)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        got = readers.read_loader_csv(spark, str(tmp_path))
        assert got.rdd.getNumPartitions() > 3
        assert got.count() == 4000 and got.where("_row <> cast(v as int)").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_loader_files_with_other_header_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\n1,2\n")
    (tmp_path / "b.csv").write_text("v,k\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_loader_csv(spark, str(tmp_path)).collect()


def test_reload_with_fewer_months_leaves_nothing_old(spark, tmp_path):
    fact = spark.createDataFrame([(20240115, 1), (20240215, 2)], "DateKey int, CustomerKey int")
    path = str(tmp_path / "fact")
    assert P.write_fact(fact, path).count() == 2
    assert [r.Month for r in P.write_fact(fact.where("CustomerKey = 1"), path).collect()] == [1]


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from lakesales import session

    class Far:
        class sparkContext:
            master = "yarn"

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Far)
