"""Queries of the worked star schema."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesales.checks import shapes as S
from lakesales.checks.shapes import ERP_ALL, ERP_DIMS, FX, Tables, cte
from lakesales.functions.nested import agg_sales_rows
from lakesales.functions.text import norm_key
from lakesales.operators import aggregates as A
from lakesales.operators.changes import shift_years
from lakesales.operators.joins import asof_backward, star_lookup
from lakesales.operators.keys import assign_keys
from lakesales.plans import erp_warehouse as P
from lakesales.plans.unified_warehouse import time_dimension
from lakesales.session import scratch_path

MEASURES = ["Qty", "UnitPrice", "DocTotal_CRC", "DocTotal_USD"]
KEYS = ["DateKey", "CustomerKey", "ProductKey", "CurrencyKey"]


class Erp:
    """The warehouse over the given tables; dimensions are stored before facts use them."""

    def __init__(self, t: Tables):
        self.t = t

    @cached_property
    def customers(self) -> DataFrame:
        return self.t.store(P.dim_customer(S.ocrd(self.t), S.zonas(self.t)), "DimCustomer")

    @cached_property
    def products(self) -> DataFrame:
        return self.t.store(P.dim_product(S.oitm(self.t), S.oitw(self.t)), "DimProduct")

    @cached_property
    def currencies(self) -> DataFrame:
        return P.dim_currency(self.t.spark)

    @cached_property
    def calendar(self) -> DataFrame:
        return self.t.store(P.calendar_fx(S.order_bounds(self.t), S.rates(self.t)), "DimDate")

    def branch(self, returned: bool) -> DataFrame:
        build = P.fact_credit_notes if returned else P.fact_invoices
        return build(S.erp_headers(self.t), S.erp_lines(self.t, returned), self.customers, self.products, self.currencies)

    def monthly(self) -> DataFrame:
        return P.fact_monthly(S.agg_sales(self.t), self.customers, self.products, self.currencies, self.calendar)


_LOADED: dict[tuple[str, str], dict[str, DataFrame]] = {}


def loaded(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The warehouse over the given tables as reports find it: loaded by the first one of a session, and stored."""
    at = (spark.sparkContext.applicationId, d)
    if at not in _LOADED:
        t = Tables(spark, d)
        _LOADED[at] = P.run_sales_dw(spark, S.erp_tables(t), S.rates(t), S.agg_sales(t), S.order_bounds(t),
                                     scratch_path(spark, "sales_dw"))
    return _LOADED[at]


def _fact_out(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(k).cast("bigint").alias(k) for k in KEYS], *S.double(*MEASURES))


def invoices(spark, d):
    return _fact_out(Erp(Tables(spark, d)).branch(False))


def credit_notes(spark, d):
    return _fact_out(Erp(Tables(spark, d)).branch(True))


def monthly(spark, d):
    return _fact_out(Erp(Tables(spark, d)).monthly())


def totals(spark, d):
    out = A.qa_totals(loaded(spark, d)["Fact_Sales"])
    return out.select(*S.double("Total_CRC", "Total_USD"), "Filas")


def by_customer(spark, d):
    dw = loaded(spark, d)
    return A.sales_by_customer(dw["Fact_Sales"], dw["DimCustomer"]).select("CardName", *S.double("Ventas_CRC"))


def by_product(spark, d):
    dw = loaded(spark, d)
    return A.sales_by_product(dw["Fact_Sales"], dw["DimProduct"]).select(
        "ItemCode", "ItemName", *S.double("Ventas_CRC"))


def fallback(spark, d):
    dw = loaded(spark, d)
    return A.fallback_audit(dw["Fact_Sales"], dw["DimCustomer"]).select(
        "CardCode", "CardName", "Filas", *S.double("Ventas_CRC"))


def null_keys(spark, d):
    dw = loaded(spark, d)
    return P.qa_pack(dw["Fact_Sales"], dw["DimCustomer"], dw["DimProduct"])["null_keys"]


def customers(spark, d):
    t = Tables(spark, d)
    return P.dim_customer(S.ocrd(t), S.zonas(t))


def products(spark, d):
    t = Tables(spark, d)
    return P.dim_product(S.oitm(t), S.oitw(t)).select(
        "ProductKey", "ItemCode", "ItemName", "Brand", *S.double("OnHand", "AvgPrice"))


def currencies(spark, d):
    """The currency dimension with the documents of each member."""
    t = Tables(spark, d)
    code = norm_key(F.coalesce("DocCur", F.lit("COL")))
    used = S.erp_headers(t).groupBy(code.alias("CurrencyCode")).agg(F.count("*").alias("documentos"))
    return P.dim_currency(spark).join(used, "CurrencyCode", "left").select(
        F.col("CurrencyKey").cast("bigint").alias("CurrencyKey"), "CurrencyCode", "Description",
        F.coalesce("documentos", F.lit(0)).alias("documentos"))


def count_by_year(spark, d):
    out = A.count_by_year(S.erp_headers(Tables(spark, d)), "DocDate")
    return out.select(F.col("Ano").cast("bigint").alias("Ano"), "Cant")


def shifted(spark, d):
    out = shift_years(S.erp_headers(Tables(spark, d)), ["DocDate", "DocDueDate"], 4)
    text = "yyyy-MM-dd HH:mm:ss"
    return out.select("DocEntry", F.date_format("DocDate", text).alias("DocDate"),
                      F.date_format("DocDueDate", text).alias("DocDueDate"))


def calendar(spark, d):
    ints = ["DateKey", "Year", "Quarter", "Month", "Day", "FiscalYear"]
    return P.calendar(S.order_bounds(Tables(spark, d))).select(
        *[F.col(c).cast("bigint").alias(c) for c in ints],
        F.col("DateValue").cast("string").alias("DateValue"), "MonthName", "QuarterName",
        F.col("IsBusinessDay").cast("bigint").alias("IsBusinessDay"))


def calendar_fx(spark, d):
    return Erp(Tables(spark, d)).calendar.select(
        F.col("DateValue").cast("string").alias("DateValue"), *S.double("TipoCambio_USD_CRC"))


def times(spark, d):
    ints = ["TiempoID", "Dia", "Mes", "Trimestre", "Anio", "DiaSemana"]
    return time_dimension(S.order_bounds(Tables(spark, d))).select(
        *[F.col(c).cast("bigint").alias(c) for c in ints],
        F.col("FechaCompleta").cast("string").alias("FechaCompleta"), "NombreMes",
        "NombreDiaSemana", "MesAnio", F.col("EsFinDeSemana").cast("bigint").alias("EsFinDeSemana"))


def asof_by_user(spark, d):
    """Every purchase with the newest earlier view of the same user."""
    events = Tables(spark, d).events
    bought = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    views = events.where("event_type = 'view'").select(
        "user_id", F.col("ts").alias("seen_at"), F.col("value").alias("seen_value"),
        F.col("event_id").alias("seen_event"))
    return asof_backward(bought, views, "ts", "seen_at", ["seen_event", "seen_value"],
                         by=["user_id"]).select("event_id", "user_id", "seen_event", "seen_value")


def asof_global(spark, d):
    """Every click with the newest signup of anyone at or before it."""
    events = Tables(spark, d).events
    clicks = events.where("event_type = 'click'").select("event_id", "ts")
    signups = events.where("event_type = 'signup'").select(
        F.col("ts").alias("signed_at"), F.col("event_id").alias("signup_event"))
    return asof_backward(clicks, signups, "ts", "signed_at", ["signup_event"], strict=False).select(
        "event_id", "signup_event")


def surrogate_keys(spark, d):
    return assign_keys(Tables(spark, d).part.select("p_partkey"), ["p_partkey"], "clave")


def agg_rows(spark, d):
    """Monthly records parsed from JSON and unnested."""
    return agg_sales_rows(S.agg_sales(Tables(spark, d))).select(
        F.col("anio").cast("bigint").alias("anio"), F.col("mes").cast("bigint").alias("mes"), "item",
        *S.double("cantidad", "precio", "TotalUSD"))


def case_join(spark, d):
    """Codes in mixed case with end blanks on both sides, joined through the normalised key."""
    t = Tables(spark, d)
    line = F.when(F.col("l_returnflag") == "A", F.concat(F.lit("pa-"), "l_partkey", F.lit("  ")))
    line = line.otherwise(F.concat(F.lit("Pa-"), "l_partkey"))
    part = F.when(F.col("p_type") == "SMALL", F.concat(F.lit("PA-"), "p_partkey", F.lit(" ")))
    part = part.otherwise(F.concat(F.lit("pA-"), "p_partkey"))
    lines = t.lineitem.select(line.alias("codigo"))
    dim = t.part.select(part.alias("codigo_dim"), "p_brand")
    per_code = lines.groupBy(norm_key("codigo").alias("codigo")).agg(F.count("*").alias("lineas"))
    found = star_lookup(per_code, dim, F.col("codigo"), "codigo_dim", ["p_brand"])
    return found.select("codigo", "p_brand", "lineas")


QUERIES = {
    "sales_by_customer": by_customer, "fact_invoices": invoices, "fact_credit_notes": credit_notes,
    "fact_json_agg": monthly, "fact_sales_totals": totals, "sales_by_product": by_product,
    "fallback_audit": fallback, "fact_null_keys": null_keys, "dim_customer": customers,
    "dim_product": products, "dim_currency": currencies, "count_by_year": count_by_year,
    "shift_years": shifted, "calendar": calendar, "calendar_fx": calendar_fx,
    "time_dimension": times, "asof_by_user": asof_by_user, "asof_global": asof_global,
    "surrogate_keys": surrogate_keys, "agg_sales_rows": agg_rows,
    "case_insensitive_join": case_join,
}

_DOC_OUT = """SELECT DateKey, CustomerKey, ProductKey, CurrencyKey, CAST({s}Qty AS DOUBLE) AS Qty,
  CAST(UnitPrice AS DOUBLE) AS UnitPrice, CAST({s}DocTotal AS DOUBLE) AS DocTotal_CRC,
  CAST({s}DocTotalFC AS DOUBLE) AS DocTotal_USD FROM docs WHERE {w}"""

SQL = {
    "sales_by_customer": cte(*ERP_ALL) + """SELECT CardName, CAST(sum(crc) AS DOUBLE) AS Ventas_CRC
        FROM fact f LEFT JOIN dimc c ON f.CustomerKey = c.CustomerKey GROUP BY CardName""",
    "fact_invoices": cte(*ERP_DIMS) + _DOC_OUT.format(s="", w="NOT ret"),
    "fact_credit_notes": cte(*ERP_DIMS) + _DOC_OUT.format(s="-", w="ret"),
    "fact_json_agg": cte("dimp", *FX, "monthly") + """SELECT DateKey, CustomerKey, ProductKey, CurrencyKey,
        CAST(Qty AS DOUBLE) AS Qty, CAST(UnitPrice AS DOUBLE) AS UnitPrice,
        CAST(crc AS DOUBLE) AS DocTotal_CRC, CAST(usd AS DOUBLE) AS DocTotal_USD FROM monthly""",
    "fact_sales_totals": cte(*ERP_ALL) + """SELECT CAST(sum(crc) AS DOUBLE) AS Total_CRC,
        CAST(sum(usd) AS DOUBLE) AS Total_USD, count(*) AS Filas FROM fact""",
    "sales_by_product": cte(*ERP_ALL) + """SELECT ItemCode, ItemName, CAST(sum(crc) AS DOUBLE) AS Ventas_CRC
        FROM fact f LEFT JOIN dimp p ON f.ProductKey = p.ProductKey GROUP BY ItemCode, ItemName""",
    "fallback_audit": cte(*ERP_ALL) + """SELECT CardCode, CardName, count(*) AS Filas,
        CAST(sum(crc) AS DOUBLE) AS Ventas_CRC FROM fact f
        LEFT JOIN dimc c ON f.CustomerKey = c.CustomerKey GROUP BY CardCode, CardName""",
    "fact_null_keys": cte(*ERP_ALL) + """SELECT count(*) FILTER (DateKey IS NULL) AS DateKey_null,
        count(*) FILTER (CustomerKey IS NULL) AS CustomerKey_null,
        count(*) FILTER (ProductKey IS NULL) AS ProductKey_null,
        count(*) FILTER (CurrencyKey IS NULL) AS CurrencyKey_null FROM fact""",
    "dim_customer": cte("dimc") + "SELECT * FROM dimc",
    "dim_product": cte("dimp") + "SELECT * FROM dimp",
    "dim_currency": cte("hdr") + """SELECT k AS CurrencyKey, c AS CurrencyCode, t AS Description,
        (SELECT count(*) FROM hdr WHERE upper(rtrim(coalesce(DocCur, 'COL'))) = c) AS documentos
        FROM (VALUES (1, 'COL', 'Colones'), (2, 'USD', 'Dólares')) v(k, c, t)""",
    "count_by_year": """SELECT year(o_orderdate) AS Ano, count(*) AS Cant FROM orders GROUP BY 1""",
    "shift_years": """SELECT o_orderkey AS DocEntry,
        strftime(o_orderdate + INTERVAL 4 YEAR, '%Y-%m-%d %H:%M:%S') AS DocDate,
        CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate + INTERVAL 4 YEAR, '%Y-%m-%d %H:%M:%S') END
        AS DocDueDate FROM orders""",
    "calendar": cte("cal") + """SELECT year(d) * 10000 + month(d) * 100 + day(d) AS DateKey,
        CAST(d AS VARCHAR) AS DateValue, year(d) AS "Year", quarter(d) AS "Quarter", month(d) AS "Month",
        day(d) AS "Day", monthname(d) AS MonthName, 'Q' || quarter(d) AS QuarterName,
        CASE WHEN dayofweek(d) IN (0, 6) THEN 0 ELSE 1 END AS IsBusinessDay, year(d) AS FiscalYear FROM cal""",
    "calendar_fx": cte(*FX) + """SELECT CAST(d AS VARCHAR) AS DateValue,
        CAST(rate AS DOUBLE) AS TipoCambio_USD_CRC FROM fx""",
    "time_dimension": cte("cal") + """SELECT year(d) * 10000 + month(d) * 100 + day(d) AS TiempoID,
        CAST(d AS VARCHAR) AS FechaCompleta, day(d) AS Dia, month(d) AS Mes, quarter(d) AS Trimestre,
        year(d) AS Anio, ['enero','febrero','marzo','abril','mayo','junio','julio','agosto','septiembre',
        'octubre','noviembre','diciembre'][month(d)] AS NombreMes,
        ['domingo','lunes','martes','miércoles','jueves','viernes','sábado'][dayofweek(d) + 1] AS NombreDiaSemana,
        dayofweek(d) + 1 AS DiaSemana, CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS EsFinDeSemana,
        strftime(d, '%Y-%m') AS MesAnio FROM cal""",
    "asof_by_user": """SELECT p.event_id, p.user_id, v.m.e AS seen_event, v.m.v AS seen_value
        FROM (SELECT * FROM events WHERE event_type = 'purchase') p
        ASOF LEFT JOIN (SELECT user_id, ts, max({'e': event_id, 'v': value}) AS m FROM events
          WHERE event_type = 'view' GROUP BY 1, 2) v ON p.user_id = v.user_id AND p.ts > v.ts""",
    "asof_global": """SELECT c.event_id, s.e AS signup_event
        FROM (SELECT * FROM events WHERE event_type = 'click') c
        ASOF LEFT JOIN (SELECT ts, max(event_id) AS e FROM events WHERE event_type = 'signup' GROUP BY 1) s
        ON c.ts >= s.ts""",
    "surrogate_keys": """SELECT p_partkey, row_number() OVER (
        ORDER BY md5(CAST(p_partkey AS VARCHAR)), p_partkey) AS clave FROM part""",
    "agg_sales_rows": """SELECT year(m) AS anio, month(m) AS mes, 'P' || l_partkey AS item, q AS cantidad,
        p AS precio, CAST(CAST(q AS DECIMAL(12,0)) * CAST(p AS DECIMAL(9,2)) AS DOUBLE) AS TotalUSD FROM (
        SELECT date_trunc('month', l_shipdate) AS m, l_partkey, sum(l_quantity) AS q,
        max(l_extendedprice) AS p FROM lineitem GROUP BY 1, 2)""",
    "case_insensitive_join": """SELECT 'PA-' || l_partkey AS codigo, p_brand, count(*) AS lineas
        FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""",
}
