"""Queries of the unified warehouse and its cleaning functions."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesales.checks import shapes as S
from lakesales.checks.shapes import FX, SALES, UNIFIED, Tables, cte
from lakesales.functions import conform, dates, money
from lakesales.operators.joins import match_by_name, resolve_sku
from lakesales.plans import erp_warehouse as P
from lakesales.plans import unified_warehouse as W


class Unified:
    def __init__(self, t: Tables):
        self.t = t

    @cached_property
    def customers(self) -> DataFrame:
        return self.t.store(W.dim_cliente(S.landed_customers(self.t)), "DimCliente")

    @cached_property
    def landed_products(self) -> DataFrame:
        return S.landed_products(self.t)

    @cached_property
    def products(self) -> DataFrame:
        return self.t.store(W.dim_producto(self.landed_products), "DimProducto")

    @cached_property
    def resolved(self) -> DataFrame:
        return self.t.store(W.resolve_products(self.landed_products, self.products), "Resueltos")

    @cached_property
    def lookup(self) -> DataFrame:
        return self.t.store(W.product_lookup(self.resolved, self.products), "ProductoLookup")

    @cached_property
    def channels(self) -> DataFrame:
        return self.t.store(W.dim_canal(self.t.orders.select(S.raw_channel().alias("canal"))), "DimCanal")

    @cached_property
    def calendar(self) -> DataFrame:
        return self.t.store(P.calendar_fx(S.order_bounds(self.t), S.rates(self.t)), "Calendario")

    @cached_property
    def checked(self) -> DataFrame:
        return W.check_sales(S.landed_lines(self.t), self.customers, self.lookup, self.channels,
                             self.calendar)


def customers(spark, d):
    return Unified(Tables(spark, d)).customers.select(
        "ClienteID", "FuenteOrigen", "ClienteID_Natural", "Nombre", "Email", "Genero", "Pais",
        F.col("FechaRegistro").cast("string").alias("FechaRegistro"))


def products(spark, d):
    return Unified(Tables(spark, d)).products.select(
        "ProductoID", "SKU_Oficial", "Nombre", "Categoria", "FuenteOrigen")


def resolved(spark, d):
    return Unified(Tables(spark, d)).resolved.select(
        "FuenteOrigen", "producto_id", "SKU_Oficial", "resolved_by", "motivo")


def bridge(spark, d):
    return W.product_bridge(Unified(Tables(spark, d)).resolved)


def channels(spark, d):
    return Unified(Tables(spark, d)).channels.select("CanalID", "NombreCanal")


def sales(spark, d):
    out = W.fact_ventas(Unified(Tables(spark, d)).checked)
    ints = ["TiempoID", "ClienteID", "ProductoID", "CanalID", "Cantidad"]
    return out.select(*[F.col(c).cast("bigint").alias(c) for c in ints], "OrdenID_Natural",
                      "MonedaOrigen", "FuenteOrigen",
                      *S.double("TotalVentaUSD", "PrecioUnitUSD", "DescuentoPct"))


def rejects(spark, d):
    """Refused lines by source and reason."""
    checked = Unified(Tables(spark, d)).checked
    errors = checked.select("FuenteOrigen", F.explode("errors").alias("e"))
    return errors.groupBy("FuenteOrigen", F.col("e.field").alias("field"), F.col("e.rule").alias("rule"),
                          ).agg(F.count("*").alias("lineas"))


def usd_by_month(spark, d):
    """Unified sales per source and month."""
    fact = W.fact_ventas(Unified(Tables(spark, d)).checked)
    return fact.groupBy("FuenteOrigen", F.floor(F.col("TiempoID") / 100).alias("mes")).agg(
        F.sum("TotalVentaUSD").cast("double").alias("usd"), F.sum("Cantidad").alias("unidades"))


def clean_money(spark, d):
    """Prices as text with thousands marks, decimal commas, symbols or nothing; back to numbers."""
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    english = F.format_number(price, 2)
    spanish = F.translate(english, ",.", ".,")
    text = (F.when(F.col("l_linenumber") == 7, F.concat(F.lit("abc "), english))
            .when(F.col("l_linenumber") == 6, F.concat(F.lit("₡ "), english))
            .when(F.col("l_linenumber") == 5, F.format_number(price, 0))
            .when(F.col("l_returnflag") == "A", english)
            .when(F.col("l_returnflag") == "R", spanish)
            .when(F.col("l_linestatus") == "O", F.translate(price.cast("string"), ".", ","))
            .otherwise(price.cast("string")))
    return Tables(spark, d).lines.select(
        "l_orderkey", "l_partkey", "l_linenumber",
        money.parse_money(text).cast("double").alias("monto"),
        money.parse_money(spanish, "es").cast("double").alias("monto_es"))


def clean_dates(spark, d):
    """Ship dates in the three accepted layouts, and impossible ones."""
    ship = F.col("l_shipdate")
    text = (F.when(F.col("l_linenumber") == 7, F.date_format(ship, "yyyy-'13'-dd"))
            .when(F.col("l_linenumber") == 6, F.date_format(ship, "dd/MM/yyyy"))
            .when(F.col("l_returnflag") == "A", F.date_format(ship, "yyyy-MM-dd"))
            .when(F.col("l_returnflag") == "R", F.date_format(ship, "yyyy-MM-dd HH:mm:ss"))
            .otherwise(F.date_format(ship, " yyyy-MM-dd'T'HH:mm:ss'Z' ")))
    return Tables(spark, d).lines.select(
        "l_orderkey", "l_partkey", "l_linenumber",
        F.date_format(dates.parse_date_text(text), "yyyy-MM-dd HH:mm:ss").alias("fecha"))


def unify_gender(spark, d):
    return Tables(spark, d).customer.select("c_custkey", conform.unify_gender(S.raw_gender()).alias("genero"))


def channel_canonical(spark, d):
    return Tables(spark, d).orders.select("o_orderkey", conform.canonical_channel(S.raw_channel()).alias("canal"))


def to_usd(spark, d):
    """Order totals in CRC or USD to USD at the order day's rate."""
    t = Tables(spark, d)
    cal = P.calendar_fx(S.order_bounds(t), S.rates(t))
    currency = F.when(F.col("o_orderstatus") == "F", "USD").when(F.col("o_orderstatus") == "O", "col")
    code = conform.canonical_currency(F.coalesce(currency, F.lit("EUR")))
    rows = t.orders.withColumn("d", F.to_date("o_orderdate")).join(
        cal.select(F.col("DateValue").alias("d"), "TipoCambio_USD_CRC"), "d", "left")
    return rows.select("o_orderkey", money.to_usd(F.col("o_totalprice").cast("decimal(18,2)"), code,
                                                  "TipoCambio_USD_CRC").cast("double").alias("usd"))


def resolve(spark, d):
    """Codes of upload lines by priority: official SKU, alternate code, document code."""
    t = Tables(spark, d)
    dim = t.part.where("p_type <> 'PROMO'").select(S.code("SKU-", "p_partkey").alias("SKU_Oficial"))
    known = t.part.where("p_type <> 'SMALL'")
    sku = S.code("SKU-", "p_partkey").alias("SKU_Oficial")
    bridge = known.select(F.lit("MySQL").alias("FuenteOrigen"),
                          S.code("ALT-", "p_partkey").alias("CodigoFuente"), sku).unionByName(
        t.part.where("p_size > 25").select(F.lit("MongoDB").alias("FuenteOrigen"),
                                           S.code("MN-", "p_partkey").alias("CodigoFuente"), sku))
    override = t.part.where("p_brand = 'Brand#7'").select(
        S.code("sku-", "p_partkey").alias("codigo"), F.lit("SKU-0").alias("SKU_Oficial"))
    lines = t.lines.select(
        "l_orderkey", "l_partkey", "l_linenumber",
        F.when(F.col("l_linestatus") == "O", F.concat(F.lit("sku-"), "l_partkey", F.lit(" "))).otherwise("").alias("sku"),
        F.when(F.col("l_returnflag") != "N", S.code("ALT-", "l_partkey")).alias("codigo_alt"),
        F.when(F.col("l_returnflag") != "A", S.code("MN-", "l_partkey")).alias("codigo_mongo"))
    return resolve_sku(lines, bridge, dim, override).select(
        "l_orderkey", "l_partkey", "l_linenumber", "SKU_Oficial", "resolved_by")


def by_name(spark, d):
    """Parts without a code matched on name and category, ambiguous ones refused."""
    t = Tables(spark, d)
    dim = t.part.where("p_size <= 40").select(
        S.code("SKU-", "p_partkey").alias("SKU_Oficial"), F.col("p_name").alias("Nombre"),
        S.category().alias("Categoria"))
    rows = t.part.select("p_partkey", F.concat(F.lit(" "), F.upper("p_name")).alias("nombre"),
                         F.concat(S.category(), F.lit("  ")).alias("categoria"))
    return match_by_name(rows, dim).select("p_partkey", "SKU_Oficial", "motivo")


def targets(spark, d):
    """Monthly targets from raw text, refused ones by reason."""
    t = Tables(spark, d)
    raw = t.lineitem.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("string").alias("ClienteID"), F.col("l_partkey").cast("string").alias("ProductoID"),
        F.year("l_shipdate").cast("string").alias("Anio"),
        F.when(F.col("l_linenumber") == 7, "13").otherwise(F.month("l_shipdate").cast("string")).alias("Mes"),
        F.when(F.col("l_linenumber") == 6, "n/a").otherwise(F.col("l_extendedprice").cast("string")).alias("MetaUSD"))
    known = t.customer.where("c_acctbal >= 0").select(F.col("c_custkey").alias("ClienteID"))
    parts = t.part.where("p_type <> 'SMALL'").select(F.col("p_partkey").alias("ProductoID"))
    good, refused = W.load_targets(raw, known, parts)
    return good.select(F.lit("accepted").alias("motivo")).unionByName(
        refused.select("motivo")).groupBy("motivo").agg(F.count("*").alias("filas"))


QUERIES = {
    "unified_customers": customers, "unified_products": products, "product_resolution": resolved,
    "product_bridge": bridge, "dim_channel": channels, "unified_sales": sales,
    "unified_rejects": rejects, "unified_usd_by_month": usd_by_month, "clean_money": clean_money,
    "clean_dates": clean_dates, "unify_gender": unify_gender, "channel_canonical": channel_canonical,
    "to_usd": to_usd, "resolve_sku": resolve, "match_by_name": by_name, "targets_load": targets,
}

_PID = """CASE Fuente WHEN 'Supabase' THEN 'U-' || p_partkey WHEN 'MongoDB' THEN 'M-' || p_partkey
  WHEN 'Neo4j' THEN 'P-' || p_partkey ELSE CAST(p_partkey AS VARCHAR) END"""
_CODE = """CASE Fuente WHEN 'SQL Server' THEN 'SKU-' || p_partkey WHEN 'MySQL' THEN 'ALT-' || p_partkey
  WHEN 'Supabase' THEN 'U-' || p_partkey WHEN 'MongoDB' THEN 'MN-' || p_partkey ELSE 'P-' || p_partkey END"""
_OK = "ProductoID IS NOT NULL AND (MonedaOrigen = 'USD' OR rate_u IS NOT NULL)"


def _half_up(num: str, den: str) -> str:
    return f"((2 * ({num}) + ({den})) // (2 * ({den})))"


_TOTAL_CENTS = f"""CASE MonedaOrigen WHEN 'USD' THEN
  {_half_up('cents * Cantidad * (100 - coalesce(DescuentoPct, 0))', 'CAST(100 AS HUGEINT)')}
  ELSE {_half_up('cents * Cantidad * (100 - coalesce(DescuentoPct, 0)) * 1000000', '100 * rate_u')} END"""
_PRICE_CENTS = f"""CASE MonedaOrigen WHEN 'USD' THEN cents
  ELSE {_half_up('cents * 1000000', 'rate_u')} END"""

SQL = {
    "unified_customers": cte("src", "dimcli") + "SELECT * FROM dimcli",
    "unified_products": cte("dimpro") + """SELECT ProductoID, SKU_Oficial, Nombre, Categoria,
        'SQL Server' AS FuenteOrigen FROM dimpro""",
    "product_resolution": cte(*UNIFIED[2:]) + f"""SELECT Fuente AS FuenteOrigen, {_PID} AS producto_id, SKU_Oficial,
        resolved_by, motivo FROM product_ids""",
    "product_bridge": cte(*UNIFIED[2:]) + f"""SELECT Fuente AS FuenteOrigen, {_CODE} AS CodigoFuente, SKU_Oficial
        FROM product_ids WHERE SKU_Oficial IS NOT NULL""",
    "dim_channel": cte("canales") + "SELECT * FROM canales",
    "unified_sales": cte(*SALES) + f"""SELECT TiempoID, ClienteID, ProductoID, CanalID, Cantidad, OrdenID_Natural,
        MonedaOrigen, FuenteOrigen, CAST({_TOTAL_CENTS} AS DOUBLE) / 100 AS TotalVentaUSD,
        CAST({_PRICE_CENTS} AS DOUBLE) / 100 AS PrecioUnitUSD, CAST(DescuentoPct AS DOUBLE) AS DescuentoPct
        FROM sales WHERE {_OK}""",
    "unified_rejects": cte(*SALES) + """SELECT FuenteOrigen, 'producto_id' AS field, 'reference' AS rule,
        count(*) AS lineas FROM sales WHERE ProductoID IS NULL GROUP BY 1
        UNION ALL SELECT FuenteOrigen, 'fecha', 'rate', count(*) FROM sales
        WHERE MonedaOrigen = 'CRC' AND rate_u IS NULL GROUP BY 1""",
    "unified_usd_by_month": cte(*SALES) + f"""SELECT FuenteOrigen, TiempoID // 100 AS mes,
        CAST(sum({_TOTAL_CENTS}) AS DOUBLE) / 100 AS usd, CAST(sum(Cantidad) AS BIGINT) AS unidades
        FROM sales WHERE {_OK} GROUP BY 1, 2""",
    "clean_money": """SELECT l_orderkey, l_partkey, l_linenumber, CASE l_linenumber WHEN 7 THEN NULL
        WHEN 5 THEN round_even(l_extendedprice, 0) ELSE l_extendedprice END AS monto,
        l_extendedprice AS monto_es FROM lineitem""",
    "clean_dates": """SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_linenumber < 6
        THEN strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') END AS fecha FROM lineitem""",
    "unify_gender": """SELECT c_custkey, CASE WHEN c_nationkey < 4 OR c_nationkey BETWEEN 8 AND 10 THEN 'Masculino'
        WHEN c_nationkey < 8 OR c_nationkey BETWEEN 11 AND 13 THEN 'Femenino' ELSE 'No Especificado' END AS genero
        FROM customer""",
    "channel_canonical": """SELECT o_orderkey, CASE o_orderpriority WHEN '2-HIGH' THEN 'APP'
        WHEN '3-MEDIUM' THEN 'TIENDA' WHEN '4-NOT SPECIFIED' THEN 'PARTNER' ELSE 'WEB' END AS canal FROM orders""",
    "to_usd": cte(*FX) + f"""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN o_totalprice WHEN 'O' THEN CAST({_half_up(
        'CAST(round(o_totalprice * 100) AS HUGEINT) * 1000000', 'CAST(rate * 1000000 AS HUGEINT)')} AS DOUBLE) / 100 END
        AS usd FROM orders LEFT JOIN fx ON d = CAST(o_orderdate AS DATE)""",
    "resolve_sku": """SELECT l_orderkey, l_partkey, l_linenumber, CASE how WHEN 'override' THEN 'SKU-0'
        WHEN '' THEN NULL ELSE 'SKU-' || l_partkey END AS SKU_Oficial, nullif(how, '') AS resolved_by FROM (
        SELECT l_orderkey, l_partkey, l_linenumber,
        CASE WHEN l_linestatus = 'O' AND p_brand = 'Brand#7' THEN 'override'
             WHEN l_linestatus = 'O' AND p_type <> 'PROMO' THEN 'SKU'
             WHEN l_returnflag <> 'N' AND p_type <> 'SMALL' THEN 'codigo_alt'
             WHEN l_returnflag <> 'A' AND p_size > 25 THEN 'codigo_mongo' ELSE '' END AS how
        FROM lineitem JOIN part ON l_partkey = p_partkey)""",
    "match_by_name": """WITH d AS (SELECT p_name AS n, p_type || ' ' || p_brand || ' ' || p_size AS c, count(*) AS k,
        min('SKU-' || p_partkey) AS sku FROM part WHERE p_size <= 40 GROUP BY 1, 2)
        SELECT p_partkey, CASE WHEN k = 1 THEN sku END AS SKU_Oficial,
        CASE WHEN k IS NULL THEN 'no match' WHEN k > 1 THEN 'ambiguous' END AS motivo
        FROM part LEFT JOIN d ON n = p_name AND c = p_type || ' ' || p_brand || ' ' || p_size""",
    "targets_load": """SELECT CASE WHEN l_linenumber = 6 THEN 'missing or unreadable field'
        WHEN l_linenumber = 7 THEN 'month must be 1..12' WHEN c_acctbal < 0 THEN 'customer not found'
        WHEN p_type = 'SMALL' THEN 'product not found' ELSE 'accepted' END AS motivo, count(*) AS filas
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN part ON l_partkey = p_partkey GROUP BY 1""",
}
