"""The given tables in the shapes the operators take, and the same shapes as SQL fragments.

Every shape is derived from whole tables by plain column expressions.
"""

from __future__ import annotations

from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesales.operators.keys import nest_items
from lakesales.schemas import VENTAS
from lakesales.session import scratch_path
from lakesales.sources.readers import spread
from lakesales.sources.sinks import write_table

AMOUNT = "decimal(18,4)"
MONEY = "decimal(18,2)"
MAX_SALES_PER_RECORD = 500


class Tables:
    """The given tables by name; each is opened once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        setattr(self, name, df)
        return df

    @cached_property
    def lines(self) -> DataFrame:
        """The line table for work that is heavy per row."""
        return spread(self.lineitem)

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """Written to the shared folder and read back, as a dimension is before facts use it."""
        return write_table(df, scratch_path(self.spark, name))


def code(prefix: str, col: str) -> Column:
    return F.concat(F.lit(prefix), F.col(col).cast("string"))


def double(*names: str) -> list[Column]:
    return [F.col(n).cast("double").alias(n) for n in names]


def pick(col: str, values: dict, default=None) -> Column:
    out = None
    for key, value in values.items():
        out = (F if out is None else out).when(F.col(col) == key, value)
    return out.otherwise(default)


# --- ERP --------------------------------------------------------------------------------------
DOC_CUR = {"1-URGENT": "USD", "2-HIGH": "EUR", "3-MEDIUM": "COL", "4-NOT SPECIFIED": "usd "}


def erp_headers(t: Tables) -> DataFrame:
    total = F.col("o_totalprice").cast(AMOUNT)
    return t.orders.select(
        F.col("o_orderkey").alias("DocEntry"), code("C", "o_custkey").alias("CardCode"),
        F.col("o_orderdate").alias("DocDate"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("DocDueDate"),
        pick("o_orderpriority", DOC_CUR).alias("DocCur"), total.alias("DocTotal"),
        (total * F.lit(Decimal("0.02"))).cast(AMOUNT).alias("DocTotalFC"))


def erp_lines(t: Tables, returned: bool) -> DataFrame:
    flag = F.col("l_returnflag") == "R"
    return t.lines.where(flag if returned else ~flag).select(
        F.col("l_orderkey").alias("DocEntry"), F.col("l_linenumber").alias("LineNum"),
        code("P", "l_partkey").alias("ItemCode"),
        F.col("l_quantity").cast(AMOUNT).alias("Quantity"),
        F.col("l_extendedprice").cast(AMOUNT).alias("Price"))


def ocrd(t: Tables) -> DataFrame:
    nation = t.nation.select("n_nationkey", "n_name")
    kind = F.when(F.col("c_acctbal") >= 0, "C").otherwise("L")
    customers = t.customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        code("C", "c_custkey").alias("CardCode"), F.col("c_name").alias("CardName"),
        kind.alias("CardType"), code("Z", "c_nationkey").alias("U_Zona"),
        F.col("n_name").alias("Country"))
    suppliers = t.supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        code("S", "s_suppkey").alias("CardCode"), F.col("s_name").alias("CardName"),
        F.lit("S").alias("CardType"), code("Z", "s_nationkey").alias("U_Zona"),
        F.col("n_name").alias("Country"))
    return customers.unionByName(suppliers)


def zonas(t: Tables) -> DataFrame:
    served = t.region.where(F.col("r_name").isin("AMERICA", "ASIA", "EUROPE"))
    return t.nation.join(served, F.col("n_regionkey") == F.col("r_regionkey")).select(
        code("Z", "n_nationkey").alias("Code"))


def oitm(t: Tables) -> DataFrame:
    return t.part.select(code("P", "p_partkey").alias("ItemCode"), F.col("p_name").alias("ItemName"),
                         F.col("p_brand").alias("u_mARCA"), F.col("p_size").cast(AMOUNT).alias("OnHand"))


def oitw(t: Tables) -> DataFrame:
    return t.part.where("p_type <> 'SMALL'").select(
        code("P", "p_partkey").alias("ItemCode"), F.lit("W1").alias("WhsCode"),
        F.col("p_retailprice").cast(AMOUNT).alias("AvgPrice"))


def erp_tables(t: Tables) -> dict[str, DataFrame]:
    return {"OINV": erp_headers(t), "ORIN": erp_headers(t), "INV1": erp_lines(t, False), "RIN1": erp_lines(t, True),
            "OCRD": ocrd(t), "ZONAS": zonas(t), "OITM": oitm(t), "OITW": oitw(t)}


def order_bounds(t: Tables) -> DataFrame:
    day = F.to_date("o_orderdate")
    return t.orders.agg(F.min(day).alias("start"), F.max(day).alias("end"))


def rates(t: Tables) -> DataFrame:
    """A rate on every ordering weekday; weekends are missing and the 7th has a row without rate."""
    days = t.orders.select(F.to_date("o_orderdate").alias("Fecha")).distinct()
    rate = (F.lit(500) + F.dayofmonth("Fecha") * F.lit(Decimal("0.91"))).cast("decimal(18,6)")
    return days.where(F.dayofweek("Fecha").between(2, 6)).select(
        "Fecha", F.when(F.dayofmonth("Fecha") != 7, rate).alias("TipoCambio_USD_CRC"))


def agg_records(t: Tables) -> DataFrame:
    """Monthly sales per item as (anio, mes, ventas) records with the sales as JSON text.

    Items are added up first, and a record holds one range of 500 part keys, so no array can
    grow with the data. Lines are dealt out by record once, which serves the sums of items and the
    records: an item has few lines in a month, so sums made before would be about as many.
    """
    lines = t.lines.select(
        F.trunc("l_shipdate", "month").alias("m"), F.floor(F.col("l_partkey") / MAX_SALES_PER_RECORD).alias("range"),
        "l_partkey", "l_quantity", "l_extendedprice").repartition("m", "range")
    sums = lines.groupBy("m", "range", "l_partkey").agg(
        F.sum(F.col("l_quantity").cast(AMOUNT)).alias("cantidad"),
        F.max(F.col("l_extendedprice").cast(AMOUNT)).alias("precio"))
    sale = F.struct(code("P", "l_partkey").alias("item"), F.col("cantidad").cast(AMOUNT).alias("cantidad"),
                    "precio")
    return sums.groupBy("m", "range").agg(F.to_json(F.collect_list(sale)).alias("ventas")).select(
        F.year("m").alias("anio"), F.month("m").alias("mes"), "ventas")


def agg_sales(t: Tables) -> DataFrame:
    return agg_records(t).withColumn("ventas", F.from_json("ventas", VENTAS))


# --- documents --------------------------------------------------------------------------------
def object_id(col: str) -> Column:
    return F.substring(F.md5(F.col(col).cast("string").cast("binary")), 1, 24)


def item(discount_factor: int = 100) -> Column:
    pct = (F.col("l_discount").cast("decimal(5,2)") * discount_factor).cast("decimal(5,2)")
    return F.struct(code("P", "l_partkey").alias("producto_id"),
                    F.col("l_quantity").cast("int").alias("cantidad"),
                    F.col("l_extendedprice").cast(MONEY).alias("precio_unit"),
                    pct.alias("descuento_pct"))


def nested_items(t: Tables, discount_factor: int = 100) -> DataFrame:
    return nest_items(t.lineitem, ["l_orderkey"], item(discount_factor))


def order_items(t: Tables, discount_factor: int = 100) -> DataFrame:
    """The items of all orders as rows."""
    return t.lineitem.select(object_id("l_orderkey").alias("_id"), item(discount_factor).alias("i")).select("_id", "i.*")


def order_heads(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey", object_id("o_orderkey").alias("_id"), code("C", "o_custkey").alias("cliente_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("fecha"),
        F.when(F.col("o_orderstatus") != "P", "WEB").alias("canal"),
        pick("o_orderpriority", {"1-URGENT": "USD", "2-HIGH": "USD"}, "CRC").alias("moneda"),
        F.col("o_totalprice").cast(MONEY).alias("total"))


def order_documents(t: Tables, discount_factor: int = 100) -> DataFrame:
    """All orders as stored documents, those without lines with an empty array."""
    head = order_heads(t)
    nested = nested_items(t, discount_factor)
    empty = F.array().cast(nested.schema["items"].dataType)
    joined = head.join(nested, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.select("_id", "cliente_id", "fecha", "canal", "moneda", "total",
                         F.coalesce("parte", F.lit(0)).alias("parte"), "primera",
                         F.coalesce("items", empty).alias("items"))


def graph_orders(t: Tables) -> DataFrame:
    """Orders with lines as nested graph payloads."""
    part = t.part.select("p_partkey", "p_name", "p_type")
    lines = t.lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
    element = F.struct(
        F.struct(code("P-", "l_partkey").alias("id"), F.col("p_name").alias("nombre"),
                 F.col("p_type").alias("categoria")).alias("producto"),
        F.col("l_quantity").cast("int").alias("cantidad"),
        F.col("l_extendedprice").cast(MONEY).alias("precio_unit"))
    nested = nest_items(lines, ["l_orderkey"], element)
    customer = t.customer.select("c_custkey", "c_name")
    head = t.orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey",
        F.struct(code("C-", "o_custkey").alias("id"), F.col("c_name").alias("nombre"),
                 F.lit(None).cast("string").alias("email")).alias("cliente"),
        F.struct(code("O-", "o_orderkey").alias("id"),
                 F.date_format("o_orderdate", "yyyy-MM-dd").alias("fecha"),
                 F.lit("WEB").alias("canal"), F.lit("CRC").alias("moneda"),
                 F.col("o_totalprice").cast(MONEY).alias("total")).alias("orden"))
    return nested.join(head, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "cliente", "orden", "parte", "items")


# --- five sources -----------------------------------------------------------------------------
SOURCE_OF_SEGMENT = {"MACHINERY": "SQL Server", "BUILDING": "MySQL", "AUTOMOBILE": "Supabase",
                     "FURNITURE": "MongoDB", "HOUSEHOLD": "Neo4j"}


def source_of(col: str = "c_mktsegment") -> Column:
    return pick(col, SOURCE_OF_SEGMENT)


def raw_gender() -> Column:
    n = F.col("c_nationkey")
    return (F.when(n < 4, "M").when(n < 8, "F").when(n < 11, "Masculino").when(n < 14, " femenino ")
            .when(n < 17, "X").when(n < 20, "Otro"))


def registered() -> Column:
    days = F.floor((F.col("c_acctbal") + 1000) / 10).cast("int")
    return F.date_add(F.lit("1995-01-01").cast("date"), days)


def landed_customers(t: Tables) -> DataFrame:
    source = source_of()
    email = F.concat(F.lit("C"), F.col("c_custkey").cast("string"), F.lit("@Example.com"))
    graph = source == "Neo4j"
    date = F.when(source == "MySQL", F.date_format(registered(), "yyyy-MM-dd"))
    date = date.when(source == "MongoDB", F.date_format(registered(), "yyyy-MM-dd'T'00:00:00'Z'"))
    date = date.otherwise(registered().cast("string"))
    return t.customer.select(
        source.alias("FuenteOrigen"), F.col("c_custkey").cast("string").alias("ClienteID_Natural"),
        F.concat(F.lit(" "), F.col("c_name")).alias("nombre"),
        F.when(F.col("c_acctbal") >= 0, email).alias("email"), raw_gender().alias("genero"),
        F.when(~graph, code("NATION_", "c_nationkey")).alias("pais"),
        F.when(~graph, date).alias("fecha_registro"))


def category() -> Column:
    return F.concat_ws(" ", "p_type", "p_brand", F.col("p_size").cast("string"))


def landed_products(t: Tables) -> DataFrame:
    """Every part as each of the five sources would list it, with the codes that source knows."""
    sku, alt, mongo = code("SKU-", "p_partkey"), code("ALT-", "p_partkey"), code("MN-", "p_partkey")
    kind = F.col("p_type")
    none = F.lit(None).cast("string")
    listed = [
        ("SQL Server", code("", "p_partkey"), sku, sku, none, none),
        ("MySQL", code("", "p_partkey"), alt, none, alt, none),
        ("Supabase", code("U-", "p_partkey"), code("U-", "p_partkey"),
         F.when(kind == "SMALL", "").when(kind == "PROMO", none).otherwise(sku), none, none),
        ("MongoDB", code("M-", "p_partkey"), mongo, F.when(~kind.isin("LARGE", "MEDIUM"), sku),
         F.when(kind != "MEDIUM", alt), mongo),
        ("Neo4j", code("P-", "p_partkey"), code("P-", "p_partkey"),
         F.when(kind != "ECONOMY", sku), none, mongo),
    ]
    entries = F.array(*[F.struct(
        F.lit(s).alias("FuenteOrigen"), pid.alias("producto_id"), own.alias("CodigoFuente"),
        k.cast("string").alias("sku"), a.cast("string").alias("codigo_alt"),
        m.cast("string").alias("codigo_mongo")) for s, pid, own, k, a, m in listed])
    return t.part.select(F.explode(entries).alias("e"), "p_name", category().alias("categoria")).select(
        "e.*", F.col("p_name").alias("nombre"), "categoria")


RAW_CHANNEL = {"1-URGENT": "WEB", "2-HIGH": " app ", "3-MEDIUM": "Tienda", "4-NOT SPECIFIED": "PARTNER",
               "5-LOW": "web"}


def raw_channel() -> Column:
    return pick("o_orderpriority", RAW_CHANNEL)


def landed_lines(t: Tables, discount: Column | None = None) -> DataFrame:
    """Every line as its customer's source would deliver it; `discount` stands in where it is not NULL."""
    who = t.customer.select("c_custkey", source_of().alias("FuenteOrigen"))
    s = F.col("FuenteOrigen")
    stamp = F.col("o_orderdate").cast("string")
    date = (F.when(s.isin("Supabase", "MongoDB"), F.concat(F.replace(stamp, F.lit(" "), F.lit("T")), F.lit("Z")))
            .when(s == "Neo4j", F.to_date("o_orderdate").cast("string")).otherwise(stamp))
    head = t.orders.join(who, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_custkey", date.alias("fecha"), raw_channel().alias("canal"), "FuenteOrigen")
    rows = t.lines.join(head, F.col("l_orderkey") == F.col("o_orderkey"))
    price = F.col("l_extendedprice").cast(MONEY)
    product = (F.when(s.isin("SQL Server", "MySQL"), code("", "l_partkey"))
               .when(s == "Supabase", code("U-", "l_partkey"))
               .when(s == "MongoDB", code("M-", "l_partkey")).otherwise(code("P-", "l_partkey")))
    currency = (F.when(s == "SQL Server", "USD").when(s == "MongoDB", "CRC")
                .when(F.col("l_linestatus") == "O", "CRC").otherwise("USD"))
    text = (F.when(s == "MySQL", F.format_number(price, 2))
            .when(s == "MongoDB", F.floor(price).cast("string")).otherwise(price.cast("string")))
    pct = F.round(F.col("l_discount") * 100).cast("int").cast("string")
    return rows.select(
        "FuenteOrigen", F.col("o_orderkey").cast("string").alias("OrdenID_Natural"),
        F.col("o_custkey").cast("string").alias("ClienteID_Natural"), product.alias("producto_id"),
        "fecha", "canal", currency.alias("moneda"),
        F.col("l_quantity").cast("int").cast("string").alias("cantidad"), text.alias("precio_unit"),
        F.coalesce(F.lit(None) if discount is None else discount,
                   F.when(s.isin("SQL Server", "MongoDB"), pct)).alias("descuento_pct"))


# --- the same shapes as SQL -------------------------------------------------------------------
def cte(*names: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({SQL[n].strip()})" for n in names) + " "


def hash_order(col: str) -> str:
    return f"md5({col}), {col}"


SQL = {
    "hdr": """SELECT o_orderkey AS DocEntry, 'C' || o_custkey AS CardCode, o_orderdate AS DocDate,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'USD' WHEN '2-HIGH' THEN 'EUR'
             WHEN '3-MEDIUM' THEN 'COL' WHEN '4-NOT SPECIFIED' THEN 'usd ' END AS DocCur,
        CAST(o_totalprice AS DECIMAL(18,4)) AS DocTotal,
        CAST(CAST(o_totalprice AS DECIMAL(14,2)) * CAST(0.02 AS DECIMAL(3,2)) AS DECIMAL(18,4)) AS DocTotalFC
        FROM orders""",
    "dimc": f"""SELECT 1 AS CustomerKey, 'AGG000' AS CardCode, 'AGGREGATED_CLIENT' AS CardName,
          'C' AS CardType, NULL AS Zone, NULL AS Country
        UNION ALL SELECT 1 + row_number() OVER (ORDER BY {hash_order('CardCode')}), CardCode, CardName,
          CardType, Zone, Country FROM (
          SELECT 'C' || c_custkey AS CardCode, c_name AS CardName, 'C' AS CardType, c_nationkey AS nk
          FROM customer WHERE c_acctbal >= 0
          UNION ALL SELECT 'S' || s_suppkey, s_name, 'S', s_nationkey FROM supplier) x
        JOIN (SELECT n_nationkey, n_name AS Country, CASE WHEN r_name IN ('AMERICA','ASIA','EUROPE')
              THEN 'Z' || n_nationkey END AS Zone
              FROM nation LEFT JOIN region ON n_regionkey = r_regionkey) n ON nk = n_nationkey""",
    "dimp": f"""SELECT row_number() OVER (ORDER BY {hash_order("'P' || p_partkey")}) AS ProductKey,
        'P' || p_partkey AS ItemCode, p_name AS ItemName, p_brand AS Brand,
        CAST(p_size AS DOUBLE) AS OnHand,
        CASE WHEN p_type <> 'SMALL' THEN p_retailprice END AS AvgPrice FROM part""",
    "head": """SELECT DocEntry, CAST(strftime(DocDate, '%Y%m%d') AS INTEGER) AS DateKey,
        coalesce(c.CustomerKey, 1) AS CustomerKey,
        CASE upper(rtrim(coalesce(DocCur, 'COL'))) WHEN 'COL' THEN 1 WHEN 'USD' THEN 2 END AS CurrencyKey,
        DocTotal, DocTotalFC FROM hdr LEFT JOIN dimc c ON c.CardCode = hdr.CardCode""",
    "docs": """SELECT h.DateKey, h.CustomerKey, p.ProductKey, h.CurrencyKey, l_returnflag = 'R' AS ret,
        CAST(l_quantity AS DECIMAL(18,4)) AS Qty, CAST(l_extendedprice AS DECIMAL(18,4)) AS UnitPrice,
        h.DocTotal, h.DocTotalFC
        FROM lineitem JOIN head h ON l_orderkey = h.DocEntry
        LEFT JOIN dimp p ON p.ItemCode = 'P' || l_partkey""",
    "rates": """SELECT DISTINCT CAST(o_orderdate AS DATE) AS f, CASE WHEN day(o_orderdate) <> 7
        THEN CAST(500 + day(o_orderdate) * 0.91 AS DECIMAL(10,6)) END AS rate
        FROM orders WHERE dayofweek(o_orderdate) BETWEEN 1 AND 5""",
    "cal": """SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM
        (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders)""",
    "fx": """SELECT d, coalesce(r.rate, (SELECT p.rate FROM rates p WHERE p.f < d
        ORDER BY p.f DESC LIMIT 1)) AS rate FROM cal LEFT JOIN rates r ON r.f = d""",
    "monthly": """SELECT CAST(strftime(m, '%Y%m%d') AS INTEGER) AS DateKey, 1 AS CustomerKey,
        p.ProductKey, 2 AS CurrencyKey, q AS Qty, price AS UnitPrice,
        CAST(CAST(q AS DECIMAL(12,0)) * CAST(price AS DECIMAL(9,2))
             * CAST(coalesce(fx.rate, 1) AS DECIMAL(8,2)) AS DECIMAL(24,4)) AS crc,
        CAST(CAST(q AS DECIMAL(12,0)) * CAST(price AS DECIMAL(9,2)) AS DECIMAL(24,4)) AS usd
        FROM (SELECT date_trunc('month', l_shipdate) AS m, l_partkey, sum(l_quantity) AS q,
              max(l_extendedprice) AS price FROM lineitem GROUP BY 1, 2) s
        LEFT JOIN dimp p ON p.ItemCode = 'P' || l_partkey LEFT JOIN fx ON fx.d = CAST(m AS DATE)""",
    "fact": """SELECT DateKey, CustomerKey, ProductKey, CurrencyKey,
        CASE WHEN ret THEN -DocTotal ELSE DocTotal END AS crc,
        CASE WHEN ret THEN -DocTotalFC ELSE DocTotalFC END AS usd FROM docs
        UNION ALL SELECT DateKey, CustomerKey, ProductKey, CurrencyKey, crc, usd FROM monthly""",
    # five sources
    "src": """SELECT *, CASE c_mktsegment WHEN 'MACHINERY' THEN 'SQL Server' WHEN 'BUILDING' THEN 'MySQL'
        WHEN 'AUTOMOBILE' THEN 'Supabase' WHEN 'FURNITURE' THEN 'MongoDB' ELSE 'Neo4j' END AS Fuente
        FROM customer""",
    "dimcli": """SELECT row_number() OVER (ORDER BY md5(Fuente || '|' || c_custkey), Fuente,
          CAST(c_custkey AS VARCHAR)) AS ClienteID, Fuente AS FuenteOrigen,
        CAST(c_custkey AS VARCHAR) AS ClienteID_Natural, c_name AS Nombre,
        CASE WHEN c_acctbal >= 0 THEN 'c' || c_custkey || '@example.com' END AS Email,
        CASE WHEN c_nationkey < 4 OR c_nationkey BETWEEN 8 AND 10 THEN 'Masculino'
             WHEN c_nationkey < 8 OR c_nationkey BETWEEN 11 AND 13 THEN 'Femenino'
             ELSE 'No Especificado' END AS Genero,
        CASE WHEN Fuente = 'Neo4j' THEN 'No Especificado' ELSE 'NATION_' || c_nationkey END AS Pais,
        CASE WHEN Fuente = 'Neo4j' THEN '1900-01-01' ELSE
          CAST(DATE '1995-01-01' + CAST(floor((c_acctbal + 1000) / 10) AS INTEGER) AS VARCHAR) END AS FechaRegistro
        FROM src""",
    "dimpro": f"""SELECT row_number() OVER (ORDER BY {hash_order("'SKU-' || p_partkey")}) AS ProductoID,
        p_partkey, 'SKU-' || p_partkey AS SKU_Oficial, p_name AS Nombre,
        p_type || ' ' || p_brand || ' ' || p_size AS Categoria FROM part""",
    "named": """SELECT Nombre, Categoria, count(*) AS n, min(SKU_Oficial) AS sku FROM dimpro GROUP BY 1, 2""",
    # which sources can tell a part's SKU: MySQL needs the alternate code stated elsewhere
    "resolved": """SELECT s.Fuente, p.p_partkey, p.p_type, d.SKU_Oficial AS own, n.n, n.sku AS by_name,
        CASE s.Fuente WHEN 'SQL Server' THEN 'SKU'
          WHEN 'MySQL' THEN CASE WHEN p_type NOT IN ('LARGE', 'MEDIUM') THEN 'codigo_alt' END
          WHEN 'Supabase' THEN CASE WHEN p_type NOT IN ('SMALL', 'PROMO') THEN 'SKU' END
          WHEN 'MongoDB' THEN CASE WHEN p_type NOT IN ('LARGE', 'MEDIUM') THEN 'SKU' ELSE 'codigo_mongo' END
          ELSE CASE WHEN p_type <> 'ECONOMY' THEN 'SKU' ELSE 'codigo_mongo' END END AS by_code
        FROM part p CROSS JOIN (SELECT unnest(['SQL Server','MySQL','Supabase','MongoDB','Neo4j']) AS Fuente) s
        JOIN dimpro d ON d.p_partkey = p.p_partkey
        JOIN named n ON n.Nombre = d.Nombre AND n.Categoria = d.Categoria""",
    "product_ids": """SELECT Fuente, p_partkey, CASE WHEN by_code IS NOT NULL THEN own
        WHEN n = 1 THEN by_name END AS SKU_Oficial,
        coalesce(by_code, CASE WHEN n = 1 THEN 'nombre' END) AS resolved_by,
        CASE WHEN by_code IS NULL AND n > 1 THEN 'ambiguous' END AS motivo FROM resolved""",
    "canales": f"""SELECT row_number() OVER (ORDER BY {hash_order('c')}) AS CanalID, c AS NombreCanal FROM (
        SELECT DISTINCT CASE o_orderpriority WHEN '1-URGENT' THEN 'WEB' WHEN '2-HIGH' THEN 'APP'
        WHEN '3-MEDIUM' THEN 'TIENDA' WHEN '4-NOT SPECIFIED' THEN 'PARTNER' ELSE 'WEB' END AS c FROM orders)""",
    "sales": """SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS TiempoID, cli.ClienteID,
        pro.ProductoID, ch.CanalID, CAST(o_orderkey AS VARCHAR) AS OrdenID_Natural, src.Fuente AS FuenteOrigen,
        CASE src.Fuente WHEN 'SQL Server' THEN 'USD' WHEN 'MongoDB' THEN 'CRC'
             ELSE CASE l_linestatus WHEN 'O' THEN 'CRC' ELSE 'USD' END END AS MonedaOrigen,
        CAST(l_quantity AS INTEGER) AS Cantidad,
        CASE WHEN src.Fuente IN ('SQL Server','MongoDB') THEN CAST(round(l_discount * 100) AS INTEGER) END AS DescuentoPct,
        CASE src.Fuente WHEN 'MongoDB' THEN CAST(floor(l_extendedprice) AS HUGEINT) * 100
             ELSE CAST(round(l_extendedprice * 100) AS HUGEINT) END AS cents,
        CAST(fx.rate * 1000000 AS HUGEINT) AS rate_u
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN src ON o_custkey = c_custkey
        JOIN dimcli cli ON cli.ClienteID_Natural = CAST(c_custkey AS VARCHAR)
        JOIN product_ids pi ON pi.Fuente = src.Fuente AND pi.p_partkey = l_partkey
        LEFT JOIN dimpro pro ON pro.SKU_Oficial = pi.SKU_Oficial
        JOIN canales ch ON ch.NombreCanal = CASE o_orderpriority WHEN '1-URGENT' THEN 'WEB'
          WHEN '2-HIGH' THEN 'APP' WHEN '3-MEDIUM' THEN 'TIENDA' WHEN '4-NOT SPECIFIED' THEN 'PARTNER' ELSE 'WEB' END
        LEFT JOIN fx ON fx.d = CAST(o_orderdate AS DATE)""",
}
ERP_DIMS = ("hdr", "dimc", "dimp", "head", "docs")
FX = ("rates", "cal", "fx")
ERP_ALL = (*ERP_DIMS, *FX, "monthly", "fact")
UNIFIED = ("src", "dimcli", "dimpro", "named", "resolved", "product_ids")
SALES = (*FX, *UNIFIED, "canales", "sales")
