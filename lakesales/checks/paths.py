"""Whole paths: sources written in their own layouts, landed, loaded; conflicts, re-runs and refused input."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesales.checks import shapes as S
from lakesales.checks.shapes import SALES, Tables, cte
from lakesales.functions.dates import date_key
from lakesales.operators import aggregates as A
from lakesales.operators import changes as U
from lakesales.operators import filters as Q
from lakesales.operators import validation as V
from lakesales.operators.joins import star_lookup
from lakesales.operators.keys import assign_keys
from lakesales.operators.ranked import page_at, store_ranked
from lakesales.plans import erp_warehouse as P
from lakesales.plans import unified_warehouse as W
from lakesales.plans.constraints import check_table
from lakesales.schemas import SOURCE_TABLES
from lakesales.session import scratch_path
from lakesales.sources import landing, readers
from lakesales.sources.sinks import write_table

RELATIONAL = ("SQL Server", "MySQL", "Supabase")


class Sources:
    """The five sources on disk, each in its own layout, read back and landed."""

    def __init__(self, t: Tables):
        self.t, self.base = t, scratch_path(t.spark, "sources")

    def _relational(self, source: str, table: str, landed: DataFrame, mapping: dict) -> DataFrame:
        schema = self.t.spark.createDataFrame([], SOURCE_TABLES[source, table]).schema
        back = {own: target for target, own in mapping.items()}
        path = f"{self.base}/{source.replace(' ', '')}/{table}"
        landed.where(F.col("FuenteOrigen") == source).select(
            *[F.col(back[f.name]).cast(f.dataType).alias(f.name) for f in schema]).write.parquet(path)
        return readers.read_source(self.t.spark, source, table, path)

    @cached_property
    def customers(self) -> DataFrame:
        landed, spark = S.landed_customers(self.t), self.t.spark
        parts = [landing.land_customers(s, self._relational(s, "cliente", landed, landing.CUSTOMER_COLUMNS[s]))
                 for s in RELATIONAL]
        documents, graph = f"{self.base}/MongoDB/clientes", f"{self.base}/Neo4j/clientes"
        landed.where("FuenteOrigen = 'MongoDB'").select(
            F.col("ClienteID_Natural").alias("_id"), "nombre", "email", "genero", "pais",
            F.col("fecha_registro").alias("creado")).write.json(documents)
        landed.where("FuenteOrigen = 'Neo4j'").select(
            F.col("ClienteID_Natural").alias("id"), "nombre", "email", "genero").write.json(graph)
        good, _ = readers.split_corrupt(readers.read_documents(spark, documents, "clientes"))
        return landing.unify([*parts, landing.land_customers("MongoDB", good), landing.land_customers(
            "Neo4j", spark.read.schema("id string, nombre string, email string, genero string").json(graph))])

    @cached_property
    def products(self) -> DataFrame:
        """As S.landed_products, but the first source lacks small parts, so others describe them."""
        small = F.col("FuenteOrigen").eqNullSafe("SQL Server") & F.col("categoria").rlike(r" ([0-9]|10)$")
        landed, spark = S.landed_products(self.t).where(~small), self.t.spark
        parts = [landing.land_products(s, self._relational(s, "producto", landed, {
            own: name for own, name in landing.PRODUCT_COLUMNS[s].items()
            if not (s != "MySQL" and own == "CodigoFuente")})) for s in RELATIONAL]
        documents, graph = f"{self.base}/MongoDB/productos", f"{self.base}/Neo4j/productos"
        landed.where("FuenteOrigen = 'MongoDB'").select(
            F.col("producto_id").alias("_id"), "codigo_mongo", "nombre", "categoria",
            F.struct("sku", "codigo_alt").alias("equivalencias")).write.json(documents)
        codes = ["sku", "codigo_alt", "codigo_mongo", "nombre", "categoria"]
        landed.where("FuenteOrigen = 'Neo4j'").select(F.col("producto_id").alias("id"), *codes).write.json(graph)
        good, _ = readers.split_corrupt(readers.read_documents(spark, documents, "productos"))
        nodes = spark.read.schema("id string, " + ", ".join(f"{c} string" for c in codes)).json(graph)
        return landing.unify([*parts, landing.land_products("MongoDB", good), landing.land_products("Neo4j", nodes)])


def source_customers(spark, d):
    """Customers of all sources, from their own layouts to the dimension."""
    return W.dim_cliente(Sources(Tables(spark, d)).customers).select(
        "ClienteID", "FuenteOrigen", "ClienteID_Natural", "Nombre", "Email", "Genero", "Pais",
        F.col("FechaRegistro").cast("string").alias("FechaRegistro"))


def source_products(spark, d):
    """Products of all sources, from their own layouts to the dimension."""
    return W.dim_producto(Sources(Tables(spark, d)).products).select(
        "ProductoID", "SKU_Oficial", "Nombre", "Categoria", "FuenteOrigen")


def unified_dw(spark, d):
    """The unified warehouse written and read back: rows of each table, and the sales."""
    t = Tables(spark, d)
    sources = Sources(t)
    cal = P.calendar_fx(S.order_bounds(t), S.rates(t))
    tables = W.run_unified_dw(sources.customers, S.landed_products(t), S.landed_lines(t), cal, scratch_path(spark, "udw"))
    parts = [tables[name].agg(F.lit(name).alias("tabla"), F.count("*").alias("filas"),
                              (F.sum("TotalVentaUSD") if name == "FactVentas" else F.lit(None)).cast("double").alias("usd"))
             for name in ("DimTiempo", "DimCliente", "DimProducto", "DimCanal", "MapProducto", "FactVentas",
                          "rechazos_dimensiones", "conflictos")]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def product_rejects(spark, d):
    """Source products without a name, and with a category that is too long."""
    rows = S.landed_products(Tables(spark, d)).withColumns({
        "nombre": F.when(F.col("FuenteOrigen") != "MySQL", F.col("nombre")),
        "categoria": F.when(F.col("FuenteOrigen") == "Neo4j", F.repeat("categoria", 20)).otherwise(F.col("categoria"))})
    _, rejects = W.check_products(rows)
    return rejects.groupBy("field", "rule").agg(F.count("*").alias("filas"))


# --- conflicts and re-runs ----------------------------------------------------------------------
def _twins(t: Tables) -> DataFrame:
    """Two customers to a code that differs in case and end blanks only."""
    half = F.floor(F.col("c_custkey") / 2).cast("string")
    return t.customer.select(F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("c"), half)).otherwise(
        F.concat(F.lit("C"), half, F.lit(" "))).alias("CardCode"), F.col("c_name").alias("CardName"), "c_custkey")


def code_conflicts(spark, d):
    return V.code_conflicts(_twins(Tables(spark, d)), "CardCode")


def lookup_of_twins(spark, d):
    """A fact keeps its rows where the dimension has a code twice; the first member counts."""
    t = Tables(spark, d)
    orders = t.orders.select("o_orderkey", F.concat(F.lit("C"), F.floor(F.col("o_custkey") / 2).cast("string")).alias("code"))
    found = star_lookup(orders, _twins(t), F.col("code"), "CardCode", ["c_custkey"])
    return found.select("o_orderkey", "c_custkey")


def sku_conflicts(spark, d):
    """Alternate codes that two sources tie to different SKUs."""
    wrong = F.when((F.col("FuenteOrigen") == "MongoDB") & F.col("sku").isNotNull(), "SKU-0").otherwise(F.col("sku"))
    landed = S.landed_products(Tables(spark, d)).withColumn("sku", wrong).withColumn(
        "codigo_alt", F.when(F.col("FuenteOrigen") == "SQL Server", F.replace("sku", F.lit("SKU"), F.lit("ALT")))
        .otherwise(F.col("codigo_alt")))
    return W.sku_conflicts(W.stated_pairs(landed)).where("FuenteOrigen = 'MySQL'").select("CodigoFuente", "skus")


def rate_conflicts(spark, d):
    """Days whose orders carry different rates."""
    rates = Tables(spark, d).orders.select(F.to_date("o_orderdate").alias("Fecha"), (
        F.lit(500) + F.col("o_custkey") % 3).cast("decimal(18,6)").alias("TipoCambio_USD_CRC"))
    return P.rate_conflicts(rates).select(F.col("Fecha").cast("string").alias("Fecha"), "tasas")


def last_patch(spark, d):
    """Every order patches its customer; the last order wins."""
    t = Tables(spark, d)
    stored = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segmento"))
    patches = t.orders.select(F.col("o_custkey").alias("id"), F.concat(F.lit("o"), "o_orderkey").alias("segmento"),
                              F.col("o_orderkey").alias("orden"))
    return U.apply_patches(stored, patches, "id", F.current_timestamp(), order="orden")


def _by_month(t: Tables) -> tuple[str, DataFrame]:
    path = scratch_path(t.spark, "ordenes")
    stored = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("estado"), F.col("o_totalprice").alias("total"),
                             F.year("o_orderdate").alias("anio"), F.month("o_orderdate").alias("mes"))
    return path, write_table(stored, path, partition_by=["anio", "mes"])


def patch_partitions(spark, d):
    """Orders of one customer in a hundred and of one year get a state; only their months are written anew."""
    t = Tables(spark, d)
    path, _ = _by_month(t)
    patches = t.orders.where("o_custkey % 100 = 7 and year(o_orderdate) = 1996").select(
        F.col("o_orderkey").alias("id"), F.lit("X").alias("estado"))
    U.patch_table(spark, path, ["anio", "mes"], patches, "id", F.current_timestamp())
    stored = spark.read.parquet(path)
    return stored.select("id", "estado", "total", F.col("anio").cast("bigint").alias("anio"), F.col("mes").cast("bigint").alias("mes"))


def patched_months(spark, d):
    t = Tables(spark, d)
    path, _ = _by_month(t)
    patches = t.orders.where("o_custkey % 100 = 7 and year(o_orderdate) = 1996").select(
        F.col("o_orderkey").alias("id"), F.lit("X").alias("estado"))
    done = U.patch_table(spark, path, ["anio", "mes"], patches, "id", F.current_timestamp())
    return done.select(F.col("anio").cast("bigint").alias("anio"), F.col("mes").cast("bigint").alias("mes"))


def upsert_buckets(spark, d):
    """A stored customer dimension takes in changed and new members; the buckets of all others stay as they are."""
    t, path, ts = Tables(spark, d), scratch_path(spark, "dim"), F.lit("2024-01-01").cast("timestamp")
    name = F.col("c_custkey").alias("codigo")
    known = t.customer.where("c_custkey % 10 <> 3").select(name, F.col("c_mktsegment").alias("segmento"))
    dim = assign_keys(known, ["codigo"], "clave").withColumns({"FechaCreacion": ts, "FechaActualizacion": ts})
    write_table(U.dim_buckets(dim, ["codigo"], 64), path, partition_by=["cubeta"])
    incoming = t.customer.where("c_custkey % 20 in (3, 4)").select(name, F.lit("NUEVO").alias("segmento"))
    later = F.lit("2024-06-01").cast("timestamp")
    U.upsert_table(spark, path, incoming, ["codigo"], "clave", later, 64)
    stored = spark.read.parquet(path)
    return stored.select("codigo", "segmento", (F.col("FechaCreacion") == later).alias("nuevo"),
                         (F.col("FechaActualizacion") == later).alias("cambiado"),
                         (F.col("clave") > dim.agg(F.max("clave").alias("m")).scalar()).alias("clave_nueva"))


def reload_fact(spark, d):
    """A second load with fewer months leaves nothing of the first."""
    t, path = Tables(spark, d), scratch_path(spark, "reload")
    fact = t.orders.select(date_key("o_orderdate").alias("DateKey"), F.col("o_custkey").alias("CustomerKey"))
    P.write_fact(fact, path)
    again = P.write_fact(fact.where("DateKey < 19960701"), path)
    return again.groupBy(F.col("Year").cast("bigint").alias("Year"), F.col("Month").cast("bigint").alias("Month")).agg(
        F.count("*").alias("filas"))


def orphan_counts(spark, d):
    """Fact rows whose customer or product is in no dimension."""
    t = Tables(spark, d)
    fact = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        date_key("o_orderdate").alias("DateKey"), F.col("o_custkey").alias("CustomerKey"),
        F.col("l_partkey").alias("ProductKey"), F.lit(1).alias("CurrencyKey"),
        F.lit(1).alias("DocTotal_CRC"), F.lit(1).alias("DocTotal_USD"))
    who = t.customer.where("c_acctbal >= 0").select(F.col("c_custkey").alias("CustomerKey"), F.lit("x").alias("CardCode"),
                                                    F.lit("x").alias("CardName"))
    what = t.part.where("p_size > 10").select(F.col("p_partkey").alias("ProductKey"), F.lit("x").alias("ItemCode"),
                                              F.lit("x").alias("ItemName"))
    pack = P.qa_pack(fact, who, what)
    return pack["customer_orphans"].select(F.lit("clientes").alias("tabla"), "n").unionByName(
        pack["product_orphans"].select(F.lit("productos").alias("tabla"), "n"))


def targets_table(spark, d):
    """Accepted targets with their key, checked against the declared constraints of the stored table."""
    t = Tables(spark, d)
    good = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("ClienteID"), F.col("l_partkey").alias("ProductoID"),
        F.year("l_shipdate").alias("Anio"), F.month("l_shipdate").alias("Mes"),
        F.when(F.col("l_linenumber") != 7, F.col("l_extendedprice").cast("decimal(18,2)")).alias("MetaUSD"))
    stored = W.metas_ventas(good)
    known = {"DimCliente": t.customer.where("c_acctbal >= 0").select(F.col("c_custkey").alias("ClienteID")),
             "DimProducto": t.part.select(F.col("p_partkey").alias("ProductoID"))}
    broken = check_table(stored, "warehouse", "MetasVentas", known)
    return broken.groupBy("field", "rule").agg(F.count("*").alias("filas"))


# --- input that does not fit is refused ---------------------------------------------------------------
class BadInput:
    """Lines with discounts that are no numbers, too long or too large, and source products with two SKUs."""

    def __init__(self, t: Tables):
        n = F.col("l_linenumber")
        discount = (F.when(n == 3, "abc").when(n == 4, "15%").when(n == 5, "12.34567").when(n == 6, "101").when(n == 7, " "))
        named = S.landed_products(t)
        second = named.where("FuenteOrigen = 'Supabase' and sku like '%0'").withColumn("sku", F.lit("SKU-1"))
        self.landed = named.unionByName(second)
        self.products = t.store(W.dim_producto(self.landed), "DimProducto")
        self.resolved = t.store(W.resolve_products(self.landed, self.products), "Resueltos")
        customers = t.store(W.dim_cliente(S.landed_customers(t)), "DimCliente")
        channels = W.dim_canal(t.orders.select(S.raw_channel().alias("canal")))
        cal = t.store(P.calendar_fx(S.order_bounds(t), S.rates(t)), "Calendario")
        self.checked = W.check_sales(S.landed_lines(t, discount), customers,
                                     W.product_lookup(self.resolved, self.products), channels, cal)


def bad_input_rejects(spark, d):
    errors = BadInput(Tables(spark, d)).checked.select("FuenteOrigen", F.explode("errors").alias("e"))
    return errors.groupBy("FuenteOrigen", F.col("e.field").alias("field"), F.col("e.rule").alias("rule")).agg(
        F.count("*").alias("lineas"))


def bad_input_sales(spark, d):
    """What is booked of such lines."""
    fact = W.fact_ventas(BadInput(Tables(spark, d)).checked)
    return fact.groupBy("FuenteOrigen").agg(F.sum("TotalVentaUSD").cast("double").alias("usd"),
                                            F.count("*").alias("lineas"))


def product_conflicts(spark, d):
    return W.product_conflicts(BadInput(Tables(spark, d)).resolved).select("FuenteOrigen", "producto_id", "skus")


def customer_conflicts(spark, d):
    """Customers of one source delivered again, some with another country, some the same."""
    t = Tables(spark, d)
    landed = S.landed_customers(t)
    again = landed.withColumn("pais", F.when(F.col("ClienteID_Natural").like("%7"), "CR").otherwise(F.col("pais")))
    return W.customer_conflicts(landed.unionByName(again)).select("FuenteOrigen", "ClienteID_Natural", "filas")


def long_decimals(spark, d):
    """Orders with a price or discount of more decimals than amounts are kept in have no total, and are listed."""
    t = Tables(spark, d)
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("decimal(20,8)")
    lines = t.lineitem.select(
        "l_orderkey", F.when(F.col("l_linenumber") == 6, price + F.lit("0.0000009").cast("decimal(20,8)")).otherwise(price).alias("p"),
        "l_quantity", F.when(F.col("l_linenumber") == 7, F.lit("12.34567")).otherwise(F.lit("0")).alias("pct"))
    out = V.total_mismatch(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.lit(0).alias("total")), lines,
                           "l_orderkey", "total", "p", "l_quantity", "pct")
    return out.select("l_orderkey", *S.double("total_lineas"))


def corrupt_rates(spark, d):
    """A rates file with days that do not exist and rates that are no numbers: what stays, and the text of the rest."""
    t, path = Tables(spark, d), scratch_path(spark, "broken-rates")
    day = F.col("Fecha")
    text = S.rates(t).select(
        F.when(F.dayofmonth(day) == 3, F.date_format(day, "yyyy-MM-'41'")).otherwise(day.cast("string")).alias("Fecha"),
        F.when(F.dayofmonth(day) == 4, "n/a").otherwise(F.col("TipoCambio_USD_CRC").cast("string")).alias("TipoCambio_USD_CRC"))
    text.write.csv(path, header=True)
    good, bad = readers.split_corrupt(readers.read_rates(spark, path))
    return good.select(F.col("Fecha").cast("string").alias("linea")).unionByName(bad.select(F.col("texto").alias("linea")))


# --- nothing vanishes on reading -----------------------------------------------------------------
def corrupt_documents(spark, d):
    """Stored orders, some of them cut off: accepted and refused rows together are the rows given."""
    t, path = Tables(spark, d), scratch_path(spark, "broken")
    text = F.to_json(F.struct(S.object_id("o_orderkey").alias("_id"), F.lit("USD").alias("moneda")))
    t.orders.select(F.when(F.col("o_orderstatus") == "P", F.substring(text, F.lit(1), F.length(text) - 3)).otherwise(
        text)).write.text(path)
    good, bad = readers.split_corrupt(readers.read_documents(spark, path, "ordenes"))
    return good.select(F.lit("accepted").alias("estado")).unionByName(bad.select(F.lit("rejected").alias("estado"))) \
        .groupBy("estado").agg(F.count("*").alias("filas"))


def document_types(spark, d):
    """Stored orders with a total that is text, items that are no list, a short id, or a day that does not exist."""
    t, path = Tables(spark, d), scratch_path(spark, "types")
    status, urgency = F.col("o_orderstatus"), F.col("o_orderpriority")
    ident = S.object_id("o_orderkey")
    total = F.when(status == "P", '"n/a"').otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
    items = F.when(urgency == "3-MEDIUM", '{"a":1}').otherwise("[]")
    day = F.when(urgency == "4-NOT SPECIFIED", "2024-13-45").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    t.orders.select(F.concat(
        F.lit('{"_id":"'), F.when(urgency == "5-LOW", F.substring(ident, 1, 20)).otherwise(ident),
        F.lit('","fecha":"'), day, F.lit('","total":'), total, F.lit(',"items":'), items, F.lit("}"))).write.text(path)
    good, bad = readers.split_corrupt(readers.read_documents(spark, path, "ordenes"))
    accepted, rejects = V.validate(good, V.order_type_rules(), "_id")
    return rejects.select("rule").unionByName(bad.select(F.lit("type").alias("rule"))).unionByName(
        accepted.select(F.lit("accepted").alias("rule"))).groupBy("rule").agg(F.count("*").alias("filas"))


def corrupt_sources(spark, d):
    """Lines of a relational source as text, with quantities that are no numbers."""
    t, path = Tables(spark, d), scratch_path(spark, "broken-lines")
    t.lineitem.select(F.col("l_linenumber").alias("id"), F.col("l_orderkey").alias("orden_id"),
                      F.col("l_partkey").alias("producto_id"),
                      F.when(F.col("l_linenumber") == 6, "six").otherwise(F.col("l_quantity").cast("int").cast("string"))
                      .alias("cantidad"), F.col("l_extendedprice").cast("string").alias("precio_unit")).write.csv(path, header=True)
    good, bad = readers.split_corrupt(readers.read_source(spark, "MySQL", "detalle", path, "csv"))
    return good.agg(F.count("*").alias("buenas"), F.sum("cantidad").alias("unidades")).withColumn(
        "malas", bad.agg(F.count("*").alias("n")).scalar())


# --- baskets and paging -----------------------------------------------------------------------------
def basket_sets(spark, d):
    """All frequent brand sets, whatever their size."""
    t = Tables(spark, d)
    part = t.part.select("p_partkey", "p_brand")
    rows = t.lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "p_brand")
    sets, _ = A.basket_rules(rows, "l_orderkey", "p_brand", 0.005, 0.05)
    return sets.select(F.array_join(F.array_sort("items"), ",").alias("items"), "freq")


def basket_all_rules(spark, d):
    t = Tables(spark, d)
    part = t.part.select("p_partkey", "p_brand")
    rows = t.lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "p_brand")
    _, rules = A.basket_rules(rows, "l_orderkey", "p_brand", 0.005, 0.05)
    return rules.select(F.array_join(F.array_sort("antecedent"), ",").alias("si"),
                        F.array_join("consequent", ",").alias("entonces"), F.round("confidence", 6).alias("confianza"))


def page_after_ties(spark, d):
    """The page behind one of a day's orders."""
    orders = Tables(spark, d).orders.select("o_orderkey", F.to_date("o_orderdate").alias("dia"))
    first = orders.agg(F.min("o_orderkey").alias("k"), F.min_by("dia", "o_orderkey").alias("d")).first()
    page = Q.page_after(orders, "dia", first["d"], 40, "o_orderkey", first["k"])
    return page.select("o_orderkey", F.col("dia").cast("string").alias("dia"))


def page_deep(spark, d):
    """A page far down the orders by total, from a stored listing."""
    path = scratch_path(spark, "listing")
    orders = Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_totalprice")
    store_ranked(orders, path, [F.desc("o_totalprice"), F.asc("o_orderkey")], 700)
    return page_at(spark, path, 61, 20)


QUERIES = {
    "scan_source_customers": source_customers, "scan_source_products": source_products, "unified_dw": unified_dw,
    "product_rejects": product_rejects, "code_conflicts": code_conflicts, "lookup_of_twins": lookup_of_twins,
    "sku_conflicts": sku_conflicts, "rate_conflicts": rate_conflicts, "last_patch": last_patch,
    "reload_fact": reload_fact, "orphan_counts": orphan_counts, "targets_table": targets_table,
    "document_types": document_types, "corrupt_documents": corrupt_documents, "corrupt_sources": corrupt_sources, "basket_sets": basket_sets,
    "basket_all_rules": basket_all_rules, "page_after_ties": page_after_ties,
    "page_deep": page_deep, "patch_partitions": patch_partitions, "patched_months": patched_months, "upsert_buckets": upsert_buckets,
    "bad_input_rejects": bad_input_rejects, "bad_input_sales": bad_input_sales, "product_conflicts": product_conflicts,
    "customer_conflicts": customer_conflicts, "long_decimals": long_decimals, "corrupt_rates": corrupt_rates,
}

_OK = "ProductoID IS NOT NULL AND (MonedaOrigen = 'USD' OR rate_u IS NOT NULL)"
_BASKETS = """b AS (SELECT DISTINCT l_orderkey AS o, p_brand AS i FROM lineitem JOIN part ON l_partkey = p_partkey),
  m AS (SELECT 0.005 * count(DISTINCT o) AS least FROM b),
  s1 AS (SELECT i AS items, [i] AS l, count(*) AS freq FROM b GROUP BY 1, 2 HAVING count(*) >= (SELECT least FROM m)),
  s2 AS (SELECT x.i || ',' || y.i AS items, [x.i, y.i] AS l, count(*) AS freq FROM b x JOIN b y ON x.o = y.o AND x.i < y.i
    GROUP BY 1, 2 HAVING count(*) >= (SELECT least FROM m)),
  s3 AS (SELECT x.i || ',' || y.i || ',' || z.i AS items, [x.i, y.i, z.i] AS l, count(*) AS freq
    FROM b x JOIN b y ON x.o = y.o AND x.i < y.i JOIN b z ON y.o = z.o AND y.i < z.i
    GROUP BY 1, 2 HAVING count(*) >= (SELECT least FROM m)),
  s4 AS (SELECT x.i || ',' || y.i || ',' || z.i || ',' || w.i AS items, [x.i, y.i, z.i, w.i] AS l, count(*) AS freq
    FROM b x JOIN b y ON x.o = y.o AND x.i < y.i JOIN b z ON y.o = z.o AND y.i < z.i JOIN b w ON z.o = w.o AND z.i < w.i
    GROUP BY 1, 2 HAVING count(*) >= (SELECT least FROM m)),
  s AS (SELECT * FROM s1 UNION ALL SELECT * FROM s2 UNION ALL SELECT * FROM s3 UNION ALL SELECT * FROM s4)"""

_BAD = """bad AS (SELECT l_linenumber AS n, src.Fuente AS FuenteOrigen,
          CASE WHEN src.Fuente = 'Supabase' AND l_partkey % 10 = 0 AND p_type NOT IN ('SMALL', 'PROMO') THEN NULL
            ELSE pi.SKU_Oficial END AS sku,
          CASE src.Fuente WHEN 'SQL Server' THEN 'USD' WHEN 'MongoDB' THEN 'CRC'
             ELSE CASE l_linestatus WHEN 'O' THEN 'CRC' ELSE 'USD' END END AS cur, CAST(l_quantity AS INTEGER) AS q,
          CASE WHEN l_linenumber = 7 OR src.Fuente NOT IN ('SQL Server', 'MongoDB') THEN 0
            ELSE CAST(round(l_discount * 100) AS INTEGER) END AS pct,
          CASE src.Fuente WHEN 'MongoDB' THEN CAST(floor(l_extendedprice) AS HUGEINT) * 100
             ELSE CAST(round(l_extendedprice * 100) AS HUGEINT) END AS cents, CAST(fx.rate * 1000000 AS HUGEINT) AS rate_u
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN src ON o_custkey = c_custkey
        JOIN product_ids pi ON pi.Fuente = src.Fuente AND pi.p_partkey = l_partkey JOIN part ON part.p_partkey = l_partkey
        LEFT JOIN fx ON fx.d = CAST(o_orderdate AS DATE))"""

SQL = {
    "bad_input_rejects": cte(*S.FX, *S.UNIFIED) + f""", {_BAD}
        SELECT FuenteOrigen, 'producto_id' AS field, 'reference' AS rule, count(*) AS lineas FROM bad WHERE sku IS NULL GROUP BY 1
        UNION ALL SELECT FuenteOrigen, 'fecha', 'rate', count(*) FROM bad WHERE cur = 'CRC' AND rate_u IS NULL GROUP BY 1
        UNION ALL SELECT FuenteOrigen, 'descuento_pct', 'format', count(*) FROM bad WHERE n IN (3, 4, 5) GROUP BY 1
        UNION ALL SELECT FuenteOrigen, 'DescuentoPct', 'range', count(*) FROM bad WHERE n = 6 GROUP BY 1""",
    "bad_input_sales": cte(*S.FX, *S.UNIFIED) + f""", {_BAD}
        SELECT FuenteOrigen, CAST(sum(CASE cur WHEN 'USD' THEN (2 * cents * q * (100 - pct) + 100) // 200
          ELSE (2 * cents * q * (100 - pct) * 1000000 + 100 * rate_u) // (200 * rate_u) END) AS DOUBLE) / 100 AS usd,
          count(*) AS lineas FROM bad
        WHERE sku IS NOT NULL AND n NOT IN (3, 4, 5, 6) AND (cur = 'USD' OR rate_u IS NOT NULL) GROUP BY 1""",
    "product_conflicts": """SELECT 'Supabase' AS FuenteOrigen, 'U-' || p_partkey AS producto_id, 2 AS skus FROM part
        WHERE p_partkey % 10 = 0 AND p_type NOT IN ('SMALL', 'PROMO')""",
    "customer_conflicts": cte("src") + """SELECT Fuente AS FuenteOrigen, CAST(c_custkey AS VARCHAR) AS ClienteID_Natural,
        2 AS filas FROM src WHERE c_custkey % 10 = 7""",
    "long_decimals": """SELECT l_orderkey, CASE WHEN NOT bool_or(l_linenumber IN (6, 7)) THEN
          CAST(sum(CAST(round(l_extendedprice * 100) AS HUGEINT) * CAST(l_quantity AS HUGEINT)) AS DOUBLE) / 100 END
          AS total_lineas FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
    "corrupt_rates": cte("rates") + """SELECT CASE day(f) WHEN 3 THEN strftime(f, '%Y-%m-41') || ',' || rate
          WHEN 4 THEN CAST(f AS VARCHAR) || ',n/a' ELSE CAST(f AS VARCHAR) END AS linea FROM rates""",
    "scan_source_customers": cte("src", "dimcli") + "SELECT * FROM dimcli",
    "scan_source_products": cte("dimpro") + """SELECT ProductoID, SKU_Oficial, Nombre, Categoria,
        CASE WHEN p_size > 10 THEN 'SQL Server' WHEN p_type NOT IN ('LARGE', 'MEDIUM') THEN 'MongoDB'
        ELSE 'Supabase' END AS FuenteOrigen FROM dimpro JOIN part USING (p_partkey)""",
    "unified_dw": cte(*SALES) + f"""SELECT 'DimTiempo' AS tabla, count(*) AS filas, NULL::DOUBLE AS usd FROM cal
        UNION ALL SELECT 'DimCliente', count(*), NULL FROM dimcli UNION ALL SELECT 'DimProducto', count(*), NULL FROM dimpro
        UNION ALL SELECT 'DimCanal', count(*), NULL FROM canales
        UNION ALL SELECT 'MapProducto', count(*), NULL FROM product_ids WHERE SKU_Oficial IS NOT NULL
        UNION ALL SELECT 'rechazos_dimensiones', 0, NULL UNION ALL SELECT 'conflictos', 0, NULL
        UNION ALL SELECT 'FactVentas', count(*), CAST(sum(CASE MonedaOrigen WHEN 'USD' THEN
          (2 * cents * Cantidad * (100 - coalesce(DescuentoPct, 0)) + 100) // 200
          ELSE (2 * cents * Cantidad * (100 - coalesce(DescuentoPct, 0)) * 1000000 + 100 * rate_u) // (200 * rate_u) END)
          AS DOUBLE) / 100 FROM sales WHERE {_OK}""",
    "product_rejects": """SELECT 'nombre' AS field, 'required' AS rule, count(*) AS filas FROM part
        UNION ALL SELECT 'categoria', 'length', count(*) FROM part
        WHERE 20 * length(p_type || ' ' || p_brand || ' ' || p_size) > 80""",
    "code_conflicts": """SELECT 'C' || (c_custkey // 2) AS codigo, count(*) AS miembros FROM customer GROUP BY 1
        HAVING count(*) > 1""",
    "lookup_of_twins": """SELECT o_orderkey, (SELECT min(c_custkey) FROM customer WHERE c_custkey // 2 = o_custkey // 2)
        AS c_custkey FROM orders""",
    "sku_conflicts": """SELECT 'ALT-' || p_partkey AS CodigoFuente, 2 AS skus FROM part
        WHERE p_type NOT IN ('LARGE', 'MEDIUM') AND p_partkey <> 0""",
    "rate_conflicts": """SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS Fecha, count(DISTINCT o_custkey % 3) AS tasas
        FROM orders GROUP BY 1 HAVING count(DISTINCT o_custkey % 3) > 1""",
    "last_patch": """SELECT c_custkey AS id, coalesce('o' || max(o_orderkey), c_mktsegment) AS segmento
        FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_mktsegment""",
    "page_deep": """SELECT *, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS puesto, (SELECT count(*) FROM orders) AS total,
        61 AS page, 20 AS "limit", (SELECT (count(*) + 19) // 20 FROM orders) AS pages
        FROM (SELECT o_orderkey, o_custkey, o_totalprice FROM orders) ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 1200""",
    "patch_partitions": """SELECT o_orderkey AS id, CASE WHEN o_custkey % 100 = 7 AND year(o_orderdate) = 1996 THEN 'X'
        ELSE o_orderstatus END AS estado, o_totalprice AS total, year(o_orderdate) AS anio, month(o_orderdate) AS mes FROM orders""",
    "patched_months": """SELECT DISTINCT year(o_orderdate) AS anio, month(o_orderdate) AS mes FROM orders
        WHERE o_custkey % 100 = 7 AND year(o_orderdate) = 1996""",
    "upsert_buckets": """SELECT c_custkey AS codigo, CASE WHEN c_custkey % 20 IN (3, 4) THEN 'NUEVO' ELSE c_mktsegment END AS segmento,
        c_custkey % 10 = 3 AS nuevo, c_custkey % 20 IN (3, 4) AS cambiado, c_custkey % 10 = 3 AS clave_nueva FROM customer
        WHERE c_custkey % 10 <> 3 OR c_custkey % 20 = 3""",
    "reload_fact": """SELECT year(o_orderdate) AS "Year", month(o_orderdate) AS "Month", count(*) AS filas FROM orders
        WHERE o_orderdate < DATE '1996-07-01' GROUP BY 1, 2""",
    "orphan_counts": """SELECT 'clientes' AS tabla, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey
          WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
        UNION ALL SELECT 'productos', count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey
          WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)""",
    "targets_table": """SELECT 'MetaUSD' AS field, 'required' AS rule, count(*) AS filas FROM lineitem
          JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber = 7
        UNION ALL SELECT 'ClienteID', 'reference', count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey
          WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""",
    "corrupt_documents": """SELECT CASE o_orderstatus WHEN 'P' THEN 'rejected' ELSE 'accepted' END AS estado,
        count(*) AS filas FROM orders GROUP BY 1""",
    "document_types": """SELECT CASE WHEN o_orderstatus = 'P' OR o_orderpriority = '3-MEDIUM' THEN 'type'
          WHEN o_orderpriority = '5-LOW' THEN 'object_id' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'date'
          ELSE 'accepted' END AS rule, count(*) AS filas FROM orders GROUP BY 1""",
    "corrupt_sources": """SELECT count(*) FILTER (l_linenumber <> 6) AS buenas,
        CAST(sum(l_quantity) FILTER (l_linenumber <> 6) AS BIGINT) AS unidades,
        count(*) FILTER (l_linenumber = 6) AS malas FROM lineitem""",
    "basket_sets": f"WITH {_BASKETS} SELECT items, freq FROM s",
    "basket_all_rules": f"""WITH {_BASKETS}, a AS MATERIALIZED (SELECT * FROM s),
        r AS (SELECT l, freq, unnest(l) AS c FROM a WHERE len(l) > 1),
        k AS (SELECT freq, c, array_to_string(list_filter(l, lambda x: x <> c), ',') AS rest FROM r)
        SELECT a.items AS si, k.c AS entonces, round(k.freq / a.freq, 6) AS confianza
        FROM k JOIN a ON a.items = k.rest WHERE k.freq / a.freq >= 0.05""",
    "page_after_ties": """WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS dia FROM orders),
        k AS (SELECT min(o_orderkey) AS k FROM o), l AS (SELECT dia AS d FROM o WHERE o_orderkey = (SELECT k FROM k))
        SELECT o_orderkey, CAST(dia AS VARCHAR) AS dia FROM o WHERE dia > (SELECT d FROM l)
          OR (dia = (SELECT d FROM l) AND o_orderkey > (SELECT k FROM k)) ORDER BY o.dia, o_orderkey LIMIT 40""",
}
