"""Queries over orders, documents, graph payloads, paging, search and changes."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from lakesales.checks import shapes as S
from lakesales.checks.shapes import Tables
from lakesales.functions import nested as N
from lakesales.functions.dates import date_key
from lakesales.functions.money import from_cents, net_cents
from lakesales.functions.text import is_object_id
from lakesales.operators import aggregates as A
from lakesales.operators import changes as U
from lakesales.operators import filters as Q
from lakesales.operators import validation as V


def order_totals(spark, d):
    """Net total per order straight from the line table."""
    pct = (F.col("l_discount").cast("decimal(5,2)") * 100).cast("decimal(5,2)")
    cents = F.sum(net_cents("l_extendedprice", "l_quantity", pct))
    return Tables(spark, d).lineitem.groupBy("l_orderkey").agg(
        from_cents(cents).cast("double").alias("total"))


def order_amounts(spark, d):
    """Subtotal, discount and net of every order, from its lines."""
    pct = (F.col("l_discount").cast("decimal(5,2)") * 100).cast("decimal(5,2)")
    out = A.line_totals(Tables(spark, d).lineitem, ["l_orderkey"], F.col("l_extendedprice"), F.col("l_quantity"), pct)
    return out.select("l_orderkey", *S.double("subtotal", "descuento", "neto"))


def exact_amounts(spark, d):
    """Prices in thousandths, discounts in hundredths of a percent: nothing is rounded before the order's sum."""
    price = (F.col("l_extendedprice").cast("decimal(18,2)") / 7).cast("decimal(18,3)")
    pct = (F.col("l_partkey") % 997).cast("decimal(9,2)") / F.lit(Decimal("13"))
    lines = Tables(spark, d).lineitem.select("l_orderkey", price.alias("p"), F.col("l_quantity").alias("q"),
                                             pct.cast("decimal(9,4)").alias("pct"))
    out = A.line_totals(lines, ["l_orderkey"], F.col("p"), F.col("q"), F.col("pct"))
    return out.select("l_orderkey", *S.double("subtotal", "descuento", "neto"))


def fractional_quantities(spark, d):
    """Orders with items that are no whole number are refused, whatever the other items."""
    t = Tables(spark, d)
    half = F.when(F.col("l_linenumber") == 5, F.col("l_quantity") + 0.5).otherwise(F.col("l_quantity"))
    lines = t.lineitem.select(S.object_id("l_orderkey").alias("_id"), S.code("P", "l_partkey").alias("producto_id"),
                              half.cast("decimal(14,4)").alias("cantidad"),
                              F.col("l_extendedprice").cast("decimal(20,6)").alias("precio_unit"),
                              F.lit(0).alias("descuento_pct"))
    _, rejects = V.validate_orders(S.order_heads(t), lines, "_id")
    return rejects.where("rule = 'item_quantity'").select("row", "rule")


def line_amounts(spark, d):
    docs = S.nested_items(Tables(spark, d)).withColumn("items", N.line_amounts("items"))
    return N.explode_items(docs).select("l_orderkey", "producto_id",
                                        *S.double("subtotal", "descuento", "neto"))


def item_counts(spark, d):
    docs = S.order_documents(Tables(spark, d))
    return docs.groupBy("_id").agg(F.sum(N.item_count("items")).alias("lineas"))


def _stats(df):
    out = A.order_stats(df)
    return out.select("total_ordenes", *S.double("total_revenue", "avg_order_value",
                                                 "min_order_value", "max_order_value"))


def order_stats(spark, d):
    return _stats(Tables(spark, d).orders.withColumnRenamed("o_totalprice", "total"))


def order_stats_empty(spark, d):
    orders = Tables(spark, d).orders.withColumnRenamed("o_totalprice", "total")
    return _stats(orders.where("total < 0"))


def page_orders(spark, d):
    orders = Tables(spark, d).orders.select("o_orderkey", "o_totalprice")
    page = Q.paginate(orders, 3, 20, [F.col("o_totalprice").desc(), "o_orderkey"])
    return page.select("o_orderkey", "o_totalprice", "total", "pages",
                       F.col("page").cast("bigint").alias("page"), F.col("limit").cast("bigint").alias("limit"))


def list_view(spark, d):
    part = Tables(spark, d).part.select("p_partkey", "p_name", "p_type", "p_retailprice")
    return Q.list_view(part, "p_partkey", q="ring|^promo", q_cols=["p_name", "p_type"],
                       sort="p_retailprice,desc", page=2, limit=15).select(
        "p_partkey", "p_name", "p_type", "p_retailprice", "total", "pages")


def page_after(spark, d):
    orders = Tables(spark, d).orders.select("o_orderkey", "o_totalprice")
    return Q.page_after(orders, "o_orderkey", 1000, 50)


def preview(spark, d):
    return Q.preview(Tables(spark, d).orders.select("o_orderkey", "o_totalprice"), 10, "o_orderkey")


def filter_category(spark, d):
    return Q.filter_eq(Tables(spark, d).part, "p_type", "SMALL").select("p_partkey", "p_type")


def filter_customer(spark, d):
    return Q.filter_eq(Tables(spark, d).orders, "o_custkey", 7).select("o_orderkey", "o_custkey")


def filter_in(spark, d):
    return Q.filter_in(Tables(spark, d).orders, "o_orderpriority", ["1-URGENT", "2-HIGH"]).select(
        "o_orderkey", "o_orderpriority")


def filter_date_range(spark, d):
    events = Tables(spark, d).events
    return Q.filter_date_range(events, "ts", "2024-01-05", "2024-01-20").select(
        "event_id", "event_type")


def search_products(spark, d):
    return Q.search(Tables(spark, d).part, "RING|^eco|l.*t$", ["p_name", "p_type"]).select(
        "p_partkey", "p_name", "p_type")


def _loose_id(col: str, short):
    return F.substring(F.md5(F.col(col).cast("string").cast("binary")), F.lit(1),
                       F.when(short, 23).otherwise(24))


def id_validity(spark, d):
    ident = _loose_id("o_orderkey", F.col("o_orderstatus") == "P")
    return Tables(spark, d).orders.select("o_orderkey", ident.alias("id")).select(
        "o_orderkey", is_object_id("id").cast("bigint").alias("valido"))


def lookup_ids(spark, d):
    """Orders named by the ids of returned lines, some of which are cut short."""
    t = Tables(spark, d)
    orders = t.orders.select(S.object_id("o_orderkey").alias("_id"), "o_orderkey", "o_totalprice")
    ids = t.lineitem.where("l_returnflag = 'R'").select(
        _loose_id("l_orderkey", F.col("l_linestatus") == "O").alias("_id"))
    return Q.lookup_ids(orders, ids, "_id").select("o_orderkey", "o_totalprice")


def _pairs_text(c):
    return F.array_join(F.transform(c, lambda p: F.concat(p["categoria"], F.lit("="), p["texto"])), ";")


def prefs_to_pairs(spark, d):
    listed = F.to_json(F.array("c_mktsegment", F.lit("WEB")))
    prefs = F.create_map(F.lit("canal"), listed, F.lit("saldo"), F.col("c_nationkey").cast("string"),
                         F.lit("vacio"), F.lit("[]"))
    return Tables(spark, d).customer.select(
        "c_custkey", _pairs_text(N.prefs_to_pairs(prefs)).alias("pares"))


def pairs_to_prefs(spark, d):
    def pair(name: str, value):
        return F.struct(F.lit(name).alias("categoria"), value.cast("string").alias("texto"))

    pairs = F.array(pair("canal", F.lit("APP")), pair("segmento", F.concat_ws(",", "c_mktsegment", "c_nationkey")),
                    pair("canal", F.concat_ws(",", F.lit("WEB"), "c_mktsegment")))
    entries = F.array_sort(F.map_entries(N.pairs_to_prefs(pairs)))
    text = F.array_join(F.transform(entries, lambda e: F.concat(
        e["key"], F.lit("="), F.array_join(e["value"], "+"))), ";")
    return Tables(spark, d).customer.select("c_custkey", text.alias("mapa"))


def items_exploded(spark, d):
    docs = S.order_documents(Tables(spark, d))
    return N.explode_items(docs).select(
        "_id", F.col("linea").cast("bigint").alias("linea"), "producto_id",
        F.col("cantidad").cast("bigint").alias("cantidad"), *S.double("precio_unit", "descuento_pct"))


def orders_nested(spark, d):
    """Lines nested into documents and taken out again, with their number in the whole order."""
    rows = N.explode_items(S.nested_items(Tables(spark, d)))
    return rows.select("l_orderkey", F.col("linea").cast("bigint").alias("linea"),
                       F.concat_ws(":", "producto_id", "cantidad", "precio_unit").alias("item"))


def graph_nodes(spark, d):
    return N.graph_nodes(S.graph_orders(Tables(spark, d)))


def graph_edges(spark, d):
    return N.graph_edges(S.graph_orders(Tables(spark, d)))


def json_props(spark, d):
    events = Tables(spark, d).events
    parsed = F.from_json("props", "k bigint")
    broken = F.when(F.col("event_type") == "error", F.concat("props", F.lit("x"))).otherwise(F.col("props"))
    return events.select("event_id", parsed["k"].alias("k"),
                         N.json_is_valid(broken).cast("bigint").alias("valido"))


def project_rename(spark, d):
    part = Q.rename_map(Tables(spark, d).part, {"p_name": "Nombre", "p_type": "Categoria"})
    return part.select("p_partkey", "Nombre", "Categoria",
                       F.when(F.col("p_size") > 25, "grande").alias("tamano"),
                       (F.col("p_size") * 2 + 1).cast("bigint").alias("calculado"))


def form_fields(spark, d):
    """Product form rows under two stores' column names."""
    form = Tables(spark, d).part.select(F.col("p_name").alias("nombre"), F.col("p_type").alias("categoria"),
                                        S.code("SKU-", "p_partkey").alias("codigo"), "p_size")
    first = Q.form_to_store(form, "SQL Server", "producto").select("SKU", "Nombre", "Categoria")
    second = Q.form_to_store(form, "MySQL", "producto").select("codigo_alt", "nombre", "categoria")
    return first.union(second).groupBy("SKU", "Nombre", "Categoria").agg(F.count("*").alias("veces"))


def to_response(spark, d):
    """Stored orders in listing shape, totals computed from the items."""
    t = Tables(spark, d)
    lines = S.order_items(t)
    totals = A.line_totals(lines, ["_id"], F.col("precio_unit"), F.col("cantidad"), F.col("descuento_pct"))
    docs = S.order_heads(t).drop("total").join(totals.select("_id", F.col("neto").alias("total"), "lineas"), "_id", "left")
    stored = docs.withColumns({
        "descripcion": F.lit(None).cast("string"), "metadatos": F.col("canal"),
        "creado": F.lit(None).cast("timestamp_ntz"), "actualizado": F.lit(None).cast("timestamp_ntz")})
    out = Q.to_response(stored, "ordenes", F.lit("2025-01-01").cast("timestamp_ntz"))
    return out.select("id", "cliente_id", "fecha", "canal", "moneda", "descripcion",
                      *S.double("total"), F.date_format("creado", "yyyy-MM-dd").alias("creado"),
                      F.coalesce("lineas", F.lit(0)).alias("lineas"))


def product_response(spark, d):
    t = Tables(spark, d)
    same = F.struct(S.code("SKU-", "p_partkey").alias("sku"), F.lit(None).cast("string").alias("codigo_alt"))
    stored = t.part.select(
        F.col("p_partkey").alias("_id"), F.when(F.col("p_type") == "SMALL", S.code("MN-", "p_partkey")).alias("codigo"),
        F.when(F.col("p_type") == "PROMO", S.code("MX-", "p_partkey")).alias("codigo_mongo"),
        F.col("p_name").alias("nombre"), F.col("p_type").alias("categoria"),
        F.when(F.col("p_size") > 10, same).alias("equivalencias"))
    return Q.to_response(stored, "productos").select(
        "id", "codigo_mongo", "nombre", "categoria", F.col("equivalencias.sku").alias("sku"),
        F.col("equivalencias").isNull().cast("bigint").alias("sin_equivalencias"))


# --- changes ----------------------------------------------------------------------------------
def _stored_customers(t: Tables):
    return t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("nombre"), F.col("c_mktsegment").alias("segmento"),
        F.col("c_nationkey").alias("pais"), F.lit("2020-01-01").cast("timestamp_ntz").alias("creado"),
        F.lit("2020-01-01").cast("timestamp_ntz").alias("actualizado"))


def _patches(t: Tables):
    """Indebted customers move to BUILDING and lose their country; suppliers' ids are unknown."""
    known = t.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("id"))
    unknown = t.supplier.select((-F.col("s_suppkey") - 1).alias("id"))
    set_country = F.col("id") > 700
    return known.unionByName(unknown).select(
        "id", F.lit("BUILDING").alias("segmento"), F.lit(None).cast("int").alias("pais"),
        F.lit("ignorado").cast("string").alias("creado_por"),
        F.when(set_country, F.array(F.lit("segmento"), F.lit("pais"))).otherwise(
            F.array(F.lit("segmento"))).alias("supplied"))


RUN = "2025-06-01 12:00:00"


def apply_changes(spark, d):
    t = Tables(spark, d)
    run_ts = F.lit(RUN).cast("timestamp_ntz")
    patched = U.apply_patches(_stored_customers(t), _patches(t), "id", run_ts)
    added = t.supplier.select((F.lit(-1000000) - F.col("s_suppkey")).alias("id"),
                              F.col("s_name").alias("nombre"), F.lit("PROV").alias("segmento"),
                              F.col("s_nationkey").alias("pais"))
    full = U.apply_inserts(patched, added, run_ts)
    gone = t.customer.where("c_nationkey = 3").select(F.col("c_custkey").alias("id"))
    left, _ = U.apply_deletes(full, gone, "id")
    return left.select("id", "nombre", "segmento", F.col("pais").cast("bigint").alias("pais"),
                       F.date_format("creado", "yyyy-MM-dd").alias("creado"),
                       F.date_format("actualizado", "yyyy-MM-dd").alias("actualizado"))


def change_report(spark, d):
    t = Tables(spark, d)
    return U.change_report(_stored_customers(t), _patches(t), "id")


def delete_report(spark, d):
    t = Tables(spark, d)
    ids = t.customer.where("c_nationkey = 3").select(F.col("c_custkey").alias("id")).unionByName(
        t.supplier.select((-F.col("s_suppkey") - 1).alias("id")))
    _, report = U.apply_deletes(_stored_customers(t), ids, "id")
    return report.select("id", F.col("eliminado").cast("bigint").alias("eliminado"))


def compare_snapshots(spark, d):
    t = Tables(spark, d)
    before = t.customer.where("c_nationkey < 20").select("c_custkey", "c_name", "c_mktsegment")
    moved = F.when(F.col("c_acctbal") < 0, "MOVED").otherwise(F.col("c_mktsegment"))
    after = t.customer.where("c_nationkey >= 5").select("c_custkey", "c_name", moved.alias("c_mktsegment"))
    return U.compare_snapshots(before, after, "c_custkey")


def upsert_dim(spark, d):
    t = Tables(spark, d)
    old = t.customer.where("c_nationkey < 15").select(
        (F.col("c_custkey") + 1).alias("ClienteID"), F.col("c_custkey").alias("Natural"),
        F.col("c_name").alias("Nombre"), F.lit("2020-01-01").cast("timestamp_ntz").alias("FechaCreacion"),
        F.lit("2020-01-01").cast("timestamp_ntz").alias("FechaActualizacion"))
    renamed = F.when(F.col("c_acctbal") < 0, F.concat("c_name", F.lit(" SA"))).otherwise(F.col("c_name"))
    new = t.customer.where("c_nationkey >= 10").select(F.col("c_custkey").alias("Natural"), renamed.alias("Nombre"))
    out = U.upsert_dim(old, new, ["Natural"], "ClienteID", F.lit(RUN).cast("timestamp_ntz"))
    return out.select("ClienteID", "Natural", "Nombre",
                      F.date_format("FechaCreacion", "yyyy-MM-dd").alias("FechaCreacion"),
                      F.date_format("FechaActualizacion", "yyyy-MM-dd").alias("FechaActualizacion"))


# --- baskets ----------------------------------------------------------------------------------
def _brands(spark, d):
    t = Tables(spark, d)
    part = t.part.select("p_partkey", "p_brand")
    return t.lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "p_brand")


def basket_pairs(spark, d):
    """Brand pairs bought together in at least 1% of the orders."""
    sets, _ = A.basket_rules(_brands(spark, d), "l_orderkey", "p_brand", 0.01, 0.05)
    pair = F.array_sort("items")
    return sets.where(F.size("items") == 2).select(
        pair[0].alias("a"), pair[1].alias("b"), "freq", F.round("support", 6).alias("support"))


def basket_rules(spark, d):
    """One-to-one rules among brands with their confidence."""
    _, rules = A.basket_rules(_brands(spark, d), "l_orderkey", "p_brand", 0.01, 0.05)
    one = rules.where((F.size("antecedent") == 1) & (F.size("consequent") == 1))
    return one.select(F.col("antecedent")[0].alias("si"), F.col("consequent")[0].alias("entonces"),
                      F.round("confidence", 6).alias("confianza"), F.round("lift", 6).alias("lift"))


def targets(spark, d):
    """Sales by order month against targets by shipping month."""


    t = Tables(spark, d)
    head = t.orders.select("o_orderkey", "o_custkey", date_key("o_orderdate").alias("TiempoID"))
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    lines = t.lineitem.join(head, F.col("l_orderkey") == F.col("o_orderkey"))
    fact = lines.select(F.col("o_custkey").alias("ClienteID"), F.col("l_partkey").alias("ProductoID"),
                        "TiempoID", price.alias("TotalVentaUSD"))
    goal = lines.select(F.col("o_custkey").alias("ClienteID"), F.col("l_partkey").alias("ProductoID"),
                        F.year("l_shipdate").alias("Anio"), F.month("l_shipdate").alias("Mes"),
                        (price * F.col("l_linenumber")).cast("decimal(18,2)").alias("MetaUSD"))
    return A.target_attainment(fact, goal).select(
        "ClienteID", "ProductoID", F.col("Anio").cast("bigint").alias("Anio"),
        F.col("Mes").cast("bigint").alias("Mes"), *S.double("ActualUSD", "MetaUSD", "Cumplimiento"))


QUERIES = {
    "order_totals": order_totals, "order_amounts": order_amounts, "exact_amounts": exact_amounts,
    "fractional_quantities": fractional_quantities, "line_amounts": line_amounts,
    "order_item_counts": item_counts, "order_stats": order_stats, "order_stats_empty": order_stats_empty,
    "page_orders": page_orders, "page_after": page_after, "list_view": list_view, "preview": preview,
    "filter_category": filter_category, "filter_customer": filter_customer, "filter_in": filter_in,
    "filter_date_range": filter_date_range, "search_products": search_products,
    "id_validity": id_validity, "lookup_ids": lookup_ids, "prefs_to_pairs": prefs_to_pairs,
    "pairs_to_prefs": pairs_to_prefs, "items_exploded": items_exploded, "orders_nested": orders_nested,
    "graph_nodes": graph_nodes, "graph_edges": graph_edges, "json_props": json_props,
    "project_rename": project_rename, "form_fields": form_fields, "to_response": to_response, "product_response": product_response,
    "apply_changes": apply_changes, "change_report": change_report, "delete_report": delete_report,
    "compare_snapshots": compare_snapshots, "upsert_dim": upsert_dim, "basket_pairs": basket_pairs,
    "basket_rules": basket_rules, "target_attainment": targets,
}

_PCT = "CAST(round(l_discount * 100) AS DECIMAL(5,2))"
_LINE = f"""CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_quantity AS DECIMAL(4,0))"""
_NET = f"CAST(sum({_LINE} * (CAST(100 AS DECIMAL(5,2)) - {_PCT})) AS DECIMAL(24,4))"
_GROSS = f"CAST(sum({_LINE} * CAST(100 AS DECIMAL(5,2))) AS DECIMAL(24,4))"


def _money(cents: str, scale: int = 2) -> str:
    return f"CAST(round(CAST({cents} AS DECIMAL(24,4)) * CAST(0.01 AS DECIMAL(3,2)), {scale}) AS DOUBLE)"


_STATS = """SELECT count(*) AS total_ordenes, coalesce(CAST(sum(t) AS DOUBLE), 0) AS total_revenue,
  coalesce(CAST((2 * sum(CAST(t * 100 AS HUGEINT)) + count(*)) // (2 * count(*)) AS DOUBLE) / 100, 0) AS avg_order_value,
  coalesce(CAST(min(t) AS DOUBLE), 0) AS min_order_value, coalesce(CAST(max(t) AS DOUBLE), 0) AS max_order_value
  FROM (SELECT CAST(o_totalprice AS DECIMAL(18,2)) AS t FROM orders{where})"""
_OID = "substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 24)"
_FOUND = "regexp_matches(p_name, 'ring|^promo', 'i') OR regexp_matches(p_type, 'ring|^promo', 'i')"
_PATCHED = """patches AS (SELECT c_custkey AS id FROM customer WHERE c_acctbal < 0
  UNION ALL SELECT -s_suppkey - 1 FROM supplier)"""
_BASKET = """b AS (SELECT DISTINCT l_orderkey AS o, p_brand AS i FROM lineitem JOIN part ON l_partkey = p_partkey),
  n AS (SELECT count(DISTINCT o) AS n FROM b), one AS (SELECT i, count(*) AS c FROM b GROUP BY 1),
  two AS (SELECT x.i AS a, y.i AS b, count(*) AS c FROM b x JOIN b y ON x.o = y.o AND x.i <> y.i
          GROUP BY 1, 2 HAVING count(*) >= 0.01 * (SELECT n FROM n))"""

SQL = {
    "order_totals": f"SELECT l_orderkey, {_money(_NET)} AS total FROM lineitem GROUP BY 1",
    "exact_amounts": """WITH l AS (SELECT l_orderkey, CAST(l_quantity AS HUGEINT) AS q,
          (2 * CAST(round(l_extendedprice * 100) AS HUGEINT) * 10 + 7) // 14 AS p,
          (2 * CAST(l_partkey % 997 AS HUGEINT) * 10000 + 13) // 26 AS d FROM lineitem),
        s AS (SELECT l_orderkey, sum(p * q * 1000000)::HUGEINT AS g, sum(p * q * (1000000 - d))::HUGEINT AS n FROM l GROUP BY 1)
        SELECT l_orderkey, ((2 * g + 10000000) // 20000000)::DOUBLE / 100 AS subtotal,
          CASE WHEN g >= n THEN ((2 * (g - n) + 10000000) // 20000000)::DOUBLE / 100 END AS descuento,
          CASE WHEN n >= 0 THEN ((2 * n + 10000000) // 20000000)::DOUBLE / 100 END AS neto FROM s""",
    "fractional_quantities": f"""SELECT DISTINCT substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 24) AS "row",
        'item_quantity' AS rule FROM lineitem WHERE l_linenumber = 5""",
    "order_amounts": f"""SELECT l_orderkey, {_money(_GROSS)} AS subtotal,
        {_money(f'({_GROSS} - {_NET})')} AS descuento, {_money(_NET)} AS neto FROM lineitem GROUP BY 1""",
    "line_amounts": f"""SELECT l_orderkey, 'P' || l_partkey AS producto_id,
        {_money(f'{_LINE} * CAST(100 AS DECIMAL(5,2))', 4)} AS subtotal,
        {_money(f'{_LINE} * {_PCT}', 4)} AS descuento,
        {_money(f'{_LINE} * (CAST(100 AS DECIMAL(5,2)) - {_PCT})', 4)} AS neto FROM lineitem""",
    "order_item_counts": f"""SELECT {_OID} AS _id, count(l_orderkey) AS lineas FROM orders
        LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""",
    "order_stats": _STATS.format(where=""),
    "order_stats_empty": _STATS.format(where=" WHERE o_totalprice < 0"),
    "page_orders": """SELECT o_orderkey, o_totalprice, (SELECT count(*) FROM orders) AS total,
        (SELECT (count(*) + 19) // 20 FROM orders) AS pages, 3 AS page, 20 AS "limit"
        FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 40""",
    "page_after": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey > 1000 ORDER BY 1 LIMIT 50",
    "list_view": f"""SELECT p_partkey, p_name, p_type, p_retailprice, n AS total, (n + 14) // 15 AS pages
        FROM part, (SELECT count(*) AS n FROM part WHERE {_FOUND}) WHERE {_FOUND}
        ORDER BY p_retailprice DESC, p_partkey LIMIT 15 OFFSET 15""",
    "preview": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10",
    "filter_category": "SELECT p_partkey, p_type FROM part WHERE p_type = 'SMALL'",
    "filter_customer": "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey = 7",
    "filter_in": """SELECT o_orderkey, o_orderpriority FROM orders
        WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""",
    "filter_date_range": """SELECT event_id, event_type FROM events
        WHERE ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-20'""",
    "search_products": """SELECT p_partkey, p_name, p_type FROM part
        WHERE regexp_matches(p_name, 'RING|^eco|l.*t$', 'i') OR regexp_matches(p_type, 'RING|^eco|l.*t$', 'i')""",
    "id_validity": """SELECT o_orderkey, CASE WHEN regexp_full_match(
        substr(md5(CAST(o_orderkey AS VARCHAR)), 1, CASE o_orderstatus WHEN 'P' THEN 23 ELSE 24 END),
        '[0-9a-fA-F]{24}') THEN 1 ELSE 0 END AS valido FROM orders""",
    "lookup_ids": """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (
        SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus <> 'O')""",
    "prefs_to_pairs": """SELECT c_custkey, 'canal=' || c_mktsegment || ',WEB;saldo=' || c_nationkey || ';vacio='
        AS pares FROM customer""",
    "pairs_to_prefs": """SELECT c_custkey, 'canal=WEB+' || c_mktsegment || ';segmento=' || c_mktsegment || '+'
        || c_nationkey AS mapa FROM customer""",
    "items_exploded": f"""SELECT substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 24) AS _id, row_number() OVER (
        PARTITION BY l_orderkey ORDER BY 'P' || l_partkey, l_quantity, l_extendedprice, l_discount) AS linea,
        'P' || l_partkey AS producto_id, CAST(l_quantity AS BIGINT) AS cantidad,
        l_extendedprice AS precio_unit, CAST({_PCT} AS DOUBLE) AS descuento_pct FROM lineitem""",
    "orders_nested": """SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey
          ORDER BY 'P' || l_partkey, l_quantity, l_extendedprice, l_discount) AS linea, 'P' || l_partkey || ':' ||
        CAST(l_quantity AS INTEGER) || ':' || CAST(l_extendedprice AS DECIMAL(10,2)) AS item FROM lineitem""",
    "graph_nodes": """WITH o AS (SELECT * FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem))
        SELECT 'Cliente' AS label, 'C-' || c_custkey AS id,
          '{"id":"C-' || c_custkey || '","nombre":"' || c_name || '"}' AS props
          FROM customer WHERE c_custkey IN (SELECT o_custkey FROM o)
        UNION ALL SELECT 'Orden', 'O-' || o_orderkey, '{"id":"O-' || o_orderkey || '","fecha":"' ||
          strftime(o_orderdate, '%Y-%m-%d') || '","canal":"WEB","moneda":"CRC","total":' ||
          CAST(o_totalprice AS DECIMAL(18,2)) || '}' FROM o
        UNION ALL SELECT 'Producto', 'P-' || p_partkey, '{"id":"P-' || p_partkey || '","nombre":"' || p_name
          || '","categoria":"' || p_type || '"}' FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem)""",
    "graph_edges": """SELECT DISTINCT 'O-' || o_orderkey AS src, 'C-' || o_custkey AS dst, 'REALIZADA_POR' AS type,
        NULL AS props FROM orders JOIN lineitem ON l_orderkey = o_orderkey
        UNION ALL SELECT 'O-' || l_orderkey, 'P-' || l_partkey, 'CONTIENE', '{"cantidad":' ||
        CAST(l_quantity AS INTEGER) || ',"precio_unit":' || CAST(l_extendedprice AS DECIMAL(18,2)) || '}'
        FROM lineitem""",
    "json_props": """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
        CASE WHEN json_valid(CASE WHEN event_type = 'error' THEN props || 'x' ELSE props END)
        THEN 1 ELSE 0 END AS valido FROM events""",
    "project_rename": """SELECT p_partkey, p_name AS Nombre, p_type AS Categoria,
        CASE WHEN p_size > 25 THEN 'grande' END AS tamano, p_size * 2 + 1 AS calculado FROM part""",
    "form_fields": """SELECT 'SKU-' || p_partkey AS SKU, p_name AS Nombre, p_type AS Categoria, 2 AS veces
        FROM part""",
    "to_response": f"""SELECT {_OID} AS id, 'C' || o_custkey AS cliente_id,
        strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS fecha,
        CASE WHEN o_orderstatus <> 'P' THEN 'WEB' END AS canal,
        CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'USD' ELSE 'CRC' END AS moneda,
        CASE WHEN o_orderstatus <> 'P' THEN 'WEB' END AS descripcion,
        coalesce(total, 0) AS total, '2025-01-01' AS creado, coalesce(lineas, 0) AS lineas
        FROM orders LEFT JOIN (SELECT l_orderkey, {_money(_NET)} AS total, count(*) AS lineas
        FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""",
    "product_response": """SELECT CAST(p_partkey AS VARCHAR) AS id, CASE p_type WHEN 'SMALL' THEN 'MN-' || p_partkey
        WHEN 'PROMO' THEN 'MX-' || p_partkey ELSE '' END AS codigo_mongo, p_name AS nombre, p_type AS categoria,
        CASE WHEN p_size > 10 THEN 'SKU-' || p_partkey END AS sku,
        CASE WHEN p_size > 10 THEN 0 ELSE 1 END AS sin_equivalencias FROM part""",
    "apply_changes": """SELECT c_custkey AS id, c_name AS nombre,
        CASE WHEN c_acctbal < 0 THEN 'BUILDING' ELSE c_mktsegment END AS segmento,
        CASE WHEN c_acctbal < 0 AND c_custkey > 700 THEN NULL ELSE c_nationkey END AS pais,
        '2020-01-01' AS creado, CASE WHEN c_acctbal < 0 THEN '2025-06-01' ELSE '2020-01-01' END AS actualizado
        FROM customer WHERE c_nationkey <> 3
        UNION ALL SELECT -1000000 - s_suppkey, s_name, 'PROV', s_nationkey, '2025-06-01', '2025-06-01' FROM supplier""",
    "change_report": f"""WITH {_PATCHED} SELECT id, CASE WHEN c_custkey IS NULL THEN 'not found'
        WHEN c_mktsegment = 'BUILDING' AND id <= 700 THEN 'unchanged' ELSE 'modified' END AS estado
        FROM patches LEFT JOIN customer ON c_custkey = id""",
    "delete_report": """SELECT c_custkey AS id, 1 AS eliminado FROM customer WHERE c_nationkey = 3
        UNION ALL SELECT -s_suppkey - 1, 0 FROM supplier""",
    "compare_snapshots": """SELECT c_custkey, CASE WHEN c_nationkey < 5 THEN 'deleted'
        WHEN c_nationkey >= 20 THEN 'inserted' WHEN c_acctbal < 0 THEN 'modified' ELSE 'unchanged' END AS estado
        FROM customer""",
    "upsert_dim": """SELECT c_custkey + 1 AS ClienteID, c_custkey AS "Natural",
        CASE WHEN c_nationkey >= 10 AND c_acctbal < 0 THEN c_name || ' SA' ELSE c_name END AS Nombre,
        '2020-01-01' AS FechaCreacion,
        CASE WHEN c_nationkey >= 10 AND c_acctbal < 0 THEN '2025-06-01' ELSE '2020-01-01' END AS FechaActualizacion
        FROM customer WHERE c_nationkey < 15
        UNION ALL SELECT (SELECT max(c_custkey) + 1 FROM customer WHERE c_nationkey < 15) + row_number() OVER (
          ORDER BY md5(CAST(c_custkey AS VARCHAR)), c_custkey), c_custkey,
        CASE WHEN c_acctbal < 0 THEN c_name || ' SA' ELSE c_name END, '2025-06-01', '2025-06-01'
        FROM customer WHERE c_nationkey >= 15""",
    "basket_pairs": f"""WITH {_BASKET} SELECT a, b, c AS freq, round(c / (SELECT n FROM n), 6) AS support
        FROM two WHERE a < b""",
    "basket_rules": f"""WITH {_BASKET} SELECT a AS si, b AS entonces, round(two.c / x.c, 6) AS confianza,
        round((two.c / x.c) / (y.c / (SELECT n FROM n)), 6) AS lift
        FROM two JOIN one x ON x.i = a JOIN one y ON y.i = b WHERE two.c / x.c >= 0.05""",
    "target_attainment": """WITH s AS (SELECT o_custkey AS c, l_partkey AS p, year(o_orderdate) AS y,
          month(o_orderdate) AS m, sum(CAST(round(l_extendedprice * 100) AS HUGEINT)) AS a
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3, 4),
        g AS (SELECT o_custkey AS c, l_partkey AS p, year(l_shipdate) AS y, month(l_shipdate) AS m,
          sum(CAST(round(l_extendedprice * 100) AS HUGEINT) * l_linenumber) AS t
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3, 4)
        SELECT c AS ClienteID, p AS ProductoID, y AS Anio, m AS Mes, CAST(coalesce(a, 0) AS DOUBLE) / 100 AS ActualUSD,
        CAST(t AS DOUBLE) / 100 AS MetaUSD,
        CAST((20000 * coalesce(a, 0) + t) // (2 * t) AS DOUBLE) / 10000 AS Cumplimiento
        FROM s FULL JOIN g USING (c, p, y, m)""",
}
