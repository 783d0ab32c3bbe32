"""Nested orders, preference maps and JSON columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesales._cols import C, as_col
from lakesales.functions.money import from_cents, net_cents

SUM = "decimal(38,10)"


def _sum(items: Column, value) -> Column:
    return F.aggregate(items, F.lit(0).cast(SUM),
                       lambda acc, i: (acc + value(i)).cast(SUM))


def _net(i: Column) -> Column:
    return net_cents(i["precio_unit"], i["cantidad"], i["descuento_pct"])


def _gross(i: Column) -> Column:
    return net_cents(i["precio_unit"], i["cantidad"])


def order_total(items: C) -> Column:
    """Net total of an item array, rounded once at the end; no items make 0, an item without an amount makes NULL."""
    return from_cents(F.when(F.coalesce(F.size(as_col(items)), F.lit(0)) <= 0, F.lit(0).cast(SUM))
                      .otherwise(_sum(as_col(items), _net)))


def order_amounts(items: C) -> Column:
    """Struct of subtotal, discount and net of an item array."""
    items = as_col(items)
    gross, net = _sum(items, _gross), _sum(items, _net)
    return F.struct(from_cents(gross).alias("subtotal"),
                    from_cents(gross - net).alias("descuento"),
                    from_cents(net).alias("neto"))


def line_amounts(items: C) -> Column:
    """Item array with subtotal, discount and net added to every item."""
    return F.transform(as_col(items), lambda i: F.struct(
        i["producto_id"].alias("producto_id"), i["cantidad"].alias("cantidad"),
        i["precio_unit"].alias("precio_unit"), i["descuento_pct"].alias("descuento_pct"),
        from_cents(_gross(i), 4).alias("subtotal"),
        from_cents(_gross(i) - _net(i), 4).alias("descuento"),
        from_cents(_net(i), 4).alias("neto")))


def item_count(items: C) -> Column:
    return F.size(F.coalesce(as_col(items), F.array()))


def explode_items(df: DataFrame, items: str = "items", line: str = "linea",
                  keep_empty: bool = False) -> DataFrame:
    """One row per array element with its position and the element's fields beside the parent's.

    Parents with an empty array vanish unless ``keep_empty``. A column ``primera`` (the line number of the array's
    first element, see ``keys.nest_items``) makes positions go on over the parts of one parent.
    """
    parents = [c for c in df.columns if c not in (items, "parte", "primera")]
    generator = F.posexplode_outer if keep_empty else F.posexplode
    first = F.coalesce("primera", F.lit(1)) if "primera" in df.columns else F.lit(1)
    rows = df.select(*parents, first.alias("_first"), generator(items).alias("_pos", "_item"))
    return rows.select(*parents, (F.col("_pos") + F.col("_first")).alias(line), "_item.*")


def prefs_to_pairs(prefs: C) -> Column:
    """Map to array of (categoria, texto): lists joined by a comma, scalars as text.

    The map is read as string to string, so a list arrives as its JSON text.
    """
    def text(value: Column) -> Column:
        listed = F.from_json(F.when(value.startswith("["), value), "array<string>")
        return F.coalesce(F.array_join(listed, ","), value)

    return F.transform(F.map_entries(as_col(prefs)), lambda e: F.struct(
        e["key"].alias("categoria"), text(e["value"]).alias("texto")))


def pairs_to_prefs(pairs: C) -> Column:
    """Array of (categoria, texto) to a map of lists; of equal categories the last one wins."""
    pairs = as_col(pairs)
    last = F.filter(pairs, lambda p, i: ~F.exists(
        F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["categoria"] == p["categoria"]))
    return F.map_from_entries(F.transform(last, lambda p: F.struct(
        p["categoria"].alias("key"), F.split(p["texto"], ",").alias("value"))))


def json_is_valid(c: C) -> Column:
    """False for text that is not exactly one JSON value; NULL and blank pass.

    The parser stops after the first value, so the text is parsed as the first of two array
    elements: only a single complete value leaves the second one in place.
    """
    c = as_col(c)
    last = "-lakesales-end-"
    pair = F.try_parse_json(F.concat(F.lit("["), c, F.lit(f',"{last}"]')))
    whole = F.coalesce(F.try_variant_get(pair, "$[1]", "string") == last, F.lit(False))
    return F.when(F.trim(c) != "", whole)


def agg_sales_rows(df: DataFrame) -> DataFrame:
    """(anio, mes, ventas[]) to one row per sale with its USD total."""
    flat = df.select("anio", "mes", F.explode("ventas").alias("v"))
    total = (F.col("v.cantidad") * F.col("v.precio")).cast("decimal(37,8)")
    return flat.select("anio", "mes", F.col("v.item").alias("item"),
                       F.col("v.cantidad").alias("cantidad"), F.col("v.precio").alias("precio"),
                       total.alias("TotalUSD"))


def graph_nodes(df: DataFrame) -> DataFrame:
    """Nested graph orders to distinct (id, label, props) nodes; props as JSON text.

    The orders are read once: each gives its customer, itself and its products.
    """
    def node(label: str, c: Column) -> Column:
        return F.struct(F.lit(label).alias("label"), c["id"].alias("id"), F.to_json(c).alias("props"))

    ends = F.array(node("Cliente", F.col("cliente")), node("Orden", F.col("orden")))
    products = F.transform("items", lambda i: node("Producto", i["producto"]))
    nodes = df.select(F.explode(F.concat(ends, products)).alias("n")).select("n.*")
    # the same customer or product comes with every order: one node per label and id
    return nodes.groupBy("label", "id").agg(F.max("props").alias("props"))


def graph_edges(df: DataFrame) -> DataFrame:
    """Nested graph orders to order-to-customer and order-to-product relationships.

    An order may come in several parts: its customer edge is there once all the same.
    """
    def edge(kind: str, dst: Column, props: Column) -> list[Column]:
        return [F.col("orden.id").alias("src"), dst.alias("dst"), F.lit(kind).alias("type"), props.alias("props")]

    to_client = df.select(*edge("REALIZADA_POR", F.col("cliente.id"), F.lit(None).cast("string"))).distinct()
    lines = df.select("orden", F.explode("items").alias("i"))
    to_products = lines.select(*edge("CONTIENE", F.col("i.producto.id"), F.to_json(
        F.struct(F.col("i.cantidad").alias("cantidad"), F.col("i.precio_unit").alias("precio_unit")))))
    return to_client.unionByName(to_products)
