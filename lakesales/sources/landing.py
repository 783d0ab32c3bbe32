"""Each source's own tables to one landed shape; texts are cleaned later, once, for all sources."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesales.functions.dates import utc_text
from lakesales.functions.nested import explode_items
from lakesales.schemas import LANDED_CUSTOMERS, LANDED_LINES, LANDED_PRODUCTS

# where each source keeps a landed column; a column it lacks is NULL
CUSTOMER_COLUMNS = {
    "SQL Server": {"ClienteID_Natural": "ClienteId", "nombre": "Nombre", "email": "Email",
                   "genero": "Genero", "pais": "Pais", "fecha_registro": "FechaRegistro"},
    "MySQL": {"ClienteID_Natural": "id", "nombre": "nombre", "email": "correo",
              "genero": "genero", "pais": "pais", "fecha_registro": "created_at"},
    "Supabase": {"ClienteID_Natural": "cliente_id", "nombre": "nombre", "email": "email",
                 "genero": "genero", "pais": "pais", "fecha_registro": "fecha_registro"},
    "MongoDB": {"ClienteID_Natural": "_id", "nombre": "nombre", "email": "email",
                "genero": "genero", "pais": "pais", "fecha_registro": "creado"},
    "Neo4j": {"ClienteID_Natural": "id", "nombre": "nombre", "email": "email",
              "genero": "genero"},
}
PRODUCT_COLUMNS = {
    "SQL Server": {"producto_id": "ProductoId", "CodigoFuente": "SKU", "sku": "SKU",
                   "nombre": "Nombre", "categoria": "Categoria"},
    "MySQL": {"producto_id": "id", "CodigoFuente": "codigo_alt", "codigo_alt": "codigo_alt",
              "nombre": "nombre", "categoria": "categoria"},
    "Supabase": {"producto_id": "producto_id", "CodigoFuente": "producto_id", "sku": "sku",
                 "nombre": "nombre", "categoria": "categoria"},
    "MongoDB": {"producto_id": "_id", "CodigoFuente": "codigo_mongo",
                "sku": "equivalencias.sku", "codigo_alt": "equivalencias.codigo_alt",
                "codigo_mongo": "codigo_mongo", "nombre": "nombre", "categoria": "categoria"},
    "Neo4j": {"producto_id": "id", "CodigoFuente": "id", "sku": "sku",
              "codigo_alt": "codigo_alt", "codigo_mongo": "codigo_mongo", "nombre": "nombre",
              "categoria": "categoria"},
}


def _land(df: DataFrame, source: str, shape: list[str], mapping: Mapping[str, str]) -> DataFrame:
    def column(target: str):
        name = mapping.get(target)
        if name is None or name.split(".")[0] not in df.columns:
            return F.lit(None).cast("string").alias(target)
        if name in instants:
            return utc_text(name).alias(target)
        return F.col(name).cast("string").alias(target)

    instants = {f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)}
    return df.select(F.lit(source).alias("FuenteOrigen"), *[column(c) for c in shape[1:]])


def land_customers(source: str, customers: DataFrame) -> DataFrame:
    return _land(customers, source, LANDED_CUSTOMERS, CUSTOMER_COLUMNS[source])


def land_products(source: str, products: DataFrame) -> DataFrame:
    mapping = dict(PRODUCT_COLUMNS[source])
    if source == "MongoDB" and "codigo" in products.columns:
        # both spellings of the code occur in stored documents
        products = products.withColumn("codigo_mongo", F.coalesce("codigo_mongo", "codigo")
                                       if "codigo_mongo" in products.columns else F.col("codigo"))
    return _land(products, source, LANDED_PRODUCTS, mapping)


def _relational(lines, orders, source, order_id, customer, line_order, product, date, channel,
                currency, qty, price, discount=None) -> DataFrame:
    head = orders.select(F.col(order_id).alias("_o"), F.col(customer).alias("_c"),
                         F.col(date).alias("_d"), F.col(channel).alias("_ch"),
                         F.col(currency).alias("_m"))
    rows = lines.join(head, F.col(line_order) == F.col("_o"))
    return _land(rows, source, LANDED_LINES, {
        "OrdenID_Natural": "_o", "ClienteID_Natural": "_c", "producto_id": product,
        "fecha": "_d", "canal": "_ch", "moneda": "_m", "cantidad": qty, "precio_unit": price,
        **({"descuento_pct": discount} if discount else {})})


def land_lines(source: str, orders: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Order lines with their header's fields. Nested sources need no ``lines``."""
    if source == "SQL Server":
        return _relational(lines, orders, source, "OrdenId", "ClienteId", "OrdenId", "ProductoId",
                           "Fecha", "Canal", "Moneda", "Cantidad", "PrecioUnit", "DescuentoPct")
    if source == "MySQL":
        return _relational(lines, orders, source, "id", "cliente_id", "orden_id", "producto_id",
                           "fecha", "canal", "moneda", "cantidad", "precio_unit")
    if source == "Supabase":
        return _relational(lines, orders, source, "orden_id", "cliente_id", "orden_id",
                           "producto_id", "fecha", "canal", "moneda", "cantidad", "precio_unit")
    if source == "MongoDB":
        rows = explode_items(orders.select("_id", "cliente_id", "fecha", "canal", "moneda", "items"))
        return _land(rows, source, LANDED_LINES, {
            "OrdenID_Natural": "_id", "ClienteID_Natural": "cliente_id",
            "producto_id": "producto_id", "fecha": "fecha", "canal": "canal", "moneda": "moneda",
            "cantidad": "cantidad", "precio_unit": "precio_unit",
            "descuento_pct": "descuento_pct"})
    if source == "Neo4j":
        rows = explode_items(orders.select("orden", "cliente", "items"))
        return _land(rows, source, LANDED_LINES, {
            "OrdenID_Natural": "orden.id", "ClienteID_Natural": "cliente.id",
            "producto_id": "producto.id", "fecha": "orden.fecha", "canal": "orden.canal",
            "moneda": "orden.moneda", "cantidad": "cantidad", "precio_unit": "precio_unit"})
    raise ValueError(f"unknown source: {source}")


def unify(frames: list[DataFrame]) -> DataFrame:
    """Landed frames of all sources under one another; a column a source lacks is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
