"""Unified warehouse of five sources: dimensions, product code bridge, USD sales fact, targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesales.functions.conform import canonical_channel, canonical_currency, unify_gender
from lakesales.functions.dates import (date_key, month_name_es, parse_date_text, weekday_name_es)
from lakesales.functions.money import cents_to_usd, exact_text, net_cents, parse_money, to_usd, whole
from lakesales.functions.text import blank_to_null, norm_key
from lakesales.operators.joins import match_by_name, resolve_sku
from lakesales.operators.keys import assign_keys
from lakesales.operators.validation import (Rule, explode_errors, in_range, max_length, one_of, parsed,
                                            required, with_errors)
from lakesales.plans.erp_warehouse import date_spine
from lakesales.schemas import MONEDAS, SOURCES
from lakesales.sources.sinks import write_table


def _now(run_ts: Column | None) -> Column:
    return F.current_timestamp() if run_ts is None else run_ts


def time_dimension(bounds: DataFrame, run_ts: Column | None = None) -> DataFrame:
    d = F.col("d")
    return date_spine(bounds).select(
        date_key(d).alias("TiempoID"), d.alias("FechaCompleta"), F.dayofmonth(d).alias("Dia"),
        F.month(d).alias("Mes"), F.quarter(d).alias("Trimestre"), F.year(d).alias("Anio"),
        month_name_es(d).alias("NombreMes"), weekday_name_es(d).alias("NombreDiaSemana"),
        F.dayofweek(d).alias("DiaSemana"), F.dayofweek(d).isin(1, 7).alias("EsFinDeSemana"),
        F.date_format(d, "yyyy-MM").alias("MesAnio"), _now(run_ts).alias("FechaCreacion"))


def _stamped(df: DataFrame, run_ts: Column | None) -> DataFrame:
    return df.withColumns({"FechaCreacion": _now(run_ts), "FechaActualizacion": _now(run_ts)})


CUSTOMER = ["Nombre", "Email", "Genero", "Pais", "FechaRegistro"]


def _typed_customers(landed: DataFrame, default_country: str, default_date: str) -> DataFrame:
    day = F.to_date(parse_date_text("fecha_registro"))
    given = blank_to_null("fecha_registro").isNotNull()
    return landed.select(
        "FuenteOrigen", blank_to_null("ClienteID_Natural").alias("ClienteID_Natural"),
        blank_to_null("nombre").alias("Nombre"), F.lower(blank_to_null("email")).alias("Email"),
        unify_gender("genero").alias("Genero"),
        F.coalesce(blank_to_null("pais"), F.lit(default_country)).alias("Pais"),
        F.when(given, day).otherwise(F.lit(default_date).cast("date")).alias("FechaRegistro"))


def customer_conflicts(landed: DataFrame, default_country: str = "No Especificado",
                       default_date: str = "1900-01-01") -> DataFrame:
    """Source keys whose rows differ after cleaning, with the number of different rows."""
    rows = _typed_customers(landed, default_country, default_date).where("ClienteID_Natural is not null").distinct()
    return rows.groupBy("FuenteOrigen", "ClienteID_Natural").agg(F.count("*").alias("filas")).where("filas > 1")


def clean_customers(landed: DataFrame, default_country: str = "No Especificado",
                    default_date: str = "1900-01-01") -> tuple[DataFrame, DataFrame]:
    """One cleaned row per source key, and the reject lines.

    The graph source has neither country nor registration date: the defaults stand in there. A
    date that is given but unreadable rejects the row.
    """
    rows = _typed_customers(landed, default_country, default_date)
    # a key delivered twice counts once; the greater row wins, so reruns agree, and customer_conflicts lists it
    keyed = rows.where("ClienteID_Natural is not null").groupBy(
        "FuenteOrigen", "ClienteID_Natural").agg(F.max(F.struct(*CUSTOMER)).alias("_r"))
    keyed = keyed.select("FuenteOrigen", "ClienteID_Natural", "_r.*")
    # rows without a key are no copies of each other: every one is reported
    rows = keyed.unionByName(rows.where("ClienteID_Natural is null"))
    flagged = with_errors(rows, [required("ClienteID_Natural"), required("Nombre"),
                                 required("FechaRegistro"), one_of("FuenteOrigen", SOURCES)])
    return flagged.where(F.size("errors") == 0).drop("errors"), explode_errors(
        flagged, "ClienteID_Natural")


def dim_cliente(landed: DataFrame, run_ts: Column | None = None, **defaults) -> DataFrame:
    good, _ = clean_customers(landed, **defaults)
    return _stamped(assign_keys(good, ["FuenteOrigen", "ClienteID_Natural"], "ClienteID"), run_ts)


def dim_producto(landed: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """One member per official SKU, described by the first source that has it."""
    rank = F.array_position(F.array(*[F.lit(s) for s in SOURCES]), F.col("FuenteOrigen"))
    rows = (landed.where(blank_to_null("sku").isNotNull())
            .groupBy(norm_key(F.trim("sku")).alias("SKU_Oficial"))
            .agg(F.min(F.struct(rank.alias("rank"), "nombre", "categoria", "FuenteOrigen")).alias("_r"))
            .select("SKU_Oficial", F.col("_r.nombre").alias("Nombre"),
                    F.col("_r.categoria").alias("Categoria"), "_r.FuenteOrigen"))
    return _stamped(assign_keys(rows, ["SKU_Oficial"], "ProductoID"), run_ts)


def check_products(landed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Source products that may enter the dimension, and the reject lines of the others."""
    flagged = with_errors(landed, [
        required("nombre"), max_length("nombre", 150), required("categoria"), max_length("categoria", 80),
        max_length("sku", 40), one_of("FuenteOrigen", SOURCES)])
    return flagged.where(F.size("errors") == 0).drop("errors"), explode_errors(flagged, "producto_id")


def _one_sku(pairs: DataFrame) -> DataFrame:
    """Codes that lead to exactly one SKU."""
    return (pairs.groupBy("FuenteOrigen", "CodigoFuente")
            .agg(F.min("SKU_Oficial").alias("SKU_Oficial"), F.max("SKU_Oficial").alias("_other"))
            .where("SKU_Oficial = _other").drop("_other"))


def sku_conflicts(pairs: DataFrame) -> DataFrame:
    """Codes that lead to different SKUs; they resolve nothing until someone decides."""
    return (pairs.groupBy("FuenteOrigen", "CodigoFuente").agg(F.count_distinct("SKU_Oficial").alias("skus"))
            .where("skus > 1"))


def stated_codes(landed: DataFrame) -> DataFrame:
    """Code to SKU pairs the sources state themselves, as bridge rows; contradictions are left out."""
    return _one_sku(stated_pairs(landed))


def stated_pairs(landed: DataFrame) -> DataFrame:
    sku = norm_key(F.trim("sku"))
    known = landed.where(blank_to_null("sku").isNotNull())
    own = known.select("FuenteOrigen", F.col("CodigoFuente"), sku.alias("SKU_Oficial"))
    alt = known.select(F.lit("MySQL").alias("FuenteOrigen"),
                       F.col("codigo_alt").alias("CodigoFuente"), sku.alias("SKU_Oficial"))
    mongo = known.select(F.lit("MongoDB").alias("FuenteOrigen"),
                         F.col("codigo_mongo").alias("CodigoFuente"), sku.alias("SKU_Oficial"))
    pairs = own.unionByName(alt).unionByName(mongo).select(
        "FuenteOrigen", blank_to_null("CodigoFuente").alias("CodigoFuente"), "SKU_Oficial")
    return pairs.where("CodigoFuente is not null")


def resolve_products(landed: DataFrame, dim: DataFrame,
                     override: DataFrame | None = None) -> DataFrame:
    """Every source product with its official SKU, how it was found, or why it was not."""
    by_code = resolve_sku(landed, stated_codes(landed), dim, override)
    by_name = match_by_name(by_code.withColumnRenamed("SKU_Oficial", "_by_code"), dim)
    return by_name.select(
        *landed.columns, F.coalesce("_by_code", "SKU_Oficial").alias("SKU_Oficial"),
        F.coalesce("resolved_by", F.when(F.col("SKU_Oficial").isNotNull(), "nombre")).alias("resolved_by"),
        F.when(F.col("_by_code").isNull(), F.col("motivo")).alias("motivo"))


def product_bridge(resolved: DataFrame) -> DataFrame:
    """(FuenteOrigen, CodigoFuente) to SKU, one row per code; contradictions are in ``sku_conflicts``."""
    return _one_sku(resolved.where("SKU_Oficial is not null and CodigoFuente is not null"))


def map_producto(bridge: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """The bridge with its key and creation time, as it is stored."""
    return assign_keys(bridge, ["FuenteOrigen", "CodigoFuente"], "MapID").withColumn("FechaCreacion", _now(run_ts))


def dim_canal(orders: DataFrame, channel: str = "canal", run_ts: Column | None = None) -> DataFrame:
    names = orders.select(canonical_channel(channel).alias("NombreCanal")).where(
        "NombreCanal is not null").distinct()
    keyed = assign_keys(names, ["NombreCanal"], "CanalID")
    now = F.current_timestamp() if run_ts is None else run_ts
    return keyed.withColumn("Descripcion", F.lit(None).cast("string")).withColumn("FechaCreacion", now)


def clean_lines(landed: DataFrame) -> DataFrame:
    """Landed texts to typed values; what cannot be read becomes NULL."""
    typed = landed.select(
        "FuenteOrigen", "OrdenID_Natural", "ClienteID_Natural", "producto_id",
        F.to_date(parse_date_text("fecha")).alias("Fecha"),
        canonical_channel("canal").alias("NombreCanal"),
        canonical_currency("moneda").alias("MonedaOrigen"),
        whole(blank_to_null("cantidad")).try_cast("int").alias("Cantidad"),
        parse_money("precio_unit", scale=6).alias("Precio"),
        "descuento_pct", exact_text(blank_to_null("descuento_pct"), 7, 4).alias("DescuentoPct"))
    return typed.withColumn("TiempoID", date_key("Fecha"))


def _sales_rules() -> list[Rule]:
    return [
        Rule("fecha", "format", "fecha is no valid date", F.col("Fecha").isNotNull()),
        required("NombreCanal"), required("MonedaOrigen"), one_of("MonedaOrigen", MONEDAS),
        required("Cantidad"), in_range("Cantidad", above=0),
        Rule("precio_unit", "format", "precio_unit is no amount", F.col("Precio").isNotNull()),
        in_range("Precio", low=0), parsed("DescuentoPct", "descuento_pct", "percentage"),
        in_range("DescuentoPct", low=0, high=100),
        Rule("fecha", "rate", "no exchange rate on that day",
             (F.col("MonedaOrigen") != "CRC") | F.col("TipoCambio_USD_CRC").isNotNull()),
        Rule("ClienteID_Natural", "reference", "customer not found", F.col("ClienteID").isNotNull()),
        Rule("producto_id", "reference", "product not found", F.col("ProductoID").isNotNull()),
        Rule("canal", "reference", "channel not found",
             F.col("NombreCanal").isNull() | F.col("CanalID").isNotNull()),
    ]


def product_lookup(resolved: DataFrame, products: DataFrame) -> DataFrame:
    """(FuenteOrigen, producto_id) to ProductoID, one row per source product that has one SKU.

    A product that was delivered with different SKUs leads nowhere until someone decides, see ``product_conflicts``.
    """
    return (resolved.select("FuenteOrigen", "producto_id", "SKU_Oficial")
            .join(products.select("SKU_Oficial", "ProductoID"), "SKU_Oficial")
            .groupBy("FuenteOrigen", "producto_id")
            .agg(F.min("ProductoID").alias("ProductoID"), F.max("ProductoID").alias("_other"))
            .where("ProductoID = _other").drop("_other"))


def product_conflicts(resolved: DataFrame) -> DataFrame:
    """Source products that lead to different SKUs."""
    return (resolved.where("SKU_Oficial is not null").groupBy("FuenteOrigen", "producto_id")
            .agg(F.count_distinct("SKU_Oficial").alias("skus")).where("skus > 1"))


def check_sales(landed: DataFrame, customers: DataFrame, lookup: DataFrame, channels: DataFrame,
                cal: DataFrame) -> DataFrame:
    """Cleaned lines with all keys, the day's rate and the array of broken rules.

    Customers and products are joined on (source, natural key). ``lookup`` is ``product_lookup``:
    codes and names were resolved there once per product, so lines meet one table only. The
    calendar has one row per day. The two small tables come last, so lines do not carry their columns when they are
    dealt out by customer and by product.
    """
    rows = clean_lines(landed).drop("TiempoID")
    who = customers.select("FuenteOrigen", "ClienteID_Natural", "ClienteID")
    rows = rows.join(who, ["FuenteOrigen", "ClienteID_Natural"], "left")
    rows = rows.join(lookup, ["FuenteOrigen", "producto_id"], "left")
    rate = cal.select(F.col("DateValue").alias("Fecha"), "TipoCambio_USD_CRC")
    rows = rows.join(rate, "Fecha", "left").withColumn("TiempoID", date_key("Fecha"))
    rows = rows.join(channels.select("NombreCanal", "CanalID"), "NombreCanal", "left")
    return with_errors(rows, _sales_rules())


def fact_ventas(checked: DataFrame) -> DataFrame:
    """Accepted lines in USD; the total is rounded once, from the unrounded amount."""
    good = checked.where(F.size("errors") == 0)
    net = net_cents("Precio", "Cantidad", "DescuentoPct")
    return good.select(
        "TiempoID", "ClienteID", "ProductoID", "CanalID", "OrdenID_Natural", "MonedaOrigen",
        cents_to_usd(net, "MonedaOrigen", "TipoCambio_USD_CRC").alias("TotalVentaUSD"), "Cantidad",
        to_usd("Precio", "MonedaOrigen", "TipoCambio_USD_CRC").alias("PrecioUnitUSD"),
        "DescuentoPct", "FuenteOrigen")


def run_unified_dw(customers: DataFrame, products: DataFrame, lines: DataFrame, cal: DataFrame,
                   out: str, run_ts: Column | None = None) -> dict[str, DataFrame]:
    """Landed customers, products and lines to the written warehouse; running it again replaces it.

    Calendar, dimensions, bridge and lookup are written before the lines are read, and the checked lines
    once before the fact and the rejects are taken from them.
    """
    # stored, its size is known: a calendar that is still a plan would have all lines dealt out by day
    cal = write_table(cal, f"{out}/staging/Calendario")
    bounds = cal.agg(F.min("DateValue").alias("start"), F.max("DateValue").alias("end"))
    times = write_table(time_dimension(bounds, run_ts), f"{out}/DimTiempo")
    products, bad_products = check_products(products)
    _, bad_customers = clean_customers(customers)
    refused = write_table(bad_products.withColumn("tabla", F.lit("DimProducto")).unionByName(
        bad_customers.withColumn("tabla", F.lit("DimCliente"))), f"{out}/staging/RechazosDimensiones")
    who = write_table(dim_cliente(customers, run_ts), f"{out}/DimCliente")
    what = write_table(dim_producto(products, run_ts), f"{out}/DimProducto")
    channels = write_table(dim_canal(lines, run_ts=run_ts), f"{out}/DimCanal")
    resolved = write_table(resolve_products(products, what), f"{out}/staging/ProductosResueltos")
    bridge = write_table(map_producto(product_bridge(resolved), run_ts), f"{out}/MapProducto")
    conflicts = write_table(sku_conflicts(stated_pairs(products)), f"{out}/staging/CodigosContradictorios")
    twofold = write_table(product_conflicts(resolved), f"{out}/staging/ProductosContradictorios")
    disputed = write_table(customer_conflicts(customers), f"{out}/staging/ClientesContradictorios")
    lookup = write_table(product_lookup(resolved, what), f"{out}/staging/ProductoLookup")
    checked = write_table(check_sales(lines, who, lookup, channels, cal), f"{out}/staging/LineasRevisadas")
    now = F.current_timestamp() if run_ts is None else run_ts
    fact = fact_ventas(checked).withColumns({
        "Anio": F.floor(F.col("TiempoID") / 10000).cast("int"),
        "Mes": F.floor(F.col("TiempoID") / 100 % 100).cast("int")}).hint(
            "rebalance", "Anio", "Mes").sortWithinPartitions("Anio", "Mes", "ClienteID")
    fact = fact.select((F.monotonically_increasing_id() + 1).alias("VentaID"), *fact.columns,
                       now.alias("FechaCreacion"))
    fact.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("Anio", "Mes").parquet(f"{out}/FactVentas")
    rejects = checked.where(F.size("errors") > 0).select(
        "FuenteOrigen", "OrdenID_Natural", "ClienteID_Natural", "producto_id", "errors")
    return {"DimTiempo": times, "DimCliente": who, "DimProducto": what, "DimCanal": channels,
            "MapProducto": bridge, "rechazos_dimensiones": refused, "conflictos": conflicts,
            "conflictos_productos": twofold, "conflictos_clientes": disputed, "rechazos": write_table(rejects, f"{out}/staging/Rechazos"),
            "FactVentas": fact.sparkSession.read.parquet(f"{out}/FactVentas")}


def load_targets(raw: DataFrame, customers: DataFrame, products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed monthly targets with known customer and product, and the refused rows."""
    typed = raw.select(F.col("ClienteID").try_cast("bigint").alias("ClienteID"),
                       F.col("ProductoID").try_cast("bigint").alias("ProductoID"),
                       F.col("Anio").try_cast("int").alias("Anio"),
                       F.col("Mes").try_cast("int").alias("Mes"),
                       exact_text(blank_to_null("MetaUSD"), 18, 2).alias("MetaUSD"))
    customer = customers.select("ClienteID", F.lit(True).alias("_customer")).distinct()
    product = products.select("ProductoID", F.lit(True).alias("_product")).distinct()
    names = ["ClienteID", "ProductoID", "Anio", "Mes", "MetaUSD"]
    missing = F.lit(False)
    for c in names:
        missing = missing | F.col(c).isNull()
    # the first reason that holds; every raw row is read once and is in one of the two results
    judged = typed.join(customer, "ClienteID", "left").join(product, "ProductoID", "left").select(
        *names, F.when(missing, "missing or unreadable field").when(~F.col("Mes").between(1, 12), "month must be 1..12")
        .when(F.col("_customer").isNull(), "customer not found")
        .when(F.col("_product").isNull(), "product not found").alias("motivo"))
    return judged.where("motivo is null").select(*names), judged.where("motivo is not null")


def metas_ventas(good: DataFrame) -> DataFrame:
    """Accepted targets with their key; a repeated target keeps a key of its own."""
    return assign_keys(good, ["ClienteID", "ProductoID", "Anio", "Mes"], "MetaID", tie=["MetaUSD"])
