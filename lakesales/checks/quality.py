"""Queries of validation rules, loaders, readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lakesales.checks import shapes as S
from lakesales.checks.shapes import Tables
from lakesales.functions.nested import agg_sales_rows, explode_items
from lakesales.operators import aggregates as A
from lakesales.operators import joins as J
from lakesales.operators import validation as V
from lakesales.operators.locale import detect_locales, read_amounts
from lakesales.plans import erp_warehouse as P
from lakesales.plans import loader as L
from lakesales.plans.constraints import check_table, check_tables
from lakesales.schemas import SOURCE_TABLES
from lakesales.sources import landing, readers, sinks
from lakesales.session import scratch_path
from lakesales.streaming.ingest import ingest_files


def _order_rules():
    return [V.one_of("o_orderstatus", ["F", "O"]), V.in_range("o_totalprice", low=1000, high=400000),
            V.required("o_orderpriority", non_blank=True), V.max_length("o_orderpriority", 10, 1)]


def validate_orders(spark, d):
    _, rejects = V.validate(Tables(spark, d).orders, _order_rules(), "o_orderkey")
    return rejects


def validate_accepted(spark, d):
    good, _ = V.validate(Tables(spark, d).orders, _order_rules(), "o_orderkey")
    return good.select("o_orderkey", "o_orderstatus", "o_totalprice")


def validate_lines(spark, d):
    rules = [V.in_range("l_quantity", above=1, high=48), V.in_range("l_discount", low=0.01, high=0.09),
             V.one_of("l_returnflag", ["A", "N"]), V.required("l_shipdate")]
    _, rejects = V.validate(Tables(spark, d).lineitem, rules, "l_orderkey")
    return rejects


def error_summary(spark, d):
    _, rejects = V.validate(Tables(spark, d).orders, _order_rules(), "o_orderkey")
    return A.error_summary(rejects)


def email_check(spark, d):
    """Addresses built with and without their parts."""
    address = (F.when(F.col("c_acctbal") < 0, F.concat("c_name", F.lit(" @x.com")))
               .when(F.col("c_mktsegment") == "BUILDING", F.concat("c_name", F.lit("@localhost")))
               .when(F.col("c_mktsegment") == "FURNITURE", F.lit(None).cast("string"))
               .otherwise(F.concat("c_name", F.lit("@example.com"))))
    rows = Tables(spark, d).customer.withColumn("email", address)
    _, rejects = V.validate(rows, [V.email_format("email"), V.required("email")], "c_custkey")
    return rejects.select("row", "rule")


def duplicates(spark, d):
    return V.duplicates(Tables(spark, d).lineitem, ["l_orderkey", "l_linenumber"])


def orphans(spark, d):
    t = Tables(spark, d)
    return J.orphans(t.orders, t.lineitem, "o_orderkey", "l_orderkey").select("o_orderkey", "o_custkey")


def total_mismatch(spark, d):
    t = Tables(spark, d)
    lines = t.lineitem.withColumn("pct", (F.col("l_discount").cast("decimal(5,2)") * 100).cast("decimal(5,2)"))
    out = V.total_mismatch(t.orders.withColumnRenamed("o_orderkey", "l_orderkey"), lines, "l_orderkey",
                           "o_totalprice", "l_extendedprice", "l_quantity", "pct")
    return out.select("l_orderkey", *S.double("total_guardado", "total_lineas"))


def validate_documents(spark, d):
    """Order documents: empty ones, missing fields and discounts out of range."""
    t = Tables(spark, d)
    docs = S.order_heads(t).withColumn("fecha", F.when(F.col("canal").isNotNull(), F.col("fecha")))
    _, rejects = V.validate_orders(docs, S.order_items(t, 2000), "_id")
    return rejects.select("row", "field", "rule")


def _relational(t: Tables) -> dict[str, DataFrame]:
    clients = t.customer.where("c_nationkey < 20").select(
        F.col("c_custkey").alias("ClienteId"), F.col("c_name").alias("Nombre"),
        F.concat("c_mktsegment", F.round("c_acctbal").cast("int").cast("string")).alias("Email"),
        S.raw_gender().alias("Genero"), F.when(F.col("c_acctbal") > 0, "CR").alias("Pais"), S.registered().alias("FechaRegistro"))
    orders = t.orders.select(F.col("o_orderkey").alias("OrdenId"), F.col("o_custkey").alias("ClienteId"),
                             F.col("o_orderdate").alias("Fecha"), F.upper(F.trim(S.raw_channel())).alias("Canal"),
                             F.lit("USD").alias("Moneda"), F.col("o_totalprice").alias("Total"))
    lines = t.lineitem.select(F.col("l_linenumber").alias("OrdenDetalleId"), F.col("l_orderkey").alias("OrdenId"),
                              F.col("l_partkey").alias("ProductoId"), (F.col("l_quantity") - 1).alias("Cantidad"),
                              F.col("l_extendedprice").alias("PrecioUnit"))
    return {"cliente": clients, "orden": orders, "detalle": lines}


def table_constraints(spark, d):
    """Customers, orders and lines as one relational source, checked table by table."""
    frames = _relational(Tables(spark, d))
    refs = {"cliente": frames["cliente"], "orden": frames["orden"].where("Canal <> 'PARTNER'")}
    parts = [check_table(df, "SQL Server", name, refs).select(F.lit(name).alias("tabla"), "field", "rule")
             for name, df in frames.items()]
    rejects = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rejects.groupBy("tabla", "field", "rule").agg(F.count("*").alias("casos"))


def system_constraints(spark, d):
    """The same tables checked together, each read once: foreign keys meet the very tables."""
    return check_tables(_relational(Tables(spark, d)), "SQL Server").groupBy("tabla", "field", "rule").agg(
        F.count("*").alias("casos"))


def lost_keys(spark, d):
    """Orders whose customer is missing, one line each."""
    frames = _relational(Tables(spark, d))
    broken = check_tables({n: frames[n] for n in ("cliente", "orden")}, "SQL Server")
    return broken.where("rule = 'reference'").select("tabla", "row", "field")


# --- loader -----------------------------------------------------------------------------------
def upload_rows(t: Tables) -> DataFrame:
    """Every line as an upload row, with each kind of mistake somewhere in the data."""
    n, tax, none = F.col("l_linenumber"), F.round("l_tax", 2), F.lit(None).cast("string")
    head = t.orders.select("o_orderkey", "o_custkey")
    lines = t.lines.join(head, F.col("l_orderkey") == F.col("o_orderkey"))
    email = F.concat(F.lit("C"), F.col("o_custkey").cast("string"), F.lit("@Example.com"))
    return lines.select(
        email.alias("cliente email"), none.alias("ClienteNombre"),
        F.when(F.col("l_linestatus") == "O", S.code("sku-", "l_partkey")).alias("sku"),
        S.code("ALT-", "l_partkey").alias("Codigo_Alt"),
        F.when(n == 7, F.lit("2025-13-40")).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("Fecha (ISO)"),
        F.when(n == 6, "FAX").otherwise(F.lit(" web ")).alias("CANAL"),
        F.when(tax == 0.08, "EUR").otherwise("usd").alias("Moneda"),
        F.when(F.col("l_quantity") == 50, "0").otherwise(F.col("l_quantity").cast("int").cast("string")).alias("Qty"),
        F.when((n == 5) & (F.col("l_returnflag") == "R"), "-5").otherwise(
            F.format_number("l_extendedprice", 2)).alias("precio"),
        F.when(tax == 0.07, "101").otherwise(F.round(F.col("l_discount") * 100).cast("int").cast("string")).alias("DescuentoPct"),
        F.when((n == 4) & (tax == 0.01), '{"k":').otherwise(F.lit('{"k": "a, b"}')).alias("MetadataJSON"))


MAPPING = {"precio": "PrecioUnit", "cliente email": "ClienteEmail"}


def loader_lookups(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    customers = t.customer.where("c_acctbal >= 0").select(
        F.col("c_custkey").alias("ClienteID"),
        F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias("email"))
    sku = S.code("SKU-", "p_partkey").alias("SKU_Oficial")
    dim = t.part.where("p_type <> 'PROMO'").select(sku)
    bridge = t.part.where("p_type not in ('PROMO', 'SMALL')").select(
        F.lit("MySQL").alias("FuenteOrigen"), S.code("ALT-", "p_partkey").alias("CodigoFuente"), sku)
    return customers, bridge, dim


def _uploaded(spark: SparkSession, t: Tables) -> DataFrame:
    path = scratch_path(spark, "upload")
    sinks.write_rejects(upload_rows(t), path)
    return readers.read_loader_csv(spark, path)


def _checked(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return L.check_rows(_uploaded(spark, t), "mssql", *loader_lookups(t), mapping=MAPPING)


def loader_dry_run(spark, d):
    """All lines as CSV files, read back and checked: errors per field and rule."""
    report = L.dry_run(_checked(spark, d))
    return report.groupBy("field", "rule").agg(F.count("*").alias("errores"))


def import_summary(spark, d):
    """An import of all lines that skips bad rows, and one that takes all or nothing."""
    t = Tables(spark, d)
    checked = L.check_rows(_uploaded(spark, t), "mssql", *loader_lookups(t), mapping=MAPPING)
    done = L.run_import(checked, "mssql", "skip_bad", scratch_path(spark, "import"))
    strict = L.accepted_rows(done["checked"], "all_or_nothing").agg(F.count("*").alias("n")).scalar()
    return done["log"].agg(F.sum("inserted").alias("insertadas"), F.sum("rejected").alias("rechazadas")).select(
        "insertadas", "rechazadas", strict.alias("todo_o_nada"))


def loader_accepted(spark, d):
    return L.accepted_rows(_checked(spark, d), "skip_bad").select(
        "ClienteID", "SKU_Oficial", F.date_format("Fecha", "yyyy-MM-dd").alias("Fecha"), "Canal", "Moneda",
        F.col("Cantidad").cast("bigint").alias("Cantidad"), *S.double("PrecioUnit", "DescuentoPct"))


def loader_mysql(spark, d):
    """The other loader's layout: text amounts, free channel, two currencies."""
    t = Tables(spark, d)
    raw = t.lines.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    money = F.translate(F.format_number("l_extendedprice", 2), ",.", ".,")
    path = scratch_path(spark, "upload-mysql")
    sinks.write_rejects(raw.select(
        F.concat(F.lit("c"), "o_custkey", F.lit("@example.com")).alias("cliente_email"),
        S.code("ALT-", "l_partkey").alias("producto_codigo_alt"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("fecha"), F.lit("tienda norte").alias("canal"),
        F.when(F.col("l_linestatus") == "O", "CRC").otherwise("USD").alias("moneda"),
        F.when(F.col("l_linenumber") == 7, "mil").otherwise(money).alias("total"), money.alias("precio_unit"),
        F.when(F.col("l_linenumber") == 6, "1.5").otherwise(F.col("l_quantity").cast("int").cast("string")).alias("cantidad"),
        F.lit("").alias("metadata")), path)
    checked = L.check_rows(readers.read_loader_csv(spark, path), "mysql", *loader_lookups(t), locale="es")
    mark = F.array(F.struct(F.lit("").alias("field"), F.lit("accepted").alias("rule"), F.lit("").alias("message")))
    marked = checked.withColumn("errors", F.when(F.size("errors") == 0, mark).otherwise(F.col("errors")))
    return L.dry_run(marked).groupBy("field", "rule").agg(F.count("*").alias("errores"))


def _amount_files(t: Tables) -> DataFrame:
    """Line amounts as upload files: English ones, Spanish ones, a folder of both, and one where nothing tells.

    Every fifth line of an order is a round thousand, which both write alike and read differently.
    """
    n, path = F.col("l_linenumber"), scratch_path(t.spark, "amounts")
    folder = (F.when(F.col("l_returnflag") == "A", "en").when(F.col("l_returnflag") == "R", "es")
              .when(F.col("l_linestatus") == "O", "mixed").otherwise("none"))
    round_sum = F.ceil(F.col("l_extendedprice") / 1000) * 1000
    english = F.when(n == 5, F.format_number(round_sum.cast("decimal(18,2)"), 0)).otherwise(
        F.format_number(F.col("l_extendedprice").cast("decimal(18,2)"), 2))
    spanish = F.translate(english, ",.", ".,")
    text = (F.when(folder == "en", english).when(folder == "es", spanish)
            .when(folder == "mixed", F.when(n % 2 == 1, english).otherwise(F.concat(F.lit("₡ "), spanish)))
            .otherwise(F.translate(F.format_number(round_sum.cast("decimal(18,2)"), 0), ",", ".")))
    t.lines.select("l_orderkey", "l_partkey", "l_linenumber", text.alias("monto"), folder.alias("carpeta")).write.partitionBy(
        "carpeta").csv(path, header=True, quote='"', escape='"')
    rows = readers.read_loader_csv(t.spark, path)
    return rows.withColumn("lote", F.regexp_extract("_file", "carpeta=([a-z]+)", 1))


def amount_locales(spark, d):
    return detect_locales(_amount_files(Tables(spark, d)), ["monto"], ["lote"])


def amounts_by_locale(spark, d):
    read = read_amounts(_amount_files(Tables(spark, d)), {"monto": "valor"}, ["lote"])
    return read.select(*[F.col(c).cast("bigint").alias(c) for c in ("l_orderkey", "l_partkey", "l_linenumber")], "lote",
                       F.col("valor_locale").alias("locale"), F.col("valor").cast("double").alias("valor"))


def loader_detects(spark, d):
    """Upload files with Spanish amounts, read without being told so."""
    t, path = Tables(spark, d), scratch_path(spark, "upload-es")
    rows = upload_rows(t).withColumn("precio", F.translate("precio", ",.", ".,"))
    sinks.write_rejects(rows, path)
    checked = L.check_rows(readers.read_loader_csv(spark, path), "mssql", *loader_lookups(t), mapping=MAPPING, locale=L.DETECT)
    return L.dry_run(checked).groupBy("field", "rule").agg(F.count("*").alias("errores"))


def row_numbers(spark, d):
    """Row numbers of a CSV file set: 1..n in every file, checked by count, least and greatest."""
    raw = _uploaded(spark, Tables(spark, d))
    per_file = raw.groupBy("_file").agg(F.count("*").alias("n"), F.min("_row").alias("lo"), F.max("_row").alias("hi"),
                                        F.count_distinct("_row").alias("k"))
    return per_file.agg(F.sum("n").alias("filas"), F.count_if((F.col("lo") != 1) | (F.col("hi") != F.col("n"))
                                                               | (F.col("k") != F.col("n"))).alias("archivos_malos"))


def multiline_rows(spark, d):
    """Upload rows whose names hold quotes, commas and line breaks, read in splits: what came back, by row number."""
    path = scratch_path(spark, "upload-lines")
    name = F.concat(F.lit('Ana "'), "l_orderkey", F.lit('",\n\n  '), "l_linenumber", F.when(F.col("l_linenumber") > 3, '"').otherwise("\nfin"))
    t = Tables(spark, d)
    rows = t.lines.select("l_partkey", name.alias("nombre"), F.when(F.col("l_linenumber") == 2, 'say 5" pipe').alias("nota"))
    sinks.write_rejects(rows, path)
    back = t.store(readers.read_loader_csv(spark, path, multiline=True), "multiline")
    files = back.groupBy("_file").agg(F.max("_row").alias("hi"), F.count_distinct("_row").alias("k"))
    bad = files.agg(F.count_if(F.col("hi") != F.col("k")).alias("n")).scalar()
    return back.select(F.col("l_partkey").cast("bigint").alias("l_partkey"), "nombre", "nota", bad.alias("archivos_malos"))


def ingest(spark, d):
    """All lines as upload files taken in by the stream: what was loaded, refused and logged."""
    t = Tables(spark, d)
    base = scratch_path(spark, "ingest")
    rows = upload_rows(t)
    sinks.write_rejects(rows, f"{base}/in")
    lookups = loader_lookups(t)
    query = ingest_files(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint", rows.columns,
                         lambda raw: L.check_rows(raw, "mssql", *lookups, mapping=MAPPING), files_per_batch=4)
    query.awaitTermination()
    read = spark.read.parquet
    loaded = read(f"{base}/out/accepted").agg(F.count("*").alias("insertadas"))
    refused = read(f"{base}/out/rejected").agg(F.count("*").alias("n")).scalar()
    logged = read(f"{base}/out/log").agg(F.sum(F.col("inserted") + F.col("rejected")).alias("n")).scalar()
    return loaded.select("insertadas", refused.alias("rechazadas"), logged.alias("registradas"))


def ingest_bad_files(spark, d):
    """Upload files with another order of columns, one without any known column and an empty one."""
    t, base = Tables(spark, d), scratch_path(spark, "ingest-bad")
    rows = upload_rows(t)
    odd = F.col("Fecha (ISO)").like("%-1_")
    sinks.write_rejects(rows.where(~odd), f"{base}/in/a")
    turned = rows.where(odd).select(*reversed(rows.columns))
    sinks.write_rejects(turned, f"{base}/in/b")
    t.region.select(F.col("r_name").alias("foo"), F.col("r_regionkey").alias("bar")).coalesce(1).write.csv(f"{base}/in/c", header=True)
    lookups = loader_lookups(t)
    query = ingest_files(spark, f"{base}/in/*/*.csv", f"{base}/out", f"{base}/checkpoint", rows.columns,
                         lambda raw: L.check_rows(raw, "mssql", *lookups, mapping=MAPPING))
    query.awaitTermination()
    read = spark.read.parquet
    count = F.count("*").alias("n")
    return read(f"{base}/out/accepted").agg(F.count("*").alias("insertadas")).select(
        "insertadas", read(f"{base}/out/rejected").agg(count).scalar().alias("rechazadas"),
        read(f"{base}/out/refused").agg(count).scalar().alias("archivos"))


def import_strict(spark, d):
    """All or nothing: good rows alone come in whole, one bad row among them keeps all out."""
    t = Tables(spark, d)
    checked = L.check_rows(_uploaded(spark, t), "mssql", *loader_lookups(t), mapping=MAPPING)
    # failed rows are counted, not listed: their uploaded texts need not be stored
    checked = t.store(checked.select(*L.TARGET, "errors"), "checked")
    good = checked.where(F.size("errors") == 0)
    one_bad = good.unionByName(checked.where(F.size("errors") > 0).orderBy("_file", "_row").limit(1))
    count = F.count("*").alias("n")
    return L.accepted_rows(good, "all_or_nothing").agg(F.count("*").alias("buenas")).select(
        "buenas", L.accepted_rows(one_bad, "all_or_nothing").agg(count).scalar().alias("con_una_mala"))


def loader_mongo_code(spark, d):
    """Upload rows whose product only the document store's code tells."""
    t = Tables(spark, d)
    bridge = t.part.where("p_size > 10").select(F.lit("MongoDB").alias("FuenteOrigen"), S.code("MN-", "p_partkey").alias(
        "CodigoFuente"), S.code("SKU-", "p_partkey").alias("SKU_Oficial"))
    customers, _, dim = loader_lookups(t)
    coded = upload_rows(t).withColumns({
        "codigo mongo": F.replace("Codigo_Alt", F.lit("ALT-"), F.lit("mn-")), "sku": F.concat(F.lit("no-"), "Codigo_Alt"),
        "Codigo_Alt": F.concat(F.lit("no-"), "Codigo_Alt")})
    checked = L.check_rows(coded, "mssql", customers, bridge, dim, mapping=MAPPING)
    return checked.groupBy("resolved_by").agg(F.count("*").alias("filas"))


# --- readers and writers ----------------------------------------------------------------------
def scan_json_agg(spark, d):
    """Monthly records written as JSON and read with the declared schema."""
    path = scratch_path(spark, "agg")
    S.agg_sales(Tables(spark, d)).write.json(path)
    return agg_sales_rows(readers.read_agg_sales(spark, path, json_lines=True)).select(
        F.col("anio").cast("bigint").alias("anio"), F.col("mes").cast("bigint").alias("mes"), "item",
        *S.double("cantidad", "precio", "TotalUSD"))


def _array_files(t: Tables, path: str) -> None:
    """The monthly records of each year as one JSON array in a file of its own, a record a line."""
    year = W.partitionBy("y").orderBy("mes", "texto")
    rows = S.agg_sales(t).select(F.col("anio").alias("y"), "mes", F.to_json(F.struct("anio", "mes", "ventas")).alias("texto"))
    first, last = F.lag("texto").over(year).isNull(), F.lead("texto").over(year).isNull()
    rows.select("y", F.concat(F.when(first, "[").otherwise(","), "texto", F.when(last, "]").otherwise(""))
                .alias("value")).write.partitionBy("y").text(path)


def scan_json_array(spark, d):
    """Monthly records as JSON arrays, read in splits."""
    path = scratch_path(spark, "agg-array")
    _array_files(Tables(spark, d), path)
    return agg_sales_rows(readers.read_agg_sales(spark, path, json_lines=False)).select(
        F.col("anio").cast("bigint").alias("anio"), F.col("mes").cast("bigint").alias("mes"), "item",
        *S.double("cantidad", "precio", "TotalUSD"))


def scan_erp(spark, d):
    t, base = Tables(spark, d), scratch_path(spark, "erp")
    S.erp_headers(t).write.parquet(f"{base}/OINV")
    S.erp_lines(t, False).write.parquet(f"{base}/INV1")
    joined = J.join_lines(readers.read_erp(spark, base, "INV1"), readers.read_erp(spark, base, "OINV"))
    return joined.groupBy("CardCode").agg(F.count("*").alias("lineas"),
                                          F.sum("DocTotal").cast("double").alias("total"))


def scan_rates(spark, d):
    path = scratch_path(spark, "rates")
    S.rates(Tables(spark, d)).select(
        F.date_format("Fecha", "yyyy-MM-dd HH:mm:ss").alias("Fecha"), "TipoCambio_USD_CRC").write.csv(path, header=True)
    return readers.read_rates(spark, path).select(F.col("Fecha").cast("string").alias("Fecha"),
                                                  *S.double("TipoCambio_USD_CRC"))


def scan_documents(spark, d):
    path = scratch_path(spark, "ordenes")
    S.order_documents(Tables(spark, d)).drop("parte", "primera").write.json(path)
    docs = readers.read_documents(spark, path, "ordenes")
    rows = explode_items(docs.select("_id", "moneda", "items"))
    return rows.select("_id", "moneda", "producto_id", F.col("cantidad").cast("bigint").alias("cantidad"),
                       *S.double("precio_unit"))


def scan_graph(spark, d):
    path = scratch_path(spark, "grafo")
    S.graph_orders(Tables(spark, d)).write.json(path)
    rows = landing.land_lines("Neo4j", readers.read_graph_orders(spark, path))
    return rows.select("OrdenID_Natural", "ClienteID_Natural", "producto_id", "fecha", "cantidad",
                       F.col("precio_unit").cast("double").alias("precio_unit"))


def scan_sources(spark, d):
    """Three relational sources written in their own layouts, read back and landed as one."""
    t, base = Tables(spark, d), scratch_path(spark, "fuentes")
    price, text = F.col("l_extendedprice").cast("decimal(18,2)"), F.format_number("l_extendedprice", 2)
    day = F.col("o_orderdate")
    shapes = {
        ("SQL Server", "orden"): t.orders.select(
            F.col("o_orderkey").alias("OrdenId"), F.col("o_custkey").alias("ClienteId"), day.alias("Fecha"),
            F.lit("WEB").alias("Canal"), F.lit("USD").alias("Moneda"), F.col("o_totalprice").alias("Total")),
        ("SQL Server", "detalle"): t.lineitem.where("l_returnflag = 'A'").select(
            F.col("l_linenumber").alias("OrdenDetalleId"), F.col("l_orderkey").alias("OrdenId"),
            F.col("l_partkey").alias("ProductoId"), F.col("l_quantity").alias("Cantidad"),
            price.alias("PrecioUnit"), (F.col("l_discount") * 100).alias("DescuentoPct")),
        ("MySQL", "orden"): t.orders.select(
            F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("cliente_id"), day.alias("fecha"),
            F.lit(" web ").alias("canal"), F.lit("CRC").alias("moneda"), F.col("o_totalprice").alias("total")),
        ("MySQL", "detalle"): t.lineitem.where("l_returnflag = 'N'").select(
            F.col("l_linenumber").alias("id"), F.col("l_orderkey").alias("orden_id"),
            F.col("l_partkey").alias("producto_id"), F.col("l_quantity").alias("cantidad"), text.alias("precio_unit")),
        ("Supabase", "orden"): t.orders.select(
            S.code("o-", "o_orderkey").alias("orden_id"), S.code("c-", "o_custkey").alias("cliente_id"),
            day.alias("fecha"), F.lit("PARTNER").alias("canal"), F.lit("USD").alias("moneda"),
            F.col("o_totalprice").alias("total")),
        ("Supabase", "detalle"): t.lineitem.where("l_returnflag = 'R'").select(
            S.code("d-", "l_linenumber").alias("orden_detalle_id"), S.code("o-", "l_orderkey").alias("orden_id"),
            S.code("p-", "l_partkey").alias("producto_id"), F.col("l_quantity").alias("cantidad"),
            price.alias("precio_unit")),
    }
    for (source, table), df in shapes.items():
        schema = spark.createDataFrame([], SOURCE_TABLES[source, table]).schema
        typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
        typed.write.parquet(f"{base}/{source}/{table}")
    landed = landing.unify([landing.land_lines(
        s, readers.read_source(spark, s, "orden", f"{base}/{s}/orden"),
        readers.read_source(spark, s, "detalle", f"{base}/{s}/detalle")) for s in ("SQL Server", "MySQL", "Supabase")])
    return landed.select("FuenteOrigen", "OrdenID_Natural", "ClienteID_Natural", "producto_id", "canal",
                         "cantidad", "precio_unit")


def read_any(spark, d):
    """The same table as CSV, JSON and Parquet, told apart by extension."""
    base, part = scratch_path(spark, "any"), Tables(spark, d).part.select("p_partkey", "p_name")
    part.write.csv(f"{base}/part.CSV", header=True)
    part.write.json(f"{base}/part.json")
    part.write.parquet(f"{base}/part.parquet")
    frames = [readers.read_any(spark, f"{base}/part.{e}", "p_partkey bigint, p_name string").withColumn(
        "formato", F.lit(e.lower())) for e in ("CSV", "json", "parquet")]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def write_roundtrip(spark, d):
    """All lines written as a partitioned table, staged under a name and read with SQL."""
    t, path = Tables(spark, d), scratch_path(spark, "lineas")
    lines = t.lineitem.withColumns({"anio": F.year("l_shipdate"), "mes": F.month("l_shipdate")})
    stored = sinks.write_table(lines, path, partition_by=["anio", "mes"])
    view = "lakesales_lineas"
    sinks.stage(stored, view)
    return spark.sql(f"""SELECT cast(anio AS bigint) AS anio, cast(mes AS bigint) AS mes, count(*) AS lineas,
        cast(sum(cast(l_extendedprice AS decimal(18,2))) AS double) AS total FROM {view} GROUP BY anio, mes""")


def sales_dw(spark, d):
    """The whole warehouse written and read back, checked through its stored fact."""
    t, out = Tables(spark, d), scratch_path(spark, "dw")
    tables = P.run_sales_dw(spark, S.erp_tables(t), S.rates(t), S.agg_sales(t), S.order_bounds(t), out)
    fact = tables["Fact_Sales"]
    return fact.groupBy("Year").agg(
        F.count("*").alias("filas"), F.count_distinct("SalesKey").alias("claves"),
        F.sum("DocTotal_USD").cast("double").alias("usd")).select(
        F.col("Year").cast("bigint").alias("anio"), "filas", "claves", "usd")


QUERIES = {
    "validate_rejects": validate_orders, "validate_accepted": validate_accepted, "validate_lines": validate_lines,
    "error_summary": error_summary, "email_check": email_check, "duplicates": duplicates, "orphans": orphans,
    "total_mismatch": total_mismatch, "validate_documents": validate_documents,
    "table_constraints": table_constraints, "system_constraints": system_constraints, "lost_keys": lost_keys, "loader_dry_run": loader_dry_run, "import_summary": import_summary, "loader_accepted": loader_accepted,
    "ingest_bad_files": ingest_bad_files, "import_strict": import_strict, "loader_mongo_code": loader_mongo_code,
    "amount_locales": amount_locales, "amounts_by_locale": amounts_by_locale, "loader_detects": loader_detects,
    "multiline_rows": multiline_rows, "loader_mysql": loader_mysql, "row_numbers": row_numbers, "ingest_files": ingest,
    "scan_json_agg": scan_json_agg, "scan_json_array": scan_json_array, "scan_erp": scan_erp, "scan_rates": scan_rates,
    "scan_documents": scan_documents, "scan_graph": scan_graph, "scan_sources": scan_sources,
    "read_any": read_any, "write_roundtrip": write_roundtrip, "sales_dw": sales_dw,
}

_REJECTS = """r AS (
  SELECT o_orderkey AS row, 'o_orderstatus' AS field, 'one_of' AS rule, 'o_orderstatus must be one of F, O' AS message
    FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
  UNION ALL SELECT o_orderkey, 'o_totalprice', 'range', 'o_totalprice must be >= 1000 and <= 400000'
    FROM orders WHERE o_totalprice < 1000 OR o_totalprice > 400000
  UNION ALL SELECT o_orderkey, 'o_orderpriority', 'length', 'o_orderpriority must have 1 to 10 characters'
    FROM orders WHERE length(o_orderpriority) > 10)"""

# every upload row with what is wrong with it
_UP = """up AS (SELECT *, l_linestatus = 'O' AND p_type <> 'PROMO' OR p_type NOT IN ('PROMO', 'SMALL') AS known_part,
  c_acctbal >= 0 AS known_customer, l_linenumber = 7 AS bad_date, l_linenumber = 6 AS bad_channel,
  round(l_tax, 2) = 0.08 AS bad_currency, l_quantity = 50 AS bad_qty,
  l_linenumber = 5 AND l_returnflag = 'R' AS bad_price, round(l_tax, 2) = 0.07 AS bad_discount,
  l_linenumber = 4 AND round(l_tax, 2) = 0.01 AS bad_json
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey)"""
_AMOUNTS = """a AS (SELECT l_orderkey, l_partkey, l_linenumber AS n, l_extendedprice AS p,
  CASE WHEN l_returnflag = 'A' THEN 'en' WHEN l_returnflag = 'R' THEN 'es' WHEN l_linestatus = 'O' THEN 'mixed'
    ELSE 'none' END AS lote FROM lineitem)"""
_BAD = """(NOT known_part OR NOT known_customer OR bad_date OR bad_channel OR bad_currency OR bad_qty
  OR bad_price OR bad_discount OR bad_json)"""

SQL = {
    "validate_rejects": f"WITH {_REJECTS} SELECT * FROM r",
    "validate_accepted": f"""WITH {_REJECTS} SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
        WHERE o_orderkey NOT IN (SELECT row FROM r)""",
    "validate_lines": """SELECT l_orderkey AS row, 'l_quantity' AS field, 'range' AS rule,
        'l_quantity must be > 1 and <= 48' AS message FROM lineitem WHERE l_quantity <= 1 OR l_quantity > 48
        UNION ALL SELECT l_orderkey, 'l_discount', 'range', 'l_discount must be >= 0.01 and <= 0.09'
        FROM lineitem WHERE l_discount < 0.01 OR l_discount > 0.09
        UNION ALL SELECT l_orderkey, 'l_returnflag', 'one_of', 'l_returnflag must be one of A, N'
        FROM lineitem WHERE l_returnflag NOT IN ('A', 'N')""",
    "error_summary": f"""WITH {_REJECTS} SELECT *, (SELECT count(*) FROM r) AS errores,
        greatest((SELECT count(*) FROM r) - 10, 0) AS mas FROM r ORDER BY row, field, rule LIMIT 10""",
    "email_check": """SELECT c_custkey AS row, 'email' AS rule FROM customer
        WHERE c_acctbal < 0 OR c_mktsegment = 'BUILDING'
        UNION ALL SELECT c_custkey, 'required' FROM customer WHERE c_acctbal >= 0 AND c_mktsegment = 'FURNITURE'""",
    "duplicates": """SELECT l_orderkey, l_linenumber, count(*) AS veces FROM lineitem GROUP BY 1, 2
        HAVING count(*) > 1""",
    "orphans": """SELECT o_orderkey, o_custkey FROM orders
        WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
    "total_mismatch": """SELECT * FROM (SELECT o_orderkey AS l_orderkey, o_totalprice AS total_guardado,
        coalesce(t, 0) AS total_lineas FROM orders LEFT JOIN (SELECT l_orderkey,
        CAST((2 * sum(CAST(round(l_extendedprice * 100) AS HUGEINT) * CAST(l_quantity AS HUGEINT)
          * (100 - CAST(round(l_discount * 100) AS HUGEINT))) + 100) // 200 AS DOUBLE) / 100 AS t
        FROM lineitem GROUP BY 1) s ON s.l_orderkey = o_orderkey) WHERE total_guardado <> total_lineas""",
    "validate_documents": """WITH d AS (SELECT o_orderkey, substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 24) AS row,
        o_orderstatus, count(l_orderkey) AS n, max(round(l_discount * 100) * 20) AS worst
        FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2, 3)
        SELECT row, 'items' AS field, 'items' AS rule FROM d WHERE n = 0
        UNION ALL SELECT row, 'items', 'item_discount' FROM d WHERE worst > 100
        UNION ALL SELECT row, 'fecha', 'required' FROM d WHERE o_orderstatus = 'P'""",
    "table_constraints": """WITH c AS (SELECT *, c_mktsegment || CAST(round_even(c_acctbal, 0) AS INTEGER) AS mail
          FROM customer WHERE c_nationkey < 20)
        SELECT * FROM (
        SELECT 'cliente' AS tabla, 'Genero' AS field, 'one_of' AS rule, count(*) AS casos FROM c
          WHERE c_nationkey < 8 OR c_nationkey >= 11
        UNION ALL SELECT 'cliente', 'Pais', 'required', count(*) FROM c WHERE c_acctbal <= 0
        UNION ALL SELECT 'cliente', 'Email', 'unique', count(*) FROM (SELECT mail FROM c GROUP BY 1 HAVING count(*) > 1)
        UNION ALL SELECT 'orden', 'Canal', 'one_of', count(*) FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED'
        UNION ALL SELECT 'orden', 'ClienteId', 'reference', count(*) FROM orders
          WHERE o_custkey NOT IN (SELECT c_custkey FROM c)
        UNION ALL SELECT 'detalle', 'Cantidad', 'range', count(*) FROM lineitem WHERE l_quantity <= 1
        UNION ALL SELECT 'detalle', 'OrdenDetalleId', 'unique', count(*) FROM (
          SELECT l_linenumber FROM lineitem GROUP BY 1 HAVING count(*) > 1)
        UNION ALL SELECT 'detalle', 'OrdenId', 'reference', count(*) FROM lineitem WHERE l_orderkey NOT IN (
          SELECT o_orderkey FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED')) WHERE casos > 0""",
    "loader_dry_run": f"""WITH {_UP} SELECT field, rule, count(*) AS errores FROM (
        SELECT 'CodigoAlt' AS field, 'reference' AS rule FROM up WHERE NOT known_part
        UNION ALL SELECT 'ClienteEmail', 'reference' FROM up WHERE NOT known_customer
        UNION ALL SELECT 'Fecha', 'format' FROM up WHERE bad_date
        UNION ALL SELECT 'Canal', 'one_of' FROM up WHERE bad_channel
        UNION ALL SELECT 'Moneda', 'one_of' FROM up WHERE bad_currency
        UNION ALL SELECT 'Qty', 'range' FROM up WHERE bad_qty
        UNION ALL SELECT 'PrecioUnit', 'range' FROM up WHERE bad_price
        UNION ALL SELECT 'DescuentoPct', 'range' FROM up WHERE bad_discount
        UNION ALL SELECT 'MetadataJSON', 'json' FROM up WHERE bad_json) GROUP BY 1, 2""",
    "import_summary": f"""WITH {_UP} SELECT count(*) FILTER (NOT {_BAD}) AS insertadas,
        count(*) FILTER ({_BAD}) AS rechazadas, 0 AS todo_o_nada FROM up""",
    "loader_accepted": f"""WITH {_UP} SELECT o_custkey AS ClienteID, 'SKU-' || l_partkey AS SKU_Oficial,
        strftime(l_shipdate, '%Y-%m-%d') AS Fecha, 'WEB' AS Canal, 'USD' AS Moneda,
        CAST(l_quantity AS BIGINT) AS Cantidad, l_extendedprice AS PrecioUnit,
        CAST(round(l_discount * 100) AS DOUBLE) AS DescuentoPct FROM up WHERE NOT {_BAD}""",
    "amount_locales": f"""WITH {_AMOUNTS} SELECT lote, 'monto' AS columna,
        count(*) FILTER (lote = 'en' AND n <> 5 OR lote = 'mixed' AND n IN (1, 3, 7)) AS en,
        count(*) FILTER (lote = 'es' AND n <> 5 OR lote = 'mixed' AND n IN (2, 4, 6)) AS es, 0 AS iguales,
        count(*) FILTER (lote = 'none' OR n = 5) AS ambiguos, 0 AS ilegibles,
        CASE lote WHEN 'none' THEN 'unknown' ELSE lote END AS locale FROM a GROUP BY lote""",
    "amounts_by_locale": f"""WITH {_AMOUNTS} SELECT l_orderkey, l_partkey, n AS l_linenumber, lote,
        CASE lote WHEN 'none' THEN 'unknown' ELSE lote END AS locale,
        CASE WHEN lote = 'none' OR (n = 5 AND lote = 'mixed') THEN NULL WHEN n = 5 THEN ceil(p / 1000) * 1000 ELSE p END AS valor
        FROM a""",
    "loader_mysql": """WITH up AS (SELECT *, p_type NOT IN ('PROMO', 'SMALL') AS known_part, c_acctbal >= 0 AS known_customer
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN part ON l_partkey = p_partkey)
        SELECT field, rule, count(*) AS errores FROM (
        SELECT 'producto_codigo_alt' AS field, 'reference' AS rule FROM up WHERE NOT known_part
        UNION ALL SELECT 'cliente_email', 'reference' FROM up WHERE NOT known_customer
        UNION ALL SELECT 'total', 'format' FROM up WHERE l_linenumber = 7
        UNION ALL SELECT 'cantidad', 'format' FROM up WHERE l_linenumber = 6
        UNION ALL SELECT '', 'accepted' FROM up WHERE known_part AND known_customer AND l_linenumber < 6) GROUP BY 1, 2""",
    "multiline_rows": """SELECT l_partkey, 'Ana "' || l_orderkey || '",' || chr(10) || chr(10) || '  ' || l_linenumber
        || CASE WHEN l_linenumber > 3 THEN '"' ELSE chr(10) || 'fin' END AS nombre,
        CASE l_linenumber WHEN 2 THEN 'say 5" pipe' END AS nota, 0 AS archivos_malos FROM lineitem""",
    "row_numbers": "SELECT count(*) AS filas, 0 AS archivos_malos FROM lineitem",
    "ingest_bad_files": f"""WITH {_UP} SELECT count(*) FILTER (NOT {_BAD}) AS insertadas,
        count(*) FILTER ({_BAD}) AS rechazadas, 1 AS archivos FROM up""",
    "import_strict": f"""WITH {_UP} SELECT count(*) FILTER (NOT {_BAD}) AS buenas, 0 AS con_una_mala FROM up""",
    "loader_mongo_code": """SELECT CASE WHEN p_size > 10 THEN 'codigo_mongo' END AS resolved_by, count(*) AS filas
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
    "ingest_files": f"""WITH {_UP} SELECT count(*) FILTER (NOT {_BAD}) AS insertadas,
        count(*) FILTER ({_BAD}) AS rechazadas, count(*) AS registradas FROM up""",
    "scan_json_agg": """SELECT year(m) AS anio, month(m) AS mes, 'P' || l_partkey AS item, q AS cantidad,
        p AS precio, CAST(CAST(q AS DECIMAL(12,0)) * CAST(p AS DECIMAL(9,2)) AS DOUBLE) AS TotalUSD FROM (
        SELECT date_trunc('month', l_shipdate) AS m, l_partkey, sum(l_quantity) AS q,
        max(l_extendedprice) AS p FROM lineitem GROUP BY 1, 2)""",
    "scan_erp": """SELECT 'C' || o_custkey AS CardCode, count(*) AS lineas,
        CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag <> 'R' GROUP BY 1""",
    "scan_rates": S.cte("rates") + """SELECT CAST(f AS VARCHAR) AS Fecha, CAST(rate AS DOUBLE) AS TipoCambio_USD_CRC
        FROM rates""",
    "scan_documents": """SELECT substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 24) AS _id,
        CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'USD' ELSE 'CRC' END AS moneda,
        'P' || l_partkey AS producto_id, CAST(l_quantity AS BIGINT) AS cantidad, l_extendedprice AS precio_unit
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "scan_graph": """SELECT 'O-' || o_orderkey AS OrdenID_Natural, 'C-' || o_custkey AS ClienteID_Natural,
        'P-' || l_partkey AS producto_id, strftime(o_orderdate, '%Y-%m-%d') AS fecha,
        CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS cantidad, l_extendedprice AS precio_unit
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "scan_sources": """SELECT CASE l_returnflag WHEN 'A' THEN 'SQL Server' WHEN 'N' THEN 'MySQL' ELSE 'Supabase' END
        AS FuenteOrigen, CASE l_returnflag WHEN 'R' THEN 'o-' ELSE '' END || o_orderkey AS OrdenID_Natural,
        CASE l_returnflag WHEN 'R' THEN 'c-' ELSE '' END || o_custkey AS ClienteID_Natural,
        CASE l_returnflag WHEN 'R' THEN 'p-' ELSE '' END || l_partkey AS producto_id,
        CASE l_returnflag WHEN 'A' THEN 'WEB' WHEN 'N' THEN ' web ' ELSE 'PARTNER' END AS canal,
        CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS cantidad,
        CASE l_returnflag WHEN 'N' THEN format('{:,.2f}', l_extendedprice)
          ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS precio_unit
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "read_any": """SELECT p_partkey, p_name, f AS formato FROM part,
        (SELECT unnest(['csv', 'json', 'parquet']) AS f)""",
    "write_roundtrip": """SELECT year(l_shipdate) AS anio, month(l_shipdate) AS mes, count(*) AS lineas,
        CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM lineitem GROUP BY 1, 2""",
    "sales_dw": S.cte(*S.ERP_ALL) + """SELECT DateKey // 10000 AS anio, count(*) AS filas, count(*) AS claves,
        CAST(sum(usd) AS DOUBLE) AS usd FROM fact GROUP BY 1""",
}
SQL["loader_detects"] = SQL["loader_dry_run"]
SQL["scan_json_array"] = SQL["scan_json_agg"]
SQL["system_constraints"] = SQL["table_constraints"].replace(" WHERE o_orderpriority <> '4-NOT SPECIFIED')) WHERE", ")) WHERE")
SQL["lost_keys"] = """SELECT 'orden' AS tabla, CAST(o_orderkey AS VARCHAR) AS row, 'ClienteId' AS field FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 20)"""
