"""Table constraints of the sources, the upload forms and the warehouse, checked as rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesales.operators import validation as V
from lakesales.schemas import CHANNELS, GENDERS, MONEDAS, SOURCES
from lakesales.session import scratch_path
from lakesales.sources.sinks import write_table


@dataclass(frozen=True)
class Field:
    required: bool = False
    longest: int | None = None
    shortest: int = 0
    values: Sequence[str] | None = None
    above: float | None = None
    low: float | None = None
    high: float | None = None
    email: bool = False


@dataclass(frozen=True)
class Table:
    key: str
    fields: Mapping[str, Field]
    unique: Sequence[Sequence[str]] = ()
    # column: (referenced table, referenced column)
    foreign: Mapping[str, tuple[str, str]] = field(default_factory=dict)


def _must(**kw) -> Field:
    return Field(required=True, **kw)


# --- fixed values: the constraints as declared ------------------------------------------------
_PERCENT = Field(low=0, high=100)
TABLES = {
    ("SQL Server", "cliente"): Table("ClienteId", {
        "Nombre": _must(longest=120), "Email": Field(longest=150),
        "Genero": Field(longest=12, values=["Masculino", "Femenino"]), "Pais": _must(longest=60),
        "FechaRegistro": _must()}, unique=[["ClienteId"], ["Email"]]),
    ("SQL Server", "producto"): Table("ProductoId", {
        "SKU": _must(longest=40), "Nombre": _must(longest=150), "Categoria": _must(longest=80)},
        unique=[["ProductoId"], ["SKU"]]),
    ("SQL Server", "orden"): Table("OrdenId", {
        "ClienteId": _must(), "Fecha": _must(), "Canal": _must(longest=20, values=CHANNELS),
        "Moneda": _must(longest=3), "Total": _must()}, unique=[["OrdenId"]],
        foreign={"ClienteId": ("cliente", "ClienteId")}),
    ("SQL Server", "detalle"): Table("OrdenDetalleId", {
        "OrdenId": _must(), "ProductoId": _must(), "Cantidad": _must(above=0), "PrecioUnit": _must()},
        unique=[["OrdenDetalleId"]],
        foreign={"OrdenId": ("orden", "OrdenId"), "ProductoId": ("producto", "ProductoId")}),
    ("MySQL", "cliente"): Table("id", {
        "nombre": _must(longest=120), "correo": Field(longest=150), "genero": Field(values=["M", "F", "X"]),
        "pais": _must(longest=60), "created_at": _must(longest=10)}, unique=[["id"]]),
    ("MySQL", "producto"): Table("id", {
        "codigo_alt": _must(longest=64), "nombre": _must(longest=150), "categoria": _must(longest=80)},
        unique=[["id"], ["codigo_alt"]]),
    ("MySQL", "orden"): Table("id", {
        "cliente_id": _must(), "fecha": _must(longest=19), "canal": _must(longest=20),
        "moneda": _must(longest=3), "total": _must(longest=20)}, unique=[["id"]],
        foreign={"cliente_id": ("cliente", "id")}),
    ("MySQL", "detalle"): Table("id", {
        "orden_id": _must(), "producto_id": _must(), "cantidad": _must(), "precio_unit": _must(longest=20)},
        unique=[["id"]], foreign={"orden_id": ("orden", "id"), "producto_id": ("producto", "id")}),
    ("Supabase", "cliente"): Table("cliente_id", {
        "nombre": _must(), "genero": _must(values=["M", "F"]), "pais": _must(), "fecha_registro": _must()},
        unique=[["cliente_id"], ["email"]]),
    ("Supabase", "producto"): Table("producto_id", {"nombre": _must(), "categoria": _must()},
                                    unique=[["producto_id"], ["sku"]]),
    ("Supabase", "orden"): Table("orden_id", {
        "cliente_id": _must(), "fecha": _must(), "canal": _must(values=["WEB", "APP", "PARTNER"]),
        "moneda": _must(longest=3), "total": _must()}, unique=[["orden_id"]],
        foreign={"cliente_id": ("cliente", "cliente_id")}),
    ("Supabase", "detalle"): Table("orden_detalle_id", {
        "orden_id": _must(), "producto_id": _must(), "cantidad": _must(above=0), "precio_unit": _must()},
        unique=[["orden_detalle_id"]],
        foreign={"orden_id": ("orden", "orden_id"), "producto_id": ("producto", "producto_id")}),
    ("MongoDB", "clientes"): Table("_id", {
        "nombre": _must(), "pais": _must(), "genero": _must(values=["Masculino", "Femenino", "Otro"]),
        "creado": _must()}, unique=[["_id"]]),
    ("MongoDB", "productos"): Table("_id", {
        "codigo_mongo": _must(), "nombre": _must(), "categoria": _must()}, unique=[["_id"]]),
    ("Neo4j", "cliente"): Table("id", {"id": _must()}, unique=[["id"]]),
    ("Neo4j", "producto"): Table("id", {"id": _must()}, unique=[["id"]]),
    ("form", "cliente"): Table("_row", {
        "nombre": _must(shortest=1, longest=100), "email": _must(email=True),
        "genero": _must(shortest=1, longest=2**31 - 1),
        "pais": _must(values=["CR", "GT", "SV", "HN", "NI", "PA", "BZ", "US"])}),
    ("form", "producto"): Table("_row", {
        "nombre": _must(shortest=1, longest=2**31 - 1), "categoria": _must(shortest=1, longest=2**31 - 1),
        "codigo": _must(shortest=1, longest=2**31 - 1)}),
    ("warehouse", "DimCliente"): Table("ClienteID", {
        "ClienteID_Natural": _must(longest=100), "Nombre": _must(longest=120), "Email": Field(longest=150),
        "Genero": _must(longest=15, values=GENDERS), "Pais": _must(longest=60), "FechaRegistro": _must(),
        "FuenteOrigen": _must(longest=20, values=SOURCES)}, unique=[["ClienteID"]]),
    ("warehouse", "DimProducto"): Table("ProductoID", {
        "SKU_Oficial": _must(longest=40), "Nombre": _must(longest=150), "Categoria": _must(longest=80),
        "FuenteOrigen": _must(longest=20)}, unique=[["ProductoID"], ["SKU_Oficial"]]),
    ("warehouse", "DimTiempo"): Table("TiempoID", {
        "FechaCompleta": _must(), "Dia": _must(low=1, high=31), "Mes": _must(low=1, high=12),
        "Trimestre": _must(low=1, high=4), "Anio": _must(), "NombreMes": _must(longest=20),
        "NombreDiaSemana": _must(longest=20), "DiaSemana": _must(low=1, high=7), "EsFinDeSemana": _must(),
        "MesAnio": _must(longest=7)}, unique=[["TiempoID"], ["FechaCompleta"]]),
    ("warehouse", "DimCanal"): Table("CanalID", {"NombreCanal": _must(longest=20)},
                                     unique=[["CanalID"], ["NombreCanal"]]),
    ("warehouse", "FactVentas"): Table("VentaID", {
        "TiempoID": _must(), "ClienteID": _must(), "ProductoID": _must(), "CanalID": _must(),
        "OrdenID_Natural": _must(longest=100), "MonedaOrigen": _must(values=MONEDAS), "TotalVentaUSD": _must(),
        "Cantidad": _must(above=0), "PrecioUnitUSD": _must(), "DescuentoPct": _PERCENT,
        "FuenteOrigen": _must(longest=20)}, unique=[["VentaID"]],
        foreign={"TiempoID": ("DimTiempo", "TiempoID"), "ClienteID": ("DimCliente", "ClienteID"),
                 "ProductoID": ("DimProducto", "ProductoID"), "CanalID": ("DimCanal", "CanalID")}),
    ("warehouse", "MapProducto"): Table("CodigoFuente", {
        "FuenteOrigen": _must(longest=20), "CodigoFuente": _must(longest=100), "SKU_Oficial": _must(longest=40)},
        unique=[["FuenteOrigen", "CodigoFuente"]], foreign={"SKU_Oficial": ("DimProducto", "SKU_Oficial")}),
    ("warehouse", "MetasVentas"): Table("MetaID", {
        "ClienteID": _must(), "ProductoID": _must(), "Anio": _must(), "Mes": _must(), "MetaUSD": _must()},
        unique=[["MetaID"]],
        foreign={"ClienteID": ("DimCliente", "ClienteID"), "ProductoID": ("DimProducto", "ProductoID")}),
}


def row_rules(table: Table) -> list[V.Rule]:
    rules = []
    for name, f in table.fields.items():
        if f.required:
            rules.append(V.required(name))
        if f.longest is not None or f.shortest:
            rules.append(V.max_length(name, f.longest, f.shortest))
        if f.values is not None:
            rules.append(V.one_of(name, f.values))
        if f.above is not None or f.low is not None or f.high is not None:
            rules.append(V.in_range(name, f.low, f.high, f.above))
        if f.email:
            rules.append(V.email_format(name))
    return rules


def check_table(df: DataFrame, system: str, name: str,
                refs: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Everything in one table that breaks its constraints, see ``check_tables``; foreign keys are checked against the
    tables given in ``refs``."""
    return check_tables({name: df}, system, refs).drop("tabla")


def _key_text(df: DataFrame, columns: Sequence[str]) -> Column:
    """The key as text, NULL where a part is: equal for equal values of different number types."""
    def part(c: str) -> Column:
        if isinstance(df.schema[c].dataType, (T.DecimalType, T.DoubleType, T.FloatType)):
            return F.regexp_replace(F.col(c).cast("decimal(38,10)").cast("string"), r"\.?0+$", "")
        return F.col(c).cast("string")

    parts = [part(c) for c in columns]
    if len(parts) == 1:
        return parts[0]
    given = F.lit(True)
    for c in parts:
        given = given & c.isNotNull()
    return F.when(given, F.to_json(F.array(*parts)))


def _entry(kind: str, con: str, key: Column, row: Column, field: str = "", message: str | Column = "",
           rule: str | Column = "") -> Column:
    texts = {"row": row, "field": field, "rule": rule, "message": message}
    return F.struct(F.lit(kind).alias("kind"), F.lit(con).alias("con"), key.alias("key"), *[
        (v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in texts.items()])


def _entries(name: str, df: DataFrame, table: Table, refs: Mapping[str, str], wanted: Mapping[str, str]) -> DataFrame:
    """What one pass over a table has to say: broken row rules (e), its keys (k) and the keys it refers to (f)."""
    none = F.lit(None).cast("string")
    row = F.col(table.key).cast("string")
    keys = {",".join(columns): columns for columns in table.unique} | {c: [c] for c in wanted}
    entries = [F.when(key.isNotNull(), _entry("k", f"{name}.{con}", key, none)) for con, key in (
        (con, _key_text(df, columns)) for con, columns in keys.items())]
    for column, con in refs.items():
        key = _key_text(df, [column])
        target = table.foreign[column][0]
        entries.append(F.when(key.isNotNull(), _entry("f", con, key, row, column, f"not in {target}", "reference")))
    broken = F.transform("_errors", lambda e: F.struct(
        F.lit("e").alias("kind"), none.alias("con"), none.alias("key"), row.alias("row"), e["field"].alias("field"),
        e["rule"].alias("rule"), e["message"].alias("message")))
    flagged = V.with_errors(df, row_rules(table), "_errors")
    said = F.concat(F.filter(F.array(*entries), lambda e: e.isNotNull()), broken) if entries else broken
    return flagged.select(F.lit(name).alias("tabla"), F.explode(said).alias("_e")).select("tabla", "_e.*")


def check_tables(frames: Mapping[str, DataFrame], system: str,
                 refs: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Everything in the tables of one system that breaks their constraints: (tabla, row, field, rule, message).

    Every table is read once: each row gives its broken row rules, its unique keys and the keys it refers to, and these
    are written to the shared folder. One grouping by (constraint, key), combined before the shuffle, then tells which
    keys occur more than once and which are referred to but not there. A repeated unique key is reported once, with
    the key as ``row``; a key with a NULL part is exempt. A foreign key is checked against the table of that name in
    ``refs``, else in ``frames``, and not at all where neither has it. A table in ``refs`` gives its keys only.
    """
    refs = {name: df for name, df in (refs or {}).items() if df is not frames.get(name)}
    parts, given = [], set()
    wanted: dict[str, dict[str, str]] = {name: {} for name in frames}
    used: dict[str, dict[str, str]] = {name: {} for name in frames}
    for name in frames:
        for column, (target, key) in TABLES[system, name].foreign.items():
            if target in refs:
                used[name][column] = f"{target}:{key}"
                if (target, key) not in given:
                    given.add((target, key))
                    text = _key_text(refs[target], [key])
                    known = _entry("k", f"{target}:{key}", text, F.lit(None).cast("string"))
                    parts.append(refs[target].where(F.col(key).isNotNull()).select(
                        F.lit(target).alias("tabla"), known.alias("_e")).select("tabla", "_e.*"))
            elif target in frames:
                used[name][column] = f"{target}.{key}"
                wanted[target][key] = key
    parts += [_entries(name, df, TABLES[system, name], used[name], wanted[name]) for name, df in frames.items()]
    spark = parts[0].sparkSession
    said = write_table(reduce(DataFrame.unionByName, parts), scratch_path(spark, "constraints"))
    kind = F.col("kind")
    keys = said.where(kind != "e").groupBy("con", "key").agg(
        F.count_if(kind == "k").alias("_there"), F.count_if(kind == "f").alias("_used"))
    keys = write_table(keys.where((F.col("_there") > 1) | (F.col("_there") == 0)), scratch_path(spark, "keys"))
    unique = spark.createDataFrame([(f"{name}.{','.join(columns)}", name, ",".join(columns), len(columns) > 1)
                                    for name in frames for columns in TABLES[system, name].unique],
                                   "con string, tabla string, field string, _many boolean")
    text = F.when(F.col("_many"), F.array_join(F.from_json("key", "array<string>"), "|")).otherwise(F.col("key"))
    twice = keys.where("_there > 1").join(F.broadcast(unique), "con").select(
        "tabla", text.alias("row"), "field", F.lit("unique").alias("rule"),
        F.concat(F.lit("occurs "), F.col("_there").cast("string"), F.lit(" times")).alias("message"))
    columns = ["tabla", "row", "field", "rule", "message"]
    lost = said.where(kind == "f").join(keys.where("_there = 0"), ["con", "key"], "left_semi").select(*columns)
    return said.where(kind == "e").select(*columns).unionByName(twice).unionByName(lost)
