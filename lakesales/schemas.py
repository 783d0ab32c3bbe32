"""Table shapes and fixed value lists."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: names, codes and limits that stored data must match ---------------------
FALLBACK_CARD_CODE = "AGG000"
FALLBACK_CARD_NAME = "AGGREGATED_CLIENT"
CURRENCIES = [("COL", "Colones"), ("USD", "Dólares")]
LOCAL_CURRENCY = "COL"
USD = "USD"
CRC = "CRC"
CARD_TYPES = ["C", "S"]
GENDERS = ["Masculino", "Femenino", "No Especificado"]
SOURCES = ["SQL Server", "MySQL", "MongoDB", "Supabase", "Neo4j"]
CHANNELS = ["WEB", "TIENDA", "APP"]
MONEDAS = ["USD", "CRC"]
MAX_PAGE = 100
CHUNK_ROWS = 500
MSSQL_LOADER = ["ClienteEmail", "ClienteNombre", "SKU", "CodigoAlt", "Fecha", "Canal", "Moneda",
                "Qty", "PrecioUnit", "DescuentoPct", "MetadataJSON"]
MYSQL_LOADER = ["cliente_email", "producto_codigo_alt", "fecha", "canal", "moneda", "total",
                "precio_unit", "cantidad", "metadata"]
# form field to store column
FORM_FIELDS = {
    ("SQL Server", "cliente"): {"nombre": "Nombre", "email": "Email", "genero": "Genero", "pais": "Pais"},
    ("SQL Server", "producto"): {"nombre": "Nombre", "categoria": "Categoria", "codigo": "SKU"},
    ("MySQL", "cliente"): {"nombre": "nombre", "email": "correo", "genero": "genero", "pais": "pais"},
    ("MySQL", "producto"): {"nombre": "nombre", "categoria": "categoria", "codigo": "codigo_alt"},
    ("MongoDB", "producto"): {"nombre": "nombre", "codigo": "codigo", "categoria": "categoria",
                              "categoriasAdicionales": "equivalencias"},
}
MONTHS_ES = ["enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto",
             "septiembre", "octubre", "noviembre", "diciembre"]
WEEKDAYS_ES = ["domingo", "lunes", "martes", "miércoles", "jueves", "viernes", "sábado"]

# --- ERP tables ---------------------------------------------------------------------------
_DOC = ("DocEntry bigint, CardCode string, DocDate timestamp_ntz, DocDueDate timestamp_ntz, "
        "DocCur string, DocTotal decimal(18,4), DocTotalFC decimal(18,4)")
_LINE = ("DocEntry bigint, LineNum int, ItemCode string, Quantity decimal(18,4), "
         "Price decimal(18,4)")
ERP = {
    "OINV": _DOC,
    "ORIN": _DOC,
    "INV1": _LINE,
    "RIN1": _LINE,
    "OCRD": "CardCode string, CardName string, CardType string, U_Zona string, Country string",
    "ZONAS": "Code string",
    "OITM": "ItemCode string, ItemName string, u_mARCA string, OnHand decimal(18,4)",
    "OITW": "ItemCode string, WhsCode string, AvgPrice decimal(18,4)",
}
RATES = "Fecha timestamp_ntz, TipoCambio_USD_CRC decimal(18,6)"
VENTAS = "array<struct<item:string,cantidad:decimal(18,4),precio:decimal(18,4)>>"
AGG_SALES = f"anio int, mes int, ventas {VENTAS}"

# --- operational sources, one entry per (source, table) -------------------------------------
SOURCE_TABLES = {
    ("SQL Server", "cliente"): "ClienteId int, Nombre string, Email string, Genero string, "
                               "Pais string, FechaRegistro date",
    ("SQL Server", "producto"): "ProductoId int, SKU string, Nombre string, Categoria string",
    ("SQL Server", "orden"): "OrdenId int, ClienteId int, Fecha timestamp_ntz, Canal string, "
                             "Moneda string, Total decimal(18,2)",
    ("SQL Server", "detalle"): "OrdenDetalleId int, OrdenId int, ProductoId int, Cantidad int, "
                               "PrecioUnit decimal(18,2), DescuentoPct decimal(5,2)",
    ("MySQL", "cliente"): "id int, nombre string, correo string, genero string, pais string, "
                          "created_at string",
    ("MySQL", "producto"): "id int, codigo_alt string, nombre string, categoria string",
    ("MySQL", "orden"): "id int, cliente_id int, fecha string, canal string, moneda string, "
                        "total string",
    ("MySQL", "detalle"): "id int, orden_id int, producto_id int, cantidad int, "
                          "precio_unit string",
    ("Supabase", "cliente"): "cliente_id string, nombre string, email string, genero string, "
                             "pais string, fecha_registro date",
    ("Supabase", "producto"): "producto_id string, sku string, nombre string, categoria string",
    ("Supabase", "orden"): "orden_id string, cliente_id string, fecha timestamp, canal string, "
                           "moneda string, total decimal(18,2)",
    ("Supabase", "detalle"): "orden_detalle_id string, orden_id string, producto_id string, "
                             "cantidad int, precio_unit decimal(18,2)",
}

# --- documents ------------------------------------------------------------------------------
# numbers keep their decimals: a fractional quantity has to be seen to be refused
ITEM = ("struct<producto_id:string,cantidad:decimal(14,4),precio_unit:decimal(20,6),"
        "descuento_pct:decimal(9,4)>")
DOCUMENTS = {
    "clientes": "_id string, nombre string, email string, genero string, pais string, "
                "preferencias map<string,string>, creado timestamp, actualizado timestamp",
    "productos": "_id string, codigo string, codigo_mongo string, nombre string, "
                 "categoria string, equivalencias struct<sku:string,codigo_alt:string>, "
                 "creado timestamp, actualizado timestamp",
    "ordenes": "_id string, cliente_id string, fecha string, canal string, moneda string, "
               f"total decimal(18,2), total_usd double, items array<{ITEM}>, "
               "descripcion string, metadatos string, creado timestamp, actualizado timestamp",
}
GRAPH_ORDER = (
    "cliente struct<id:string,nombre:string,email:string>, "
    "orden struct<id:string,fecha:string,canal:string,moneda:string,total:decimal(18,2)>, "
    "items array<struct<producto:struct<id:string,nombre:string,categoria:string>,"
    "cantidad:int,precio_unit:decimal(18,2)>>"
)

# --- the common shape the five sources are landed in, texts still uncleaned ------------------
LANDED_CUSTOMERS = ["FuenteOrigen", "ClienteID_Natural", "nombre", "email", "genero", "pais",
                    "fecha_registro"]
LANDED_PRODUCTS = ["FuenteOrigen", "producto_id", "CodigoFuente", "sku", "codigo_alt",
                   "codigo_mongo", "nombre", "categoria"]
LANDED_LINES = ["FuenteOrigen", "OrdenID_Natural", "ClienteID_Natural", "producto_id", "fecha",
                "canal", "moneda", "cantidad", "precio_unit", "descuento_pct"]


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
