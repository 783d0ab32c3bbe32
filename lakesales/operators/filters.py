"""Filters, search, paging and column mapping."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesales._cols import C, as_col, as_list
from lakesales.functions.nested import order_total, prefs_to_pairs
from lakesales.functions.text import is_object_id
from lakesales.schemas import FORM_FIELDS, MAX_PAGE


def filter_eq(df: DataFrame, col: str, value) -> DataFrame:
    """Exact, case-sensitive match."""
    return df.where(F.col(col) == F.lit(value))


def filter_in(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.where(F.col(col).isin(list(values)))


def filter_date_range(df: DataFrame, col: C, start, end) -> DataFrame:
    """Both ends count. A date without time means midnight, so the rest of the last day is out."""
    kind = df.select(as_col(col).alias("c")).schema["c"].dataType.simpleString()
    if kind == "string":
        raise TypeError("parse text dates first, see parse_date_text")
    return df.where(as_col(col).between(F.lit(start).cast(kind), F.lit(end).cast(kind)))


def search(df: DataFrame, query: str, cols: Sequence[str], literal: bool = False) -> DataFrame:
    """Case-insensitive regular expression (or literal text) in any of the columns."""
    pattern = "(?iu)" + (re.escape(query) if literal else query)
    hit = F.lit(False)
    for c in cols:
        hit = hit | F.coalesce(F.col(c).rlike(pattern), F.lit(False))
    return df.where(hit)


def lookup_ids(df: DataFrame, ids: DataFrame, key: str, valid=is_object_id) -> DataFrame:
    """Rows named by the ids; an id of the wrong format finds nothing."""
    wanted = ids.where(valid(F.col(key))).select(F.col(key).alias("_id_wanted"))
    return df.join(wanted, F.col(key) == F.col("_id_wanted"), "left_semi")


def check_page(page: int, limit: int) -> None:
    if page < 1 or not 1 <= limit <= MAX_PAGE:
        raise ValueError(f"page must be at least 1 and limit 1..{MAX_PAGE}")


def page_summary(df: DataFrame, page: int, limit: int) -> DataFrame:
    """One row: total, page, limit, pages."""
    check_page(page, limit)
    total = df.agg(F.count("*").alias("total"))
    pages = F.floor((F.col("total") + (limit - 1)) / limit).cast("bigint")
    return total.select("total", F.lit(page).alias("page"), F.lit(limit).alias("limit"),
                        pages.alias("pages"))


def paginate(df: DataFrame, page: int, limit: int, order_by) -> DataFrame:
    """Rows of one page in a stated order, with total, page, limit and pages beside them. Sorts all rows in front of
    the page; ``ranked.page_at`` does not.

    The order should end in a unique key, or page contents may change between runs.
    """
    check_page(page, limit)
    summary = page_summary(df, page, limit)
    rows = df.orderBy(*as_list(order_by)).offset((page - 1) * limit).limit(limit)
    return rows.select("*", summary.select("total").scalar().alias("total"),
                       F.lit(page).alias("page"), F.lit(limit).alias("limit"),
                       summary.select("pages").scalar().alias("pages"))


def page_after(df: DataFrame, order_by: str, last, limit: int, tie: str | None = None, last_tie=None) -> DataFrame:
    """Next page behind the row already seen: costs the same however deep the page is. The way to read on.

    ``tie`` is a unique key that parts rows of one ``order_by``; rows without a value in ``order_by`` come last.
    The first page has neither ``last`` nor ``last_tie``; a page that ended among rows without a value is
    continued with ``last=None`` and its ``last_tie``.
    """
    check_page(1, limit)
    value, key = F.col(order_by), F.col(tie or order_by)
    if last is not None:
        behind = value.isNull() | (value > F.lit(last))
        df = df.where(behind | ((value == F.lit(last)) & (key > F.lit(last_tie))) if tie else behind)
    elif last_tie is not None:
        df = df.where(value.isNull() & (key > F.lit(last_tie)))
    return df.orderBy(value.asc_nulls_last(), key.asc()).limit(limit)


def sort_columns(sort: str, tie: str) -> list[Column]:
    """``field,asc`` or ``field,desc`` to sort columns, the key breaking ties."""
    field, _, way = sort.partition(",")
    way = (way or "asc").strip().lower()
    if way not in ("asc", "desc"):
        raise ValueError(f"unknown sort direction: {way}")
    first = F.col(field.strip())
    return [first.desc() if way == "desc" else first.asc(), F.col(tie).asc()]


def list_view(df: DataFrame, key: str, q: str | None = None, q_cols: Sequence[str] = (),
              sort: str | None = None, page: int = 1, limit: int = 20) -> DataFrame:
    """Search, sort and page in one call."""
    found = search(df, q, q_cols) if q else df
    return paginate(found, page, limit, sort_columns(sort or f"{key},asc", key))


def preview(df: DataFrame, n: int = 10, order_by=None) -> DataFrame:
    return (df.orderBy(*as_list(order_by)) if order_by is not None else df).limit(n)


def rename_map(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def form_to_store(df: DataFrame, source: str, entity: str) -> DataFrame:
    """Form rows with the column names of the store; other columns are left out."""
    mapping = FORM_FIELDS[source, entity]
    return rename_map(df.select(*[c for c in df.columns if c in mapping]), mapping)


def _header_key(name: str) -> str:
    return re.sub(r"[^0-9a-z]", "", re.sub(r"\(.*?\)", "", name.lower()))


def header_key(c: C) -> Column:
    """``_header_key`` of a text column: names that differ in case, marks and bracketed remarks are one."""
    return F.regexp_replace(F.regexp_replace(F.lower(as_col(c)), r"\(.*?\)", ""), "[^0-9a-z]", "")


def map_headers(df: DataFrame, fields: Sequence[str],
                mapping: Mapping[str, str] | None = None) -> DataFrame:
    """File columns to target fields by the given mapping, else by name without case and marks.

    A field no column maps to is NULL, so the required-field rule reports its rows. Columns that
    map to nothing are dropped, leading-underscore bookkeeping columns stay.
    """
    given = dict(mapping or {})
    unknown = set(given.values()) - set(fields)
    if unknown:
        raise ValueError(f"unknown target fields: {sorted(unknown)}")
    by_name = {_header_key(f): f for f in fields}
    source: dict[str, str] = {}
    for column in df.columns:
        target = given.get(column) or by_name.get(_header_key(column))
        if target and (target not in source or column in given):
            source[target] = column
    keep = [F.col(f"`{c}`") for c in df.columns if c.startswith("_")]
    return df.select(*keep, *[
        F.col(f"`{source[f]}`").alias(f) if f in source else F.lit(None).cast("string").alias(f)
        for f in fields])


def to_response(df: DataFrame, entity: str, run_ts: Column | None = None) -> DataFrame:
    """Stored documents to the listing shape: text id, defaults, recomputed totals.

    Orders come with their items, from which the total is added up, or without: then ``total`` is what
    ``aggregates.line_totals`` found in the line rows (NULL there: no lines, 0). An order stored in several parts
    has to come the second way.
    """
    now = F.current_timestamp() if run_ts is None else run_ts
    ident = F.col("_id").cast("string").alias("id")

    def stamp(c: str) -> Column:
        return F.coalesce(F.col(c), now).alias(c)

    if entity == "ordenes":
        note = F.coalesce("descripcion", "metadatos") if "metadatos" in df.columns else F.col("descripcion")
        if "parte" in df.columns:
            raise ValueError("orders in parts: add up their lines and give one row an order")
        whole = "items" in df.columns
        total = order_total("items") if whole else F.coalesce("total", F.lit(0)).cast("decimal(18,2)")
        return df.select(ident, "cliente_id", "fecha", "canal", "moneda", *(["items"] if whole else []),
                         note.alias("descripcion"), total.alias("total"), stamp("creado"), stamp("actualizado"),
                         *(["lineas"] if "lineas" in df.columns else []))
    if entity == "productos":
        code = F.coalesce("codigo", "codigo_mongo", F.lit(""))
        same = F.struct(F.col("equivalencias.sku").alias("sku"),
                        F.col("equivalencias.codigo_alt").alias("codigo_alt"))
        return df.select(ident, code.alias("codigo_mongo"), "nombre", "categoria",
                         F.when(F.col("equivalencias").isNotNull(), same).alias("equivalencias"))
    if entity == "clientes":
        pairs = F.coalesce(prefs_to_pairs("preferencias"),
                           F.array().cast("array<struct<categoria:string,texto:string>>"))
        return df.select(ident, "nombre", "email", "genero", "pais", stamp("creado"),
                         pairs.alias("preferencias"))
    raise ValueError(f"unknown entity: {entity}")
