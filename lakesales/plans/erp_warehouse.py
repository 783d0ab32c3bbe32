"""Worked star schema: invoices, credit notes and monthly sales of an ERP."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesales.functions.dates import (date_key, is_business_day, month_name, month_start,
                                       quarter_name)
from lakesales.functions.nested import agg_sales_rows
from lakesales.functions.text import norm_key
from lakesales.operators.aggregates import (fallback_audit, qa_totals, sales_by_customer,
                                            sales_by_product)
from lakesales.operators.joins import asof_backward, fallback_key, join_lines, orphans, star_lookup
from lakesales.operators.keys import assign_keys
from lakesales.operators.validation import duplicates
from lakesales.schemas import (CARD_TYPES, CURRENCIES, FALLBACK_CARD_CODE, FALLBACK_CARD_NAME,
                               LOCAL_CURRENCY, USD)
from lakesales.sources.readers import split_corrupt
from lakesales.sources.sinks import write_table

AMOUNT = "decimal(18,4)"
MAX_DAYS = 366 * 400


def date_bounds(spark: SparkSession, start: str | dt.date, end: str | dt.date) -> DataFrame:
    return spark.range(1).select(F.lit(str(start)).cast("date").alias("start"),
                                 F.lit(str(end)).cast("date").alias("end"))


def date_spine(bounds: DataFrame) -> DataFrame:
    """Every day of a one-row (start, end) relation; a span over 400 years is an error."""
    too_long = F.datediff("end", "start") > MAX_DAYS
    days = F.sequence("start", "end")
    checked = F.when(too_long, F.raise_error(F.lit("calendar span too long")).cast("array<date>"))
    return bounds.where("start <= end").select(F.explode(checked.otherwise(days)).alias("d"))


def calendar(bounds: DataFrame) -> DataFrame:
    d = F.col("d")
    return date_spine(bounds).select(
        date_key(d).alias("DateKey"), d.alias("DateValue"), F.year(d).alias("Year"),
        F.quarter(d).alias("Quarter"), F.month(d).alias("Month"), F.dayofmonth(d).alias("Day"),
        month_name(d).alias("MonthName"), quarter_name(d).alias("QuarterName"),
        is_business_day(d).alias("IsBusinessDay"), F.year(d).alias("FiscalYear"))


def attach_rates(cal: DataFrame, rates: DataFrame) -> DataFrame:
    """Rate of the very day; one rate per day, the greatest if a day is given twice, see ``rate_conflicts``."""
    daily = rates.groupBy(F.col("Fecha").alias("DateValue")).agg(
        F.max("TipoCambio_USD_CRC").alias("TipoCambio_USD_CRC"))
    return cal.join(daily, "DateValue", "left")


def rate_conflicts(rates: DataFrame) -> DataFrame:
    """Days that are given two or more different rates."""
    days = rates.where("Fecha is not null and TipoCambio_USD_CRC is not null").groupBy("Fecha").agg(
        F.count_distinct("TipoCambio_USD_CRC").alias("tasas"))
    return days.where("tasas > 1")


def calendar_fx(bounds: DataFrame, rates: DataFrame) -> DataFrame:
    """Calendar with the day's rate, gaps filled from the newest earlier rate row.

    The newest earlier row counts even if its rate is NULL, and days before the first rate stay
    NULL. Both sides have at most one row per day, so one time slice is enough.
    """
    cal = attach_rates(calendar(bounds), rates)
    earlier = rates.select(F.col("Fecha").alias("_f"), F.col("TipoCambio_USD_CRC").alias("_prior"))
    filled = asof_backward(cal, earlier, "DateValue", "_f", ["_prior"], slices=1)
    rate = F.coalesce("TipoCambio_USD_CRC", "_prior").alias("TipoCambio_USD_CRC")
    return filled.select(*[c for c in cal.columns if c != "TipoCambio_USD_CRC"], rate)


def dim_customer(ocrd: DataFrame, zonas: DataFrame) -> DataFrame:
    """Customers and suppliers with their zone; the catch-all member has key 1."""
    zones = zonas.select(F.col("Code").alias("Zone"))
    members = (ocrd.where(F.col("CardType").isin(CARD_TYPES))
               .join(zones, norm_key("U_Zona") == norm_key("Zone"), "left")
               .select("CardCode", "CardName", "CardType", "Zone", "Country").distinct())
    seed = ocrd.sparkSession.range(1).select(
        F.lit(1).cast("bigint").alias("CustomerKey"), F.lit(FALLBACK_CARD_CODE).alias("CardCode"),
        F.lit(FALLBACK_CARD_NAME).alias("CardName"), F.lit("C").alias("CardType"),
        F.lit(None).cast("string").alias("Zone"), F.lit(None).cast("string").alias("Country"))
    rest = [c for c in members.columns if c != "CardCode"]
    return seed.unionByName(assign_keys(members, ["CardCode"], "CustomerKey", start=2, tie=rest))


def dim_product(oitm: DataFrame, oitw: DataFrame, on_many: str = "error") -> DataFrame:
    """Items with their stock price.

    An item held by several warehouses at different prices would make two members of one code:
    ``error`` leaves them for ``duplicates`` to report, ``avg`` takes the mean price.
    """
    stock = oitw.select(F.col("ItemCode").alias("_item"), "AvgPrice")
    if on_many == "avg":
        stock = stock.groupBy("_item").agg(F.avg("AvgPrice").cast(AMOUNT).alias("AvgPrice"))
    elif on_many != "error":
        raise ValueError(f"unknown choice: {on_many}")
    rows = (oitm.join(stock, norm_key("ItemCode") == norm_key("_item"), "left")
            .select("ItemCode", "ItemName", F.col("u_mARCA").alias("Brand"), "OnHand", "AvgPrice")
            .distinct())
    return assign_keys(rows, ["ItemCode"], "ProductKey", tie=[c for c in rows.columns if c != "ItemCode"])


def dim_currency(spark: SparkSession) -> DataFrame:
    rows = [(i, code, text) for i, (code, text) in enumerate(CURRENCIES, 1)]
    return spark.createDataFrame(rows, "CurrencyKey int, CurrencyCode string, Description string")


def _with_product(rows: DataFrame, products: DataFrame | None, code: str) -> DataFrame:
    if products is None:
        return rows.withColumn("ProductKey", F.lit(None).cast("bigint"))
    return star_lookup(rows, products, F.col(code), "ItemCode", ["ProductKey"])


def _document_branch(headers: DataFrame, lines: DataFrame, customers: DataFrame,
                     products: DataFrame | None, currencies: DataFrame, sign: int,
                     grain: str) -> DataFrame:
    """Lines with their header's keys and totals. Reports that name no product pass none: ProductKey is NULL then.

    Customer and currency are looked up on headers, of which there are fewer than lines, before
    the two meet, and products on lines while these have no more than their own columns.
    """
    code = F.coalesce("DocCur", F.lit(LOCAL_CURRENCY))
    head = star_lookup(headers, customers, F.col("CardCode"), "CardCode", ["CustomerKey"])
    head = star_lookup(head, currencies, code, "CurrencyCode", ["CurrencyKey"])
    other = fallback_key(customers, "CardCode", FALLBACK_CARD_CODE, "CustomerKey")
    head = head.select("DocEntry", date_key("DocDate").alias("DateKey"),
                       F.coalesce("CustomerKey", other).alias("CustomerKey"), "CurrencyKey",
                       "DocTotal", "DocTotalFC", norm_key(code).alias("_cur"))
    rows = join_lines(_with_product(lines, products, "ItemCode"), head)
    crc, usd = F.col("DocTotal"), F.col("DocTotalFC")
    if grain == "line":
        share = (F.col("Quantity") * F.col("Price")).cast(AMOUNT)
        crc = F.when(F.col("_cur") == LOCAL_CURRENCY, share)
        usd = F.when(F.col("_cur") == USD, share)
    elif grain != "header":
        raise ValueError(f"unknown grain: {grain}")
    return rows.select("DateKey", "CustomerKey", "ProductKey", "CurrencyKey",
                       (F.col("Quantity") * sign).cast(AMOUNT).alias("Qty"),
                       F.col("Price").cast(AMOUNT).alias("UnitPrice"),
                       (crc * sign).cast(AMOUNT).alias("DocTotal_CRC"),
                       (usd * sign).cast(AMOUNT).alias("DocTotal_USD"))


def fact_invoices(oinv, inv1, customers, products, currencies, grain: str = "header") -> DataFrame:
    """Invoice lines. The header total stands on every line.

    ``grain="line"`` puts qty x price in the column of the document's currency instead, so that
    totals may be added up.
    """
    return _document_branch(oinv, inv1, customers, products, currencies, 1, grain)


def fact_credit_notes(orin, rin1, customers, products, currencies,
                      grain: str = "header") -> DataFrame:
    """Credit note lines: quantity and totals negative, price not."""
    return _document_branch(orin, rin1, customers, products, currencies, -1, grain)


def split_agg_sales(agg: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Monthly sales rows with their date, and the rows whose year and month make none."""
    rows = agg_sales_rows(agg).withColumn("DateValue", month_start("anio", "mes"))
    return rows.where("DateValue is not null"), rows.where("DateValue is null")


def fact_monthly(agg: DataFrame, customers: DataFrame, products: DataFrame | None, currencies: DataFrame,
                 cal: DataFrame) -> DataFrame:
    """Monthly USD sales on the first of the month for the catch-all customer.

    A month without a rate is converted at 1.
    """
    rows, _ = split_agg_sales(agg)
    rows = _with_product(rows, products, "item")
    daily = cal.select("DateValue", "TipoCambio_USD_CRC")
    rows = rows.join(daily, "DateValue", "left")
    rate = F.coalesce("TipoCambio_USD_CRC", F.lit(1).cast("decimal(18,6)"))
    return rows.select(
        date_key("DateValue").alias("DateKey"),
        fallback_key(customers, "CardCode", FALLBACK_CARD_CODE, "CustomerKey").alias("CustomerKey"),
        "ProductKey",
        fallback_key(currencies, "CurrencyCode", USD, "CurrencyKey").alias("CurrencyKey"),
        F.col("cantidad").cast(AMOUNT).alias("Qty"), F.col("precio").cast(AMOUNT).alias("UnitPrice"),
        (F.col("TotalUSD") * rate).cast(AMOUNT).alias("DocTotal_CRC"),
        F.col("TotalUSD").cast(AMOUNT).alias("DocTotal_USD"))


def build_fact_sales(*branches: DataFrame) -> DataFrame:
    fact = branches[0]
    for branch in branches[1:]:
        fact = fact.unionByName(branch)
    return fact


def write_fact(fact: DataFrame, path: str, run_ts: Column | None = None) -> DataFrame:
    """Writes the fact by year and month with a unique row id and the load time.

    The id is given in the writing stage, behind the last shuffle: a repeated task then replaces
    its own ids. It needs no shuffle of its own and leaves gaps.
    """
    now = F.current_timestamp() if run_ts is None else run_ts
    placed = fact.withColumns({
        "Year": F.floor(F.col("DateKey") / 10000).cast("int"),
        "Month": F.floor(F.col("DateKey") / 100 % 100).cast("int")})
    # sorted files let a reader skip row groups by customer, as an index on it would
    placed = placed.hint("rebalance", "Year", "Month").sortWithinPartitions(
        "Year", "Month", "CustomerKey")
    keyed = placed.select((F.monotonically_increasing_id() + 1).alias("SalesKey"),
                          *placed.columns, now.alias("InsertedAt"))
    keyed.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("Year", "Month").parquet(path)
    return fact.sparkSession.read.parquet(path)


def qa_pack(fact: DataFrame, customers: DataFrame, products: DataFrame) -> dict[str, DataFrame]:
    """Control queries over a loaded fact."""
    nulls = fact.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_null")
                       for c in ("DateKey", "CustomerKey", "ProductKey", "CurrencyKey")])
    return {
        "totals": qa_totals(fact),
        "by_customer": sales_by_customer(fact, customers),
        "by_product": sales_by_product(fact, products),
        "fallback": fallback_audit(fact, customers),
        "null_keys": nulls,
        "customer_orphans": orphans(fact, customers, "CustomerKey", "CustomerKey")
        .agg(F.count("*").alias("n")),
        "product_orphans": orphans(fact, products, "ProductKey", "ProductKey")
        .agg(F.count("*").alias("n")),
    }


def run_sales_dw(spark: SparkSession, erp: Mapping[str, DataFrame], rates: DataFrame,
                 agg: DataFrame, bounds: DataFrame, out: str,
                 grain: str = "header") -> dict[str, DataFrame]:
    """Builds and writes the whole warehouse; running it again replaces it.

    Dimensions are written first and read back, so the fact branches share one copy. The fact is
    partitioned by year and month. Lines of the rates file that cannot be read are written beside it.
    """
    rates, broken = split_corrupt(rates)
    unread = write_table(broken, f"{out}/staging/TasasIlegibles")
    cal = write_table(calendar_fx(bounds, rates), f"{out}/DimDate")
    customers = write_table(dim_customer(erp["OCRD"], erp["ZONAS"]), f"{out}/DimCustomer")
    products = write_table(dim_product(erp["OITM"], erp["OITW"]), f"{out}/DimProduct")
    currencies = write_table(dim_currency(spark), f"{out}/DimCurrency")
    twice = duplicates(products.select(norm_key("ItemCode").alias("ItemCode")), ["ItemCode"])
    if twice.take(1):
        raise ValueError("item codes with several stock prices, see dim_product(on_many='avg')")
    # codes are unique without regard to case, so two members of one code would count its sales twice
    if duplicates(customers.select(norm_key("CardCode").alias("CardCode")), ["CardCode"]).take(1):
        raise ValueError("customer codes with several members, see validation.code_conflicts")
    fact = build_fact_sales(
        fact_invoices(erp["OINV"], erp["INV1"], customers, products, currencies, grain),
        fact_credit_notes(erp["ORIN"], erp["RIN1"], customers, products, currencies, grain),
        fact_monthly(agg, customers, products, currencies, cal))
    stored = write_fact(fact, f"{out}/Fact_Sales")
    return {"DimDate": cal, "DimCustomer": customers, "DimProduct": products,
            "DimCurrency": currencies, "Fact_Sales": stored, "tasas_ilegibles": unread}
