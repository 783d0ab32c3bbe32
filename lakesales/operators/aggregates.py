"""Totals, statistics, targets and baskets."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesales.functions.money import from_cents, net_cents, sum_of_all
from lakesales.session import scratch_path
from lakesales.sources.sinks import write_table


def qa_totals(fact: DataFrame) -> DataFrame:
    return fact.agg(F.sum("DocTotal_CRC").alias("Total_CRC"),
                    F.sum("DocTotal_USD").alias("Total_USD"), F.count("*").alias("Filas"))


def _by_dimension(fact: DataFrame, dim: DataFrame, key: str, names: list[str]) -> DataFrame:
    # add up per key before the lookup: the join then sees one row per member
    per_key = fact.groupBy(key).agg(F.sum("DocTotal_CRC").alias("_crc"), F.count("*").alias("_n"))
    return (per_key.join(dim.select(key, *names), key, "left").groupBy(*names)
            .agg(F.sum("_crc").alias("Ventas_CRC"), F.sum("_n").alias("Filas")))


def _top(df: DataFrame, order: list, n: int | None) -> DataFrame:
    df = df.orderBy(*order)
    return df if n is None else df.limit(n)


def sales_by_customer(fact: DataFrame, dim: DataFrame, n: int | None = None) -> DataFrame:
    """Sales per customer name, largest first; all of them unless ``n`` is given."""
    rows = _by_dimension(fact, dim, "CustomerKey", ["CardName"]).drop("Filas")
    return _top(rows, [F.desc("Ventas_CRC"), "CardName"], n)


def sales_by_product(fact: DataFrame, dim: DataFrame, n: int | None = None) -> DataFrame:
    rows = _by_dimension(fact, dim, "ProductKey", ["ItemCode", "ItemName"]).drop("Filas")
    return _top(rows, [F.desc("Ventas_CRC"), "ItemCode"], n)


def fallback_audit(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Rows and sales per customer, most rows first: shows what fell back to the catch-all."""
    rows = _by_dimension(fact, dim, "CustomerKey", ["CardCode", "CardName"])
    return rows.orderBy(F.desc("Filas"), "CardCode")


def count_by_year(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(F.year(col).alias("Ano")).agg(F.count("*").alias("Cant")).orderBy("Ano")


def line_totals(lines: DataFrame, keys: list[str], price: Column, qty: Column,
                discount_pct: Column | None = None) -> DataFrame:
    """Subtotal, discount, net and line count per key, added up from line rows and rounded once.

    However many lines a key has, they are combined before the shuffle and none is gathered. A line without an
    amount (see ``net_cents``) leaves its key without one.
    """
    gross, net = sum_of_all(net_cents(price, qty)), sum_of_all(net_cents(price, qty, discount_pct))
    return lines.groupBy(*keys).agg(
        from_cents(gross).alias("subtotal"), from_cents(gross - net).alias("descuento"),
        from_cents(net).alias("neto"), F.count("*").alias("lineas"))


def order_stats(df: DataFrame, total: str = "total") -> DataFrame:
    """Count, revenue, average (2 decimals), smallest and largest; zeros when there are no rows.

    The average is NULL when rows exist but none has a total.
    """
    n = F.count("*")
    money = F.col(total).cast("decimal(18,2)")
    mean = F.round(F.sum(money) / F.count(money), 2).cast("decimal(18,2)")
    zero = F.lit(0).cast("decimal(18,2)")
    return df.agg(
        n.alias("total_ordenes"),
        F.coalesce(F.sum(money), zero).alias("total_revenue"),
        F.when(n == 0, zero).otherwise(mean).alias("avg_order_value"),
        F.when(n == 0, zero).otherwise(F.min(money)).alias("min_order_value"),
        F.when(n == 0, zero).otherwise(F.max(money)).alias("max_order_value"))


def error_summary(rejects: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` errors in row order, each with the error total and how many follow."""
    total = rejects.agg(F.count("*").alias("errores")).scalar()
    first = rejects.orderBy("row", "field", "rule").limit(n)
    more = F.greatest(total - n, F.lit(0))
    return first.select("row", "field", "rule", "message", total.alias("errores"),
                        more.cast("bigint").alias("mas"))


def target_attainment(fact: DataFrame, targets: DataFrame) -> DataFrame:
    """Actual and target USD per customer, product and month; attainment NULL without a target."""
    keys = ["ClienteID", "ProductoID", "Anio", "Mes"]
    # the key already holds year and month, so no lookup is needed before adding up
    actual = fact.groupBy(
        "ClienteID", "ProductoID", F.floor(F.col("TiempoID") / 10000).cast("int").alias("Anio"),
        F.floor(F.col("TiempoID") / 100 % 100).cast("int").alias("Mes"),
    ).agg(F.sum("TotalVentaUSD").alias("ActualUSD"))
    target = targets.groupBy(*keys).agg(F.sum("MetaUSD").alias("MetaUSD"))
    both = actual.join(target, keys, "full")
    ratio = F.coalesce("ActualUSD", F.lit(0)) / F.when(F.col("MetaUSD") != 0, F.col("MetaUSD"))
    return both.select(*keys, F.coalesce("ActualUSD", F.lit(0)).cast("decimal(28,2)").alias("ActualUSD"),
                       "MetaUSD", F.round(ratio.cast("decimal(38,12)"), 4).alias("Cumplimiento"))


def basket_rules(df: DataFrame, order: str, item: str, min_support: float = 0.01,
                 min_confidence: float = 0.3) -> tuple[DataFrame, DataFrame]:
    """Frequent item sets and association rules, both relative to all orders.

    Items below the support can be in no frequent set, so they go before baskets are built; a
    basket is then never larger than the number of frequent items. The distinct pairs and the
    baskets are written once, since counting and mining read them several times.
    """
    spark = df.sparkSession
    pairs = df.select(F.col(order).alias("basket"), F.col(item).alias("item")).where(
        "item is not null").distinct()
    pairs = write_table(pairs, scratch_path(spark, "pairs"))
    orders = pairs.select("basket").distinct().count()
    often = (pairs.groupBy("item").agg(F.count("*").alias("_n"))
             .where(F.col("_n") >= min_support * orders))
    baskets = pairs.join(often, "item", "left_semi").groupBy("basket").agg(
        F.collect_set("item").alias("items"))
    baskets = write_table(baskets, scratch_path(spark, "baskets"))
    held = baskets.count()
    if not held:
        kind = baskets.schema["items"].dataType.simpleString()
        return (spark.createDataFrame([], f"items {kind}, freq bigint, support double"),
                spark.createDataFrame([], f"antecedent {kind}, consequent {kind}, "
                                          "confidence double, lift double, support double"))
    # support counts against all orders, also those left with no frequent item
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, min_support * orders / held),
                     minConfidence=min_confidence).fit(baskets.select("items"))
    sets = model.freqItemsets.withColumn("support", F.col("freq") / F.lit(float(orders)))
    scale = F.lit(held / orders)
    rules = model.associationRules.withColumn("support", F.col("support") * scale)
    rules = rules.withColumn("lift", F.col("lift") / scale)
    return sets, rules


def import_summary(flagged: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows inserted and refused, per ``by`` when given, in one pass over checked rows."""
    good = F.size("errors") == 0
    counts = [F.count_if(good).alias("inserted"), F.count_if(~good).alias("rejected")]
    return flagged.groupBy(*by).agg(*counts) if by else flagged.agg(*counts)
