"""Listings whose pages are found by rank: any page costs the same, however deep it is."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lakesales.operators.filters import check_page

#: Rows of one range, of which a page reads one or two.
RANGE_ROWS = 100_000


def store_ranked(df: DataFrame, path: str, order: list[Column], range_rows: int = RANGE_ROWS) -> None:
    """Writes a listing in ranges of its order, with the number of rows in front of each range.

    The order should end in a unique key. Ranges are sorted by themselves, and a row's place in its range is given
    behind the sort, in the stage that writes it, so no task sees more than a range.
    """
    ranges = max(1, math.ceil(df.count() / range_rows))
    placed = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed.select(*df.columns, place.alias("_place"), F.spark_partition_id().alias("_range")).write.mode(
        "overwrite").partitionBy("_range").parquet(f"{path}/rows")
    df.limit(0).write.mode("overwrite").parquet(f"{path}/columns")  # an empty listing has no other file that tells them
    rows = _rows(df.sparkSession, path)
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)  # one row a range
    rows.groupBy("_range").agg(F.count("*").alias("_n")).select(
        "_range", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")).write.mode("overwrite").parquet(f"{path}/ranges")


def _rows(spark: SparkSession, path: str) -> DataFrame:
    columns = spark.read.parquet(f"{path}/columns").schema
    return spark.read.schema(columns.add("_place", "long").add("_range", "integer")).parquet(f"{path}/rows")


def page_at(spark: SparkSession, path: str, page: int, limit: int) -> DataFrame:
    """Rows of one page of a stored listing with their rank (from 1), total, page, limit and pages.

    Only the ranges that the page lies in are read, and nothing in front of it is sorted. A page behind the last one
    is empty.
    """
    check_page(page, limit)
    ranges = spark.read.parquet(f"{path}/ranges")
    first = (page - 1) * limit
    held = ranges.where((F.col("_before") < first + limit) & (F.col("_before") + F.col("_n") > first)).collect()
    total = ranges.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).first()["n"]
    rows = _rows(spark, path)
    rows = rows.where(F.col("_range").isin([r["_range"] for r in held]))
    start = F.lit(0)
    for r in held:  # a page lies in few ranges
        start = F.when(F.col("_range") == r["_range"], r["_before"]).otherwise(start)
    ranked = rows.withColumn("puesto", start + F.col("_place") + 1).where(F.col("puesto").between(first + 1, first + limit))
    return ranked.orderBy("puesto").select(
        *[c for c in rows.columns if c not in ("_place", "_range")], "puesto", F.lit(total).alias("total"), F.lit(page).alias("page"),
        F.lit(limit).alias("limit"), F.lit(math.ceil(total / limit)).cast("bigint").alias("pages"))
