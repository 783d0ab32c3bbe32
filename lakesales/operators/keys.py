"""Surrogate keys and row spreading without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lakesales.session import scratch_path
from lakesales.sources.sinks import write_table

#: Hex digits of the bucket number: 4096 buckets. More digits make more, smaller buckets and the same keys.
BUCKET_CHARS = 3
#: Items of one stored document.
MAX_ITEMS = 10_000


def key_hash(cols: list[str]) -> Column:
    """Hash of a natural key: its first digits spread distinct keys evenly over buckets."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in cols])
    return F.md5(text.cast("binary"))


def assign_keys(df: DataFrame, by: list[str], key: str, start: Column | int = 1,
                tie: list[str] | None = None, chars: int = BUCKET_CHARS) -> DataFrame:
    """Dense integer keys ``start, start+1, ...`` in the order of the key's hash, for rows unique on ``by`` (and
    ``tie``).

    Rows are numbered inside buckets of the hash, and each bucket is shifted by the sizes of the buckets before it.
    The bucket table has 16**chars rows at most, so it is safe to broadcast; no task ever sorts the whole relation,
    and the numbering is the same in every run and for every number of buckets. The input is written to the shared
    folder once, since counting and numbering both read it.
    """
    start = F.lit(start) if isinstance(start, int) else start
    tagged = write_table(df.withColumn("_h", key_hash(by)), scratch_path(df.sparkSession, "unnumbered"))
    tagged = tagged.withColumn("_b", F.substring("_h", 1, chars))
    before = W.orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    offsets = tagged.groupBy("_b").agg(F.count("*").alias("_n")).select(
        "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    numbered = tagged.withColumn(
        "_rn", F.row_number().over(W.partitionBy("_b").orderBy("_h", *by, *(tie or []))))
    value = (F.col("_offset") + F.col("_rn") - 1 + start).cast("bigint")
    return numbered.join(F.broadcast(offsets), "_b").select(value.alias(key), *df.columns)


def number_within(df: DataFrame, keys: list[str], order: list[Column], number: str = "linea") -> DataFrame:
    """Numbers 1, 2, ... of the rows of each key in the given order; equal rows may swap.

    Rows are sorted into ranges of (key, order), so a key with a third of all rows lies in many ranges. Each range
    is numbered by itself and goes on from the ranges before it. Only keys that reach over the edge of a range need
    that start, so there is at most one for each range. The ranges are written down, so a task that runs again
    sees the same ones.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = df.select("*", *[o.alias(f"_o{i}") for i, o in enumerate(order)])
    sort = [F.col(k) for k in keys] + [F.col(f"_o{i}") for i in range(len(order))]
    placed = write_table(tagged.repartitionByRange(ranges, *sort).withColumn("_range", F.spark_partition_id()),
                         scratch_path(spark, "ranges"))
    counts = placed.groupBy(*keys, "_range").agg(F.count("*").alias("_n"))
    earlier = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.withColumn("_start", F.sum("_n").over(earlier)).where("_start is not null").select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_range").alias("_r"), "_start")
    same = F.col("_range") == F.col("_r")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    inside = F.row_number().over(W.partitionBy(*keys, "_range").orderBy(*sort[len(keys):]))
    numbered = placed.withColumn("_in", inside).join(F.broadcast(starts), same, "left")
    return numbered.select(*df.columns, (F.col("_in") + F.coalesce("_start", F.lit(0))).alias(number))


def nest_items(lines: DataFrame, keys: list[str], item: Column, items: str = "items",
               max_items: int | None = None) -> DataFrame:
    """Line table to documents: (keys, parte, primera, items[]), for a store whose documents are bounded.

    A document holds ``max_items`` items (``MAX_ITEMS`` by default) and a key with more goes on in the next part.
    ``parte`` counts from 0 without gaps, every part but the last is full, and ``primera`` is the number of the
    part's first line, so ``explode_items`` gives the same rows whatever the bound. Amounts, counts and checks of
    whole orders are taken from the lines, not from documents.
    """
    size = max_items or MAX_ITEMS
    rows = lines.select(*keys, item.alias("_item"))

    def whole(df: DataFrame) -> DataFrame:
        docs = df.groupBy(*keys).agg(F.array_sort(F.collect_list("_item")).alias(items))
        return docs.select(*keys, F.lit(0).alias("parte"), F.lit(1).cast("bigint").alias("primera"), items)

    counts = lines.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > size)
    long_keys = counts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    if not long_keys.head(1):  # no key needs a second part, so no line needs a number
        return whole(rows)
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    numbered = number_within(rows.join(long_keys, same, "left_semi"), keys, [F.col("_item")], "_line")
    part = F.floor((F.col("_line") - 1) / size).cast("int")
    parts = numbered.select(*keys, part.alias("parte"), "_line", "_item").groupBy(*keys, "parte").agg(
        F.array_sort(F.collect_list(F.struct("_line", "_item"))).alias("_rows"))
    return whole(rows.join(long_keys, same, "left_anti")).unionByName(parts.select(
        *keys, "parte", (F.col("parte") * size + 1).cast("bigint").alias("primera"), F.col("_rows._item").alias(items)))
