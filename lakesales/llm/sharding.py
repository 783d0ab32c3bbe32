"""Sharding by rendezvous hashing of stable record keys over weighted shards."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Records that a numbering bucket holds on average, and copies of one record that one row writes out.
BUCKET_ROWS, COPIES_A_ROW = 50_000, 10_000


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """The shard whose score for the key is highest: the first 52 bits of md5(shard:key) as u in (0, 1),
    score weight / -ln(u). Each shard's score ignores all others, so a further shard takes records only into
    itself, and each shard gets its weight's part. A null key has the text of an empty one."""
    if not weights or any(w <= 0 for w in weights):
        raise ValueError("each shard needs a weight above 0")

    def score(shard: int, weight: float) -> Column:
        digits = F.substring(F.md5(F.concat(F.lit(f"{shard}:"), F.coalesce(key.cast("string"), F.lit("")))), 1, 13)
        unit = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))
        return F.lit(-float(weight)) / F.ln(unit)

    scores = [F.struct(score(i, w).alias("score"), F.lit(-i).alias("shard")) for i, w in enumerate(weights)]
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    return (-best["shard"]).cast("int")


def assign_shards(df: DataFrame, key: str, weights: Sequence[float], name: str = "shard") -> DataFrame:
    """Adds the shard of each row, replacing a column of that name; no shuffle. Rows of one key go together, those
    without a key like those with an empty one. Other columns stay; an empty table gives no rows."""
    return df.withColumn(name, rendezvous_shard(F.col(key), weights))


def number_slots(df: DataFrame, shard: str, key: str, columns: Sequence[str]) -> DataFrame:
    """Rows (shard, *columns, slot): slot counts from 0 without gaps in each shard, in the order of md5(key),
    key, columns, whatever the layout of the data.

    Rows come back as often as they stand there, with the named columns only; nulls are values like any other. An
    empty table gives no rows. Texts take no part: the caller gives their size and checksum as columns.
    Equal records are counted before they are shuffled and written out again in portions, so a record that
    fills a third of the table passes through no single task. Buckets are ranges of md5(key), sized by the
    number of rows; their offsets are one row a bucket.
    """
    cols = list(dict.fromkeys([key, *columns]))
    records = df.groupBy(shard, *cols).agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_order", F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))))
    digits = max(0, math.ceil(math.log(max(1, df.count() / BUCKET_ROWS), 16)))
    records = records.withColumn("_bucket", F.substring("_order", 1, digits) if digits else F.lit(""))
    counts = records.groupBy(shard, "_bucket").agg(F.sum("_n").alias("_rows"))
    earlier = Window.partitionBy(shard).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(shard, "_bucket", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(shard, "_bucket").orderBy(
        "_order", *[F.col(c).asc_nulls_first() for c in cols]).rowsBetween(Window.unboundedPreceding, -1)
    placed = records.withColumn("_first", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(
        offsets, [shard, "_bucket"])
    portions = placed.withColumn("_portion", F.explode(F.sequence(
        F.lit(0), F.floor((F.col("_n") - 1) / COPIES_A_ROW)))).select(
        shard, *cols, (F.col("_base") + F.col("_first") + F.col("_portion") * COPIES_A_ROW).alias("_from"),
        F.least(F.lit(COPIES_A_ROW), F.col("_n") - F.col("_portion") * COPIES_A_ROW).alias("_take"))
    return portions.repartition(*[F.col(c) for c in (shard, "_from")]).select(
        shard, *cols, F.explode(F.sequence(F.col("_from"), F.col("_from") + F.col("_take") - 1)).alias("slot"))


def write_shards(df: DataFrame, key: str, weights: Sequence[float], path: str) -> None:
    """Writes whole rows below path/shard=N, every shard in as many files as there are tasks with its rows."""
    assign_shards(df, key, weights).write.mode("overwrite").option("partitionOverwriteMode", "static") \
        .partitionBy("shard").parquet(path)
