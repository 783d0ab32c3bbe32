"""Writers and staging."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesales.session import scratch_path


def write_rejects(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Rows as CSV with a header, for download and repair."""
    df.write.mode(mode).csv(path, header=True, quote='"', escape='"')


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: Sequence[str] = (), replace: str = "all") -> DataFrame:
    """Parquet table, read back.

    Partitioned output is rebalanced first: small partitions share a task, and a partition with
    much data is split over several. Overwriting replaces ``all`` that was there; an incremental load
    says ``replace="partitions"`` and keeps the partitions that it does not bring.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    overwrite_mode = {"all": "static", "partitions": "dynamic"}[replace]
    df.write.mode(mode).option("partitionOverwriteMode", overwrite_mode).partitionBy(*partition_by).parquet(path)
    reader = df.sparkSession.read
    if mode == "overwrite" and not partition_by:
        reader = reader.schema(df.schema)  # known, so no file needs opening to infer it
    return reader.parquet(path)


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def rewrite_partitions(spark: SparkSession, path: str, partition_by: Sequence[str],
                       touched: Callable[[DataFrame], DataFrame], change: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Changes some partitions of a stored table and leaves the files of all others alone; returns those changed.

    ``touched`` names the partitions, from the stored table; ``change`` takes their rows, and what it returns replaces
    them. It has to stay inside these partitions. Their values come to the driver, which lists the partitions of a
    table anyhow. The new rows are written beside the table in full before any old file goes: a run that finds such
    rows, because an earlier one was ended in the middle, puts them in place first.
    """
    beside = f"{path.rstrip('/')}__rewritten"
    files, staged = _files(spark, beside)

    def put_in_place() -> None:
        rows = spark.read.parquet(beside).hint("rebalance", *partition_by)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
        files.delete(staged, True)

    _, finished = _files(spark, f"{beside}/_SUCCESS")
    if files.exists(finished):
        put_in_place()
    stored = spark.read.parquet(path)
    values = touched(stored).select(*partition_by).distinct().collect()
    listed = spark.createDataFrame([tuple(r) for r in values], stored.select(*partition_by).schema)
    if not values:
        return listed
    hit = F.lit(False)
    for r in values:
        same = F.lit(True)
        for c, v in zip(partition_by, r):
            same = same & F.col(c).eqNullSafe(F.lit(v))
        hit = hit | same
    new = change(stored.where(hit)).select(*stored.columns)
    new.write.mode("overwrite").partitionBy(*partition_by).parquet(beside)
    put_in_place()
    return listed


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int, mode: str = "overwrite") -> DataFrame:
    """Catalog table hashed and sorted by a join key: tables with equal buckets join unshuffled."""
    df.write.mode(mode).bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)


def stage(df: DataFrame, view: str, materialise: bool = False) -> DataFrame:
    """Names a frame for SQL; ``materialise`` writes it to the shared folder once."""
    if materialise:
        df = write_table(df, scratch_path(df.sparkSession, view))
    df.createOrReplaceTempView(view)
    return df

