"""Typed readers for every source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lakesales.functions.text import file_extension
from lakesales.schemas import (AGG_SALES, DOCUMENTS, ERP, GRAPH_ORDER, RATES, SOURCE_TABLES)
from lakesales.session import scratch_path
from lakesales.sources.csv_records import csv_records, headers, split_fields
from lakesales.sources.json_array import read_array
from lakesales.sources.sinks import write_table


def read_rates(spark: SparkSession, path: str) -> DataFrame:
    """Daily rates file (byte-order mark and CRLF allowed) as (Fecha date, rate).

    A line with an unreadable day or rate has neither and keeps its text, see ``split_corrupt``.
    """
    rows = spark.read.csv(path, schema=f"{RATES}, {CORRUPT} string", header=True, encoding="UTF-8",
                          mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
    # all fields of a broken line go: a rate without its day would count for none, a day without its rate as a gap
    whole = F.col(CORRUPT).isNull()
    return rows.select(F.when(whole, F.to_date("Fecha")).alias("Fecha"),
                       F.when(whole, F.col("TipoCambio_USD_CRC")).alias("TipoCambio_USD_CRC"), CORRUPT)


CORRUPT = "_corrupt_record"


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readable rows, and the text of those that could not be read whole, as (texto).

    The rows are written to the shared folder first, so the files are parsed once for both.
    """
    if CORRUPT not in df.columns:
        return df, df.limit(0).select(F.lit(None).cast("string").alias("texto"))
    df = write_table(df, scratch_path(df.sparkSession, "parsed"))
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT), df.where(F.col(CORRUPT).isNotNull()).select(
        F.col(CORRUPT).alias("texto"))


def _read_json(spark: SparkSession, path: str, schema: str, corrupt: bool, **options) -> DataFrame:
    if corrupt:
        schema, options = f"{schema}, {CORRUPT} string", {**options, "columnNameOfCorruptRecord": CORRUPT}
    return spark.read.schema(schema).json(path, mode="PERMISSIVE", **options)


def read_agg_sales(spark: SparkSession, path: str, json_lines: bool = True, corrupt: bool = False) -> DataFrame:
    """Monthly sales, one record per line, or files that hold one JSON array each (``json_lines=False``).

    Both are read in splits, see ``json_array``. ``corrupt`` keeps the text of unreadable records, see
    ``split_corrupt``.
    """
    if json_lines:
        return _read_json(spark, path, AGG_SALES, corrupt)
    return parse_records(read_array(spark, path), "texto", AGG_SALES, corrupt)


def parse_records(df: DataFrame, text: str, schema: str, corrupt: bool = False) -> DataFrame:
    """JSON texts as rows of the schema; ``corrupt`` as in the readers."""
    options = {"mode": "PERMISSIVE"}
    if corrupt:
        schema, options = f"{schema}, {CORRUPT} string", {**options, "columnNameOfCorruptRecord": CORRUPT}
    return df.select(F.from_json(text, schema, options).alias("_r")).select("_r.*")


def read_jdbc(spark: SparkSession, url: str, table: str, schema: str, key: str | None = None,
              low: int | None = None, high: int | None = None, partitions: int = 0,
              **options: str) -> DataFrame:
    """Relational table over JDBC, read in parallel ranges of a numeric key.

    Without a key all rows come through one task, which has to be asked for with ``partitions=1``.
    """
    if not key and partitions != 1:
        raise ValueError("a parallel read needs a numeric key with its bounds")
    if key and (low is None or high is None or partitions < 2):
        raise ValueError("a key needs its bounds and at least two partitions")
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=table, customSchema=schema, **options)
    if key:
        reader = reader.options(partitionColumn=key, lowerBound=str(low), upperBound=str(high),
                                numPartitions=str(partitions))
    return reader.load()


def read_erp(spark: SparkSession, base: str, table: str) -> DataFrame:
    """One ERP table from the landing folder."""
    return spark.read.schema(ERP[table]).parquet(f"{base}/{table}")


def read_source(spark: SparkSession, source: str, table: str, path: str,
                fmt: str = "parquet") -> DataFrame:
    """One table of a relational source with that source's own types; text files keep the text of bad rows, see
    ``split_corrupt``."""
    schema = SOURCE_TABLES[source, table]
    if fmt == "csv":
        return spark.read.schema(f"{schema}, {CORRUPT} string").csv(
            path, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
    return spark.read.schema(schema).format(fmt).load(path)


def read_documents(spark: SparkSession, path: str, collection: str) -> DataFrame:
    """Export of a document collection, one JSON document per line.

    Unreadable documents keep their text in ``_corrupt_record``.
    """
    return _read_json(spark, path, DOCUMENTS[collection], True)


def read_graph_orders(spark: SparkSession, path: str, corrupt: bool = False) -> DataFrame:
    """Nested order payloads of the graph source."""
    return _read_json(spark, path, GRAPH_ORDER, corrupt)


def read_any(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Format by file extension, compared in lower case."""
    extension = file_extension(path)
    reader = spark.read.schema(schema) if schema else spark.read
    if extension == "csv":
        return reader.csv(path, header=True)
    if extension in ("json", "jsonl"):
        return reader.json(path)
    if extension == "parquet":
        return reader.parquet(path)
    raise ValueError(f"Unsupported file format: {extension}")


def spread(df: DataFrame) -> DataFrame:
    """Deals a scan with fewer splits than cores over all of them; wider scans stay as they are.

    For work that is heavy per row on files that do not split: one row group, compressed text.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def number_rows(df: DataFrame, row: str = "_row") -> DataFrame:
    """Row number inside each file, counted over its splits in file order.

    ``df`` must come straight from a file scan with ``_file``, ``_block`` and ``_id`` (the
    running id Spark gives in scan order). Splits are numbered by themselves and shifted by the
    rows of the splits before them, so no file passes through one task.
    """
    # parsed and numbered once, then read from a table: the files are not parsed again for the counts
    df = write_table(df, scratch_path(df.sparkSession, "rows"))
    splits = df.groupBy("_file", "_block").agg(F.min("_id").alias("_first"),
                                               F.count("*").alias("_n"))
    before = W.partitionBy("_file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    shifts = splits.select("_file", "_block", "_first",
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    position = F.col("_shift") + F.col("_id") - F.col("_first") + 1
    keep = [F.col(f"`{c}`") for c in df.columns if c not in ("_block", "_id")]
    # one row a split, so the rows stay where they are
    return df.join(F.broadcast(shifts), ["_file", "_block"]).select(position.alias(row), *keep)


def read_loader_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Upload file with a header row: every column a string, empty lines skipped.

    Adds ``_row``, the number of the data row in its file. Files read together must have the same
    header; others raise an error (``csv_records.read_mapped`` takes them). ``multiline`` allows line breaks inside
    quoted fields; such files are read in splits too, see ``csv_records``.
    """
    if multiline:
        records = csv_records(spark, path)
        heads, width = headers(records)
        names = [r["nombres"] for r in heads.select("nombres").distinct().limit(2).collect()]
        if len(names) > 1 or any(len(set(n)) < len(n) or None in n for n in names):
            raise ValueError("headers differ, or a column name is empty or repeated")
        rows = records.where("_n > 1").select((F.col("_n") - 1).alias("_row"), "_file", split_fields(F.col("texto"), width).alias("_v"))
        return rows.select("_row", "_file", *[F.col("_v")[i].alias(c) for i, c in enumerate(names[0] if names else [])])
    raw = spark.read.csv(path, header=True, inferSchema=False, enforceSchema=False, quote='"', escape='"')
    tagged = raw.select(F.col("_metadata.file_path").alias("_file"),
                        F.col("_metadata.file_block_start").alias("_block"),
                        F.monotonically_increasing_id().alias("_id"),
                        *[F.col(f"`{c}`") for c in raw.columns])
    return number_rows(tagged)
