"""Token ids as files: every text is encoded whole, documents lie in ascending order of their id.

Files are Parquet tables of blocks (simple8b.py), so any store that Spark writes to can hold them and a task that
runs again leaves no half-written file. Block rows also say how many ids of their shard come before them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakesales.llm import simple8b
from lakesales.llm.common import chunks, parts_for, text_bytes
from lakesales.llm.tokens import encoder

#: Ids that a block holds at least, and bytes of text for each shard (a task and a file).
BLOCK_IDS, SHARD_BYTES = 1 << 20, 24 << 20
_BLOCK = "shard int, block int, ids_before bigint, n_docs int, n_ids bigint, data binary"
_DOC = "shard int, doc_id bigint, begin bigint, n_tokens bigint, ids_crc32 bigint"


def _block_writer(path: str, end_id: int | None):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, before = TaskContext.get().partitionId(), 0, 0
        docs: list = []
        counts: list[np.ndarray] = []
        ids: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            nonlocal block, before
            every = np.concatenate(ids)
            data = simple8b.pack_block(docs, np.concatenate(counts), every)
            row = pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "block": pa.array([block], pa.int32()),
                "ids_before": pa.array([before], pa.int64()), "n_docs": pa.array([len(docs)], pa.int32()),
                "n_ids": pa.array([len(every)], pa.int64()), "data": pa.array([data], pa.binary())})
            block, before = block + 1, before + len(every)
            docs.clear(), counts.clear(), ids.clear()
            return row

        held = 0
        for batch in batches:
            for part in chunks(batch):
                found, offsets = encoder(path).encode(part.column("text"), end_id)
                docs += part.column("doc_id").to_pylist()
                counts.append(np.diff(offsets))
                ids.append(found)
                held += len(found)
                if held >= BLOCK_IDS:
                    yield flush()
                    held = 0
        if docs:
            yield flush()
    return write


def write_token_files(docs: DataFrame, to: str, tokenizer: str, end_id: int | None = None, key: str = "doc_id",
                      text: str = "text") -> None:
    """Encodes every whole text and writes the shards below `to`.

    Null text: empty, so the document has its end id alone. Documents without an id come first; documents with
    one id lie side by side, in the order of a hash of their text. Extra columns are ignored. An empty table
    makes files without blocks. Shards grow in number with the bytes of text; one document is never split.
    """
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    (rows.repartitionByRange(parts_for(text_bytes(rows), SHARD_BYTES), *order).sortWithinPartitions(*order)
     .mapInArrow(_block_writer(tokenizer, end_id), _BLOCK)
     .write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd").parquet(to))


def read_blocks(spark: SparkSession, at: str) -> DataFrame:
    return spark.read.schema(_BLOCK).parquet(at)


def _read_docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.select(["shard", "ids_before", "data"]).to_pylist():
            doc_ids, counts, ids = simple8b.read_block(row["data"])
            little = ids.astype("<u4")
            ends = np.cumsum(counts)
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([row["shard"]] * len(doc_ids), pa.int32()),
                "doc_id": pa.array(doc_ids, pa.int64()),
                "begin": pa.array(ends - counts + row["ids_before"], pa.int64()),
                "n_tokens": pa.array(counts, pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(little[e - c:e].tobytes())
                                       for c, e in zip(counts, ends, strict=True)], pa.int64())})


def read_token_ids(spark: SparkSession, at: str) -> DataFrame:
    """doc_id and its ids, as an array of long, from the files."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("data").to_pylist():
                doc_ids, counts, ids = simple8b.read_block(data)
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(doc_ids, pa.int64()),
                    "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int64)))})
    return read_blocks(spark, at).select("data").mapInArrow(read, "doc_id bigint, ids array<bigint>")


def token_index(spark: SparkSession, at: str) -> DataFrame:
    """Per document, read back from the files: doc_id, start (ids of all documents before it), n_tokens and
    ids_crc32, the crc32 of its ids as little-endian unsigned 32-bit integers."""
    blocks = read_blocks(spark, at)
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    # one row a shard
    bases = shards.select("shard", F.coalesce(F.sum("ids").over(
        Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    docs = blocks.select("shard", "ids_before", "data").mapInArrow(_read_docs, _DOC)
    return docs.join(bases, "shard").select("doc_id", (F.col("base") + F.col("begin")).alias("start"), "n_tokens",
                                            "ids_crc32")
