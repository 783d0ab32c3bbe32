"""Exact deduplication by stateful streaming.

Documents land as small rows (digest of the text, document, place of its content). A stream keeps, for every
digest and without expiry, the count and the document that stays, in a state store on the executors' disks with
its log in the shared folder. New documents only go through the state; texts do not. A digest that was met again
is a hit, and every hit is held against the text of the document that stays, byte by byte; texts that differ
under one digest form groups of their own.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesales.llm.common import cut
from lakesales.session import scratch_path

_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # many small stores: megabytes set aside in advance for each would be most of the disk
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    # all stores of an executor share this much memory; the rest of the state is on disk
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "96",
    # stores of a finished run are closed soon, not after a minute
    "spark.sql.streaming.stateStore.maintenanceInterval": "5s",
}
_LANDED = "digest binary, doc_id bigint, file string, row bigint"


def one_blank(text: Column) -> Column:
    """Each run of white space becomes one blank; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def sha256_of(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def with_place(docs: DataFrame) -> DataFrame:
    """Adds `_row_place`, the file and row of each document; rows that come from no file are written to one first."""
    try:
        return docs.withColumn("_row_place", F.struct(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")))
    except Exception as e:
        if "_metadata" not in str(e):
            raise
        return with_place(cut(docs, "located"))


def _keeper() -> Column:
    """Smallest document first, those without an id last; of equal ids the first by place."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "row")


class DedupState:
    """Keyed state of all documents so far. `land` adds a batch (a name lands once; again is refused, so nothing
    counts twice), `advance` takes what landed into the state, `groups` reads it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def land(self, batch: str, docs: DataFrame) -> None:
        """docs: digest, doc_id, file, row."""
        docs.write.mode("error").parquet(f"{self.path}/landed/{batch}")

    def landed(self, batch: str = "") -> DataFrame:
        """All that landed, or what landed as one batch."""
        return self.spark.read.schema(_LANDED).option("recursiveFileLookup", "true").parquet(f"{self.path}/landed/{batch}")

    def has_landed(self) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/landed")
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)

    def advance(self) -> None:
        """Runs the stream until all that landed is in the state."""
        before = {k: self.spark.conf.get(k, None) for k in _STATE_CONF}
        for k, v in _STATE_CONF.items():
            self.spark.conf.set(k, v)
        try:
            stream = self.spark.readStream.schema(_LANDED).option("recursiveFileLookup", "true") \
                .parquet(f"{self.path}/landed")
            groups = stream.groupBy("digest").agg(
                F.min(_keeper()).alias("keeper"), F.count(F.lit(1)).alias("size"))
            path = self.path

            def commit(changed: DataFrame, batch: int) -> None:
                # one folder a batch: a batch that runs again replaces its own output
                changed.write.mode("overwrite").option("partitionOverwriteMode", "static") \
                    .parquet(f"{path}/groups/batch={batch}")

            query = groups.writeStream.outputMode("update").trigger(availableNow=True) \
                .option("checkpointLocation", f"{self.path}/state").foreachBatch(commit).start()
            query.awaitTermination()
        finally:
            for k, v in before.items():
                self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)

    def groups(self) -> DataFrame:
        """digest, keeper, size of every digest, as of its last change."""
        changes = self.spark.read.option("basePath", f"{self.path}/groups").parquet(f"{self.path}/groups")
        return changes.groupBy("digest").agg(F.max_by(F.struct("keeper", "size"), "batch").alias("g")).select(
            "digest", "g.keeper", "g.size")


def _located(spark: SparkSession, places: DataFrame, key: str, text: str) -> DataFrame:
    """The documents at (file, row): their files are opened, and read for these rows."""
    files = [r["file"] for r in places.select("file").distinct().collect()]
    if not files:
        return with_place(cut(spark.createDataFrame([], "doc_id bigint, text string"), "none"))
    docs = with_place(spark.read.parquet(*files).select(
        F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"), "_metadata"))
    wanted = places.select(F.struct("file", "row").alias("_row_place"))
    return docs.drop("_metadata").join(wanted, "_row_place", "left_semi").select("doc_id", "text", "_row_place")


def exact_groups(docs: DataFrame, digest: Callable[[Column], Column] = sha256_of, key: str = "doc_id",
                 text: str = "text", at: str | None = None, batch: str | None = None) -> DataFrame:
    """Every row's group of equal normalised texts: doc_id, place, keep_id, group_size, kept, text_sha256.

    Of a group the row with the smallest id stays; of rows with that id the first by file and row, so exactly
    one row of a group is kept even where rows are repeated. Rows without an id come last (keep_id is null
    where no row of the group has one). Null text counts as empty, and empty texts are one group. An empty table
    gives no rows; extra columns are ignored.

    `at`: a folder that keeps the state, so that further calls bring further deliveries; `batch` names one, and a name
    that landed before is refused. Such a call returns the rows of all groups that the delivery has a part in, earlier
    rows too. Their texts are opened where they lay, so documents have to come from Parquet files that stay.
    """
    spark = docs.sparkSession
    state = DedupState(spark, at or scratch_path(spark, "dedup"))
    landed_before = at is not None and state.has_landed()
    placed = with_place(docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text")))
    read = placed.withColumn("norm", one_blank(F.col("text"))).withColumn("digest", digest(F.col("norm")))
    name = batch or f"batch-{uuid.uuid4().hex}"
    state.land(name, read.select("digest", "doc_id", "_row_place.file", "_row_place.row"))
    state.advance()

    groups = cut(state.groups(), "groups")
    members = state.landed()
    if landed_before:
        new = state.landed(name)
        touched = new.select("digest").distinct()
        groups, members = (df.join(touched, "digest", "left_semi") for df in (groups, members))
        earlier = _located(spark, members.join(new, ["file", "row"], "left_anti"), key, text)
        read = read.unionByName(earlier.withColumn("norm", one_blank(F.col("text"))).withColumn(
            "digest", digest(F.col("norm"))).select(*read.columns))
    hits = cut(read.join(groups.filter("size > 1"), "digest").select(
        "digest", "norm", F.struct("doc_id", F.col("_row_place.file").alias("file"), F.col("_row_place.row").alias("row"))
        .alias("member"), "keeper"), "hits")
    same_place = (F.col("member.file") == F.col("keeper.file")) & (F.col("member.row") == F.col("keeper.row"))
    stays = hits.filter(same_place).select("digest", F.col("norm").alias("kept_norm"))
    other = cut(hits.join(stays, "digest").filter(F.col("norm") != F.col("kept_norm")).select(
        "digest", "norm", "member.*"), "unequal")
    # texts that only share their digest: grouped by the whole text
    own = other.groupBy("digest", "norm").agg(F.min(_keeper()).alias("own_keeper"),
                                              F.count(F.lit(1)).alias("own_size"))
    moved = other.join(own, ["digest", "norm"]).select(
        "digest", "file", "row", "own_keeper", "own_size", F.sha2(F.col("norm").cast("binary"), 256).alias("own_sha"))
    less = other.groupBy("digest").agg(F.count(F.lit(1)).alias("gone"))
    shas = read.select("digest", F.struct(F.col("_row_place.file").alias("file"), F.col("_row_place.row").alias("row"))
                       .alias("at"), F.sha2(F.col("norm").cast("binary"), 256).alias("sha"))
    if digest is sha256_of:
        members = members.withColumn("sha", F.lower(F.hex("digest")))
    else:
        members = members.join(shas.select("at.*", "sha"), ["file", "row"])
    out = (members.join(groups, "digest").join(less, "digest", "left")
           .join(moved.drop("digest"), ["file", "row"], "left"))
    keeper = F.coalesce("own_keeper", "keeper")
    return out.select(
        "doc_id", "file", "row", keeper["doc_id"].alias("keep_id"),
        F.coalesce("own_size", F.col("size") - F.coalesce("gone", F.lit(0))).alias("group_size"),
        ((keeper["file"] == F.col("file")) & (keeper["row"] == F.col("row"))).alias("kept"),
        F.coalesce("own_sha", "sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns; see exact_groups."""
    placed = with_place(docs)
    groups = exact_groups(placed, key=key, text=text).filter("kept").select(
        F.struct("file", "row").alias("_row_place"))
    return placed.join(groups, "_row_place", "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
