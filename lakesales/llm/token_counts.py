"""Token counts as rollups that deltas keep up to date.

Totals by source, language and tokenizer version are sums of signed rows, so an insert adds, a delete takes away
and a revision does both. Every batch of changes is added up and committed under its name: a batch that is delivered
again counts once. From time to time the batches are folded into the totals.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesales.llm.common import chunks
from lakesales.llm.tokens import encoder

KEYS = ["source", "lang", "tokenizer"]
MEASURES = ["n_docs", "n_bytes", "n_tokens"]
_FACTS = "doc_id bigint, source string, lang string, tokenizer string, n_docs bigint, n_bytes bigint, n_tokens bigint"
_TOTALS = "source string, lang string, tokenizer string, n_docs bigint, n_bytes bigint, n_tokens bigint"


def count_tokens(docs: DataFrame, tokenizer: str, version: str, end_ids: int = 0) -> DataFrame:
    """One row a document: its keys and counts under one tokenizer version; `end_ids` are added to each.

    Null text counts as empty (0 bytes); null source or language stays a key of its own; repeated rows count
    as often as they stand there; extra columns are ignored; an empty table gives no rows.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                _, offsets = encoder(tokenizer).encode(part.column("text"))
                n = part.num_rows
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"), "source": part.column("source"), "lang": part.column("lang"),
                    "tokenizer": pa.array([version] * n, pa.string()), "n_docs": pa.array(np.ones(n, np.int64)),
                    "n_bytes": pc.fill_null(pc.binary_length(part.column("text")), 0).cast(pa.int64()),
                    "n_tokens": pa.array(np.diff(offsets) + end_ids, pa.int64())})

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", "lang", "text").mapInArrow(
        count, _FACTS)


def inserts(facts: DataFrame) -> DataFrame:
    return facts


def deletes(facts: DataFrame) -> DataFrame:
    """The same rows with all measures negative."""
    return facts.withColumns({m: -F.col(m) for m in MEASURES})


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Takes the old counts away and adds the new ones; no join, so repeated or missing ids do no harm."""
    return deletes(old).unionByName(new)


class Rollup:
    """Totals below a folder: what was folded so far, and one delta for each batch since.

    A small file a commit, the one with the highest number, names the folders that count. A batch is written to a folder
    of its own first and counts from the moment that file is there: a commit that is ended on the way leaves all
    totals as they were, and totals never read half a batch. One writer at a time; any number may read.
    """

    def __init__(self, spark: SparkSession, path: str, fold_after: int = 100):
        self.spark, self.path, self.fold_after = spark, path.rstrip("/"), fold_after

    def _files(self, name: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _state(self) -> tuple[int, dict]:
        """The number of the last commit, and what it says."""
        files, at = self._files("commits")
        done = [s.getPath().getName() for s in files.listStatus(at)] if files.exists(at) else []
        numbers = [int(name) for name in done if name.isdigit()]
        if not numbers:
            return 0, {"totals": None, "deltas": {}, "folded": []}
        text = self.spark.read.text(f"{self.path}/commits/{max(numbers):012d}", wholetext=True).first()[0]
        return max(numbers), json.loads(text)

    def _publish(self, number: int, state: dict) -> None:
        files, at = self._files(f"commits/{number:012d}")
        _, beside = self._files(f"commits/.{uuid.uuid4().hex}")
        out = files.create(beside)
        out.writeBytes(json.dumps(state))  # ASCII
        out.close()
        if files.exists(at) or not files.rename(beside, at):
            raise RuntimeError(f"{at} is there: another commit came first")

    def commit(self, batch: str, changes: DataFrame) -> None:
        """Adds a batch. Under a name that was committed before it takes that batch's place, or changes nothing where
        that one is folded into the totals already."""
        number, state = self._state()
        if batch in state["folded"]:
            return
        folder = f"deltas/{uuid.uuid4().hex}"
        changes.groupBy(*KEYS).agg(*[F.sum(m).cast("bigint").alias(m) for m in MEASURES]).write.parquet(f"{self.path}/{folder}")
        state["deltas"][batch] = folder
        self._publish(number + 1, state)
        if len(state["deltas"]) >= self.fold_after:
            self.fold()

    def fold(self) -> None:
        """Writes new totals of all batches so far; reading them costs the same however many batches there were."""
        number, state = self._state()
        folder = f"totals/{uuid.uuid4().hex}"
        self.totals().write.parquet(f"{self.path}/{folder}")
        self._publish(number + 1, {"totals": folder, "deltas": {}, "folded": sorted({*state["folded"], *state["deltas"]})})

    def totals(self) -> DataFrame:
        """The totals of all batches; groups whose documents are all gone leave no row."""
        _, state = self._state()
        folders = [f"{self.path}/{f}" for f in [state["totals"], *state["deltas"].values()] if f]
        counted = self.spark.read.schema(_TOTALS).parquet(*folders) if folders else self.spark.createDataFrame([], _TOTALS)
        return counted.groupBy(*KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES]).filter(
            " or ".join(f"{m} <> 0" for m in MEASURES))
