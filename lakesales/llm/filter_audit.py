"""What each filter of a chain removes, in every order the filters could stand in.

A document is known by the mask of filters it fails. Each mask is mapped to one wide integer that holds, in a field of
its own, what becomes of the document at every step of every order; the integers of a part are added up, and the
fields of the sum are the counts. A field has 64 bits and counts documents, so no sum runs over into its neighbour.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesales.llm.common import cut

#: The counts of one step, in the order of their fields.
OUTCOMES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
_REPORT = ("part string, filter_order string, step int, " + ", ".join(f"{x} bigint" for x in OUTCOMES)
           + ", shapley bigint")


def text_filters(text: Column) -> dict[str, Column]:
    """The filters that look at one text: whether it fails them. Null text counts as empty."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {"A": F.size(words) < 100, "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 80,
            "C": capitals * 100 > F.length(text) * 10, "D": text.rlike(r"[#$%&*|]")}


def fail_masks(docs: DataFrame, filters: Callable[[Column], Mapping[str, Column]] = text_filters) -> DataFrame:
    """(doc_id, part, mask) of every row: bit k is set where it fails filter k; the last bit is for texts identical to
    that of any smaller doc_id.

    Part: lang, null as an empty string. Repeated rows are rows of their own and, having one id, are no copies of each
    other. A row without an id is nobody's original and fails no comparison of ids. Other columns are ignored; an empty
    table gives no rows. Texts are told apart by SHA-256. A copy is found by a join on digest and id: the many rows of
    one hot text have different ids and spread over all tasks.
    """
    text = F.coalesce("text", F.lit(""))
    bits = [F.when(fails, F.lit(1 << k)).otherwise(F.lit(0)) for k, fails in enumerate(filters(F.col("text")).values())]
    mask = sum(bits[1:], bits[0])
    marked = cut(docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), mask.alias("mask"),
                             F.unhex(F.sha2(text, 256)).alias("digest")), "masks")
    first = marked.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).filter("doc_id is not null")
    joined = marked.join(first.withColumn("first", F.lit(True)), ["digest", "doc_id"], "left")
    copy = F.col("first").isNull() & F.col("doc_id").isNotNull()
    return joined.select("doc_id", "part", (F.col("mask") + F.when(copy, 1 << len(bits)).otherwise(0)).alias("mask"))


def with_labels(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds good (quality 1) and toxic (toxic 1); a document labelled more than once has what any label says, one
    without labels has neither."""
    known = labels.filter("quality = 1 or toxic = 1").groupBy("doc_id").agg(
        *[F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic"))])
    return masks.join(known, "doc_id", "left").select(
        "part", "mask", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])


@cache
def orders(n: int) -> np.ndarray:
    return np.array(list(permutations(range(n))))


@cache
def packed(n: int, mask: int, good: bool, toxic: bool) -> int:
    """The outcomes of one document under all orders of n filters, 64 bits each."""
    fails = mask >> orders(n) & 1
    before = np.cumsum(fails, axis=1) - fails
    removed = (fails == 1) & (before == 0)
    only = np.equal(mask, 1 << orders(n))
    fields = [before + fails == 0, removed, (fails == 1) & (before > 0), only, removed & good, removed & toxic]
    return int.from_bytes(np.stack(fields, axis=-1).astype("<u8").tobytes(), "little")


def unpack(total: int, n: int) -> np.ndarray:
    """Counts by order, step and outcome."""
    size = orders(n).size * len(OUTCOMES)
    return np.frombuffer(total.to_bytes(size * 8, "little"), "<u8").reshape(-1, n, len(OUTCOMES)).astype(np.int64)


def audit(marked: DataFrame, names: str = "ABCDE") -> DataFrame:
    """One row for each part, order of the filters and step, from rows of (part, mask, good, toxic).

    Rows of one part and mask are counted before the shuffle, so a part's group has four rows a mask at most,
    whatever its size. `shapley`: documents the step's filter removes, added up over all orders. Parts without
    documents do not appear; an empty table gives no rows. All n! orders are spelled out: meant for few filters.
    """
    n = len(names)
    counts = marked.groupBy("part", "mask", "good", "toxic").agg(F.count(F.lit(1)).alias("n"))

    def report(key: tuple, table: pa.Table) -> pa.Table:
        total = sum(count * packed(n, mask, good, toxic) for mask, good, toxic, count in zip(
            *[table.column(c).to_pylist() for c in ("mask", "good", "toxic", "n")], strict=True))
        fields = unpack(total, n)
        removed = np.zeros(n, np.int64)
        np.add.at(removed, orders(n), fields[:, :, OUTCOMES.index("removed")])
        steps = orders(n).size
        flat = fields.reshape(steps, -1)
        return pa.table({
            "part": pa.array([key[0].as_py()] * steps, pa.string()),
            "filter_order": ["".join(names[k] for k in order) for order in orders(n) for _ in range(n)],
            "step": pa.array(np.tile(np.arange(1, n + 1), steps // n), pa.int32()),
            **{name: flat[:, i] for i, name in enumerate(OUTCOMES)}, "shapley": removed[orders(n).ravel()]})

    return counts.groupBy("part").applyInArrow(report, _REPORT)
