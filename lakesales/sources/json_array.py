"""Files that hold one JSON array of objects, read in splits.

A file is cut at every closing brace, which a split can find by itself. Whether such a brace ends an element of the
array depends on the quotes and brackets before it: each split sums up its own, once for a start outside of any string
and once for a start inside one, and the sums are carried over the splits of a file.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lakesales.session import scratch_path
from lakesales.sources.sinks import write_table
from lakesales.sources.splits import PARTS, SPLIT, SPLIT_TYPES, assemble, before, in_splits, put_together, runs, with_splits


def _depth(text: Column) -> Column:
    """Opening less closing braces and brackets."""
    return F.length(F.translate(text, "}]", "")) - F.length(F.translate(text, "{[", ""))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Texts up to closing braces, with them, and their effect: ``_p`` is 1 for an odd number of quotes, ``_d0`` and
    ``_d1`` the change of depth from outside and from inside a string."""
    raw = in_splits(spark.read.text(path, lineSep="}"))
    # an escape is a backslash and one more character and never holds a brace, so no cut parts it
    parts = F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"', -1)
    odd = (F.size(parts) - 1) % 2

    def change(inside: int) -> Column:
        outer = F.array_join(F.filter(parts, lambda _, i: i % 2 == inside), "")
        return _depth(outer) - F.when(odd == inside, 1).otherwise(0)

    return raw.select(*SPLIT, odd.alias("_p"), change(0).alias("_d0"), change(1).alias("_d1"),
                      F.concat("value", F.lit("}")).alias("value"))


def _along(rows: pa.RecordBatch, inside: int, depth: int) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Whether each piece begins inside a string, its depth there, and both behind the last piece."""
    p, d0, d1 = (rows.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("_p", "_d0", "_d1"))
    strings = (inside + np.concatenate([[0], np.cumsum(p)])) % 2
    depths = depth + np.concatenate([[0], np.cumsum(np.where(strings[:-1] == 0, d0, d1))])
    return strings[:-1], depths[:-1], int(strings[-1]), int(depths[-1])


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each split its quotes, odd or even, and its change of depth from outside and from inside a string."""
    ends = [(0, 0), (1, 0)]
    for split, rows, last in runs(batches):
        if rows is not None:
            ends = [_along(rows, *end)[2:] for end in ends]
        if last:
            yield pa.RecordBatch.from_pylist([{**split, "_p": ends[0][0], "_in0": ends[0][1], "_in1": ends[1][1]}])
            ends = [(0, 0), (1, 0)]


def _carried(effects: DataFrame) -> DataFrame:
    """For each split the state it begins in: inside a string or not, and how deep; and whether it ends its file."""
    state = effects.withColumn("_s", before(F.sum("_p")) % 2)
    change = F.when(F.col("_s") == 0, F.col("_in0")).otherwise(F.col("_in1"))
    end = W.partitionBy("_file").orderBy(F.desc("_block"))
    return state.select(*SPLIT, "_s", before(F.sum(change)).alias("_depth"), (F.row_number().over(end) == 1).alias("_end"),
                        F.lit(0).alias("_shift"))


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of each split put together to elements, see ``splits.put_together``."""
    def cut() -> Iterator[tuple]:
        state = None
        for split, rows, last in runs(batches, [*SPLIT, "_s", "_depth", "_end", "_shift"]):
            if rows is not None:
                inside, depth, *state = _along(rows, *(state or (split["_s"], split["_depth"])))
                yield split, rows.column("value"), (inside == 0) & (depth <= 1), last
            else:
                yield split, None, None, last
                state = None
    return put_together(cut(), "", "_end")


def read_array(spark: SparkSession, path: str) -> DataFrame:
    """(_file, texto): the text of every element of the arrays in ``path``, one array a file.

    Elements are objects. Whatever else stands in a file (another element, an element that is cut off) comes as a text
    that is no object, so it is refused on parsing and never lost; so does the last element of a file without its end.
    The files are read twice and no piece is shuffled, see ``splits``; no task holds more than the elements of a batch.
    """
    pieces = _pieces(spark, path)
    effects = pieces.drop("value").mapInArrow(_effects, f"{SPLIT_TYPES}, _p bigint, _in0 bigint, _in1 bigint")
    carried = write_table(_carried(write_table(effects, scratch_path(spark, "effects"))), scratch_path(spark, "carried"))
    parts = with_splits(pieces, carried).mapInArrow(_elements, PARTS)
    parts = write_table(parts, scratch_path(spark, "records"))
    # which elements begin is known only now: those at the ends are numbered over the splits of their file
    last = parts.where("not _whole").groupBy("_file", "_block").agg(F.max("_record").alias("_many"))
    shifts = last.select("_file", "_block", before(F.sum("_many")).alias("_shift"))
    ends = parts.where("not _whole").join(shifts, ["_file", "_block"]).withColumn("_record", F.col("_shift") + F.col("_record"))
    texts = assemble(parts.where("_whole").unionByName(ends.drop("_shift")), "").select(
        "_file", F.regexp_replace("texto", r"^[\s\uFEFF]*[\[,]?\s*", "").alias("texto"))
    return texts.where(~F.col("texto").rlike(r"^\s*\]?\s*$"))
