"""How the vocabulary of each source differs from that of its language and of the language's other sources.

Terms with the same two counts are one cell: the measure is evaluated once a cell, cells are ranked by value with the
number of terms up to each of them, and only the cells that reach the report are turned back into terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakesales.llm.common import _LOWER, chunks, cut, parts_for, text_buffers

#: Bytes of text whose terms are counted together before they leave a task.
COUNTED_BYTES = 8 << 20
#: Rows of (source, term, count) that one task compares, and cells of one matrix of terms by sources.
BUCKET_ROWS, MATRIX_CELLS = 250_000, 1 << 21
#: Shares are whole numbers of this many parts.
SCALE = 1_000_000_000
_LETTER = np.ones(256, bool)
_LETTER[:128] = False
_LETTER[65:91] = _LETTER[97:123] = True
_COUNTS = "lang string, source string, term string, n bigint, docs bigint"


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term, and rows of the group that hold it. A term: a run of
    ASCII letters and characters beyond ASCII, A-Z lower-cased. A row with an empty term and no counts stands for each
    group, so groups without terms are there too. Null text, lang and source count as empty. Rows are counted as they
    stand, whatever ids they have; other columns are ignored."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, limit=COUNTED_BYTES):
                yield _count(part)

    text, lang, source = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source"))
    found = docs.select(text, lang, source).mapInArrow(count, _COUNTS)
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _count(part: pa.RecordBatch) -> pa.RecordBatch:
    data, offsets = text_buffers(part.column("text"))
    data, offsets = data[offsets[0]:offsets[-1]], offsets - offsets[0]
    inside = _LETTER[data]
    left = inside.copy()
    left[1:] &= ~inside[:-1]
    heads = np.unique(offsets[:-1][np.diff(offsets) > 0])
    left[heads] = inside[heads]
    start = np.flatnonzero(left)
    letters = np.append(0, np.cumsum(inside))
    terms = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(np.append(letters[start], letters[-1])),
                                             pa.py_buffer(_LOWER[data[inside]])).dictionary_encode()
    code = terms.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    width = max(1, len(terms.dictionary))
    row = np.repeat(np.arange(part.num_rows), np.diff(np.searchsorted(start, offsets)))
    lang, source = (part.column(c).dictionary_encode() for c in ("lang", "source"))
    sources = len(source.dictionary)
    group = lang.indices.to_numpy().astype(np.int64) * sources + source.indices.to_numpy()
    in_row, times = np.unique(row * width + code, return_counts=True)
    cell, place = np.unique(group[in_row // width] * width + in_row % width, return_inverse=True)
    n = np.zeros(len(cell), np.int64)
    np.add.at(n, place, times)
    seen = np.unique(group)
    where = np.concatenate([seen, cell // width])
    names = pa.concat_arrays([pa.array([""] * len(seen), pa.large_string()), terms.dictionary.take(pa.array(cell % width))])
    zeros = np.zeros(len(seen), np.int64)
    return pa.RecordBatch.from_pydict({
        "lang": lang.dictionary.take(pa.array(where // sources)), "source": source.dictionary.take(pa.array(where % sources)),
        "term": names.cast(pa.string()), "n": np.concatenate([zeros, n]),
        "docs": np.concatenate([zeros, np.bincount(place, minlength=len(cell)).astype(np.int64)])})


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)), exact: decimals hold what no long can."""
    wide = (count + F.lit(2)).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.lit(1).cast("bigint") + F.call_function("div", wide, (total + F.lit(2) * terms).cast("decimal(20,0)"))


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _pair_values(groups: pa.Table, kept: pa.Table) -> pa.Table:
    """For all pairs of sources of a language, the measure added up over the terms of one bucket, a cell at a time."""
    groups = groups.sort_by("source")
    sources = groups.column("source").combine_chunks()
    total, terms = groups.column("total").to_pylist(), groups.column("terms").to_pylist()
    coded = kept.column("term").combine_chunks().dictionary_encode()
    term = coded.indices.to_numpy(zero_copy_only=False)
    source = pc.index_in(kept.column("source").combine_chunks(), value_set=sources).to_numpy(zero_copy_only=False)
    count = kept.column("n").to_numpy()
    s, n_terms = len(sources), len(coded.dictionary)
    value = np.zeros((s, s), np.int64)
    step = max(1, MATRIX_CELLS // max(1, s))
    order = np.argsort(term, kind="stable")
    for lo in range(0, n_terms, step):
        rows = min(step, n_terms - lo)
        at = order[slice(*np.searchsorted(term[order], [lo, lo + rows]))]
        table = np.zeros((s, rows), np.int64)
        table[source[at], term[at] - lo] = count[at]
        different = [np.unique(row, return_inverse=True) for row in table]
        shares = [np.array([1 + SCALE * (c + 2) // (total[g] + 2 * terms[g]) for c in counts.tolist()], np.int64)
                  for g, (counts, _) in enumerate(different)]
        for g in range(s):
            for h in range(g + 1, s):
                p, q = shares[g], shares[h]
                cells = np.bincount(different[g][1] * len(q) + different[h][1]) if len(p) * len(q) <= 4 * rows else None
                if cells is None:
                    cell, many = np.unique(different[g][1] * len(q) + different[h][1], return_counts=True)
                else:
                    cell = np.flatnonzero(cells)
                    many = cells[cell]
                p, q = p[cell // len(q)], q[cell % len(q)]
                value[g, h] += int((many * ((p - q) * (p - q) // (p + q))).sum())
    one, other = np.triu_indices(s, 1)
    lang = groups.column("lang").combine_chunks().slice(0, 1).to_pylist() * len(one)
    return pa.table({"lang": pa.array(lang, pa.string()), "source": sources.take(pa.array(one)),
                     "item": sources.take(pa.array(other)), "value": value[one, other]})


def source_divergence(docs: DataFrame, least_docs: int = 10, top: int = 10) -> DataFrame:
    """Rows (lang, source, part, item, value, rank); see SCALE, share() and divergence().

    Terms in at least `least_docs` rows of a language count. Part `pair`: each other source of the language by its
    summed divergence over all these terms, every rank; 0 throughout where a language keeps no term. Part `term`: the
    terms that a source has a larger share of than its language, up to rank `top`. Equal values are ranked by the
    item's UTF-8 bytes. Null text, lang and source count as empty strings; repeated rows count as often as they stand
    there; an empty table gives no rows.

    Counts are added up in tasks before the shuffle; terms are dealt into buckets by hash for the pairs, whatever
    the size of a source or language; a pair's sums over the buckets are one row a bucket. The report itself has a row
    for every two sources of a language: meant for sources in thousands, not millions.
    """
    counts = cut(term_counts(docs), "counts")
    terms = counts.filter("term <> ''")
    common = terms.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("docs").alias("d")).filter(
        F.col("d") >= least_docs).drop("d")
    kept = cut(terms.join(common, ["lang", "term"]).select("lang", "source", "term", "n", "n_lang"), "kept")
    # a term of a language has one row here: the languages' totals
    of_lang = common.groupBy("lang").agg(F.sum("n_lang").alias("total_lang"), F.count(F.lit(1)).alias("terms"))
    of_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = cut(counts.filter("term = ''").select("lang", "source").join(of_group, ["lang", "source"], "left").join(
        of_lang, "lang", "left").fillna(0, ["total", "total_lang", "terms"]), "groups")
    both = _pairs(kept, groups).unionByName(_terms(kept, groups, top))
    return both.select("lang", "source", "part", "item", "value", "rank")


def _rank(df: DataFrame) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))))


def _pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    buckets = parts_for(kept.count(), BUCKET_ROWS, 1)
    each = groups.select("lang", "source", "total", "terms", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"))
    dealt = kept.select("lang", "source", "term", "n", F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int").alias("bucket"))
    found = each.groupBy("lang", "bucket").cogroup(dealt.groupBy("lang", "bucket")).applyInArrow(
        _pair_values, "lang string, source string, item string, value bigint")
    summed = found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    turned = summed.select("lang", "value", F.explode(F.array(
        F.struct(F.col("source").alias("source"), F.col("item").alias("item")),
        F.struct(F.col("item").alias("source"), F.col("source").alias("item")))).alias("x"))
    return _rank(turned.select("lang", "x.source", "x.item", "value")).withColumn("part", F.lit("pair"))


def _terms(kept: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    cells = kept.groupBy("lang", "source", "n", "n_lang").agg(F.count(F.lit(1)).alias("many")).join(
        groups, ["lang", "source"])
    p, q = share(F.col("n"), F.col("total"), F.col("terms")), share(F.col("n_lang"), F.col("total_lang"), F.col("terms"))
    valued = cells.withColumn("p", p).withColumn("q", q).filter("p > q").withColumn(
        "value", divergence(F.col("p"), F.col("q"))).select("lang", "source", "n", "n_lang", "value", "many")
    # equal values are one entry; each has a term at least, so the first `top` entries hold all ranks
    entries = valued.groupBy("lang", "source", "value").agg(F.sum("many").alias("many"))
    group = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    first = entries.withColumn("entry", F.row_number().over(group)).filter(F.col("entry") <= top)
    reached = first.withColumn("above", F.sum("many").over(group.rowsBetween(Window.unboundedPreceding, -1))).filter(
        F.coalesce("above", F.lit(0)) < top).select("lang", "source", "value")
    chosen = valued.drop("many").join(reached, ["lang", "source", "value"])
    listed = kept.join(chosen, ["lang", "source", "n", "n_lang"]).select("lang", "source", F.col("term").alias("item"), "value")
    return _rank(listed).filter(F.col("rank") <= top).withColumn("part", F.lit("term"))
