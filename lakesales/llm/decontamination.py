"""Benchmark decontamination: rare n-grams seed passages, Smith-Waterman alignment scores them.

The n-grams are pairs of words that stand one or two places apart. Between two words of an alignment that follow each
other in it lie no edits (worth 2 points), one (1 point) or more (none). So a score of G takes G - 2 points of such
pairs, each place of the item giving 2 at most, inside as many words as such an alignment can be long. An item's places
are ranked by how often the whole corpus holds their pairs; the most frequent ones are set aside, for up to half of
those points, and the rare rest are its seeds: no passage over the goal is without the points that are left, whatever
was replaced, left out or added.

Every step is a table: pairs of items, their counts over all documents, seeds, places of seeds in documents joined to
items by a shuffle, windows with enough points, their alignments. Documents are read the same few times whatever the
number of test items, and the driver sees no item and no document, only a bitmap of at most 16 MB.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakesales.llm.common import MARKS, Words, chunks, cut, gram_hashes, pair_hashes, signed, words_of_column

#: A passage leaks if its score is this part of the item's own score, or that of so many equal words in a row.
#: No score under FLOOR is enough: for it a short item needs a larger part of its own score, up to all of it.
PART, ENOUGH_WORDS, FLOOR = 0.4, 40, 13
MATCH, MISMATCH, GAP = 2, -1, -1
#: Part of the points of a passage that may lie in an item's most frequent pairs, which seed nothing.
ASIDE = 0.5
#: Cells of alignments that are worked on at once.
CELLS = 1 << 21
#: Bits of the bitmap that tells which pairs of documents are sent on: 2**23 to 2**27, a larger one drops more.
SIEVE_BITS = (23, 27)
_NAME = ["_name1", "_name2"]
_ITEM = ["item_id", "item"]


def plain_words(column: pa.Array) -> Words:
    """Words without case and marks."""
    return words_of_column(pc.utf8_lower(column), breaks=MARKS)


def goals(size: np.ndarray) -> np.ndarray:
    """The smallest score, a whole number, with which items of so many words leak."""
    least = np.maximum(PART * MATCH * size, np.minimum(MATCH * size, FLOOR))
    return np.ceil(np.minimum(least, MATCH * ENOUGH_WORDS)).astype(np.int64)


def pairs(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word, hash and nearness of all pairs of words one or two places apart within a text."""
    at, gram, near = [], [], []
    for apart in (1, 2):
        hashes = pair_hashes(words.hash, apart)
        whole = np.ones(len(hashes), bool)
        for back in range(1, apart + 1):  # the last words of each text
            last = words.first[1:] - back
            whole[last[(last >= 0) & (last < len(hashes))]] = False
        at.append(np.flatnonzero(whole)), gram.append(hashes[whole]), near.append(np.full(len(at[-1]), apart == 1))
    return tuple(np.concatenate(x) for x in (at, gram, near))


def align(items: np.ndarray, passages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman of one item with many passages of one width, or of as many items of one length, one a passage:
    best scores and the words where they end. A row of the table is done for all passages at once; gaps along the row
    are a running maximum."""
    n, width = passages.shape
    above = np.zeros((n, width + 1), np.int32)
    best, where = np.zeros(n, np.int32), np.zeros(n, np.int64)
    slope = np.arange(width + 1, dtype=np.int32) * -GAP
    for word in np.atleast_2d(items).T:
        row = np.zeros((n, width + 1), np.int32)
        step = np.where(passages == word[:, None], MATCH, MISMATCH)
        np.maximum(above[:, :-1] + step, above[:, 1:] + GAP, out=row[:, 1:])
        np.maximum(row, 0, out=row)
        row = np.maximum.accumulate(row + slope, axis=1) - slope
        top = row.argmax(axis=1)
        value = row[np.arange(n), top]
        better = value > best
        best[better], where[better] = value[better], top[better]
        above = row
    return best, where


# --- test items and their seeds ------------------------------------------------------------------------


def _item_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of every item; an item of one word has that word."""
    for batch in batches:
        for part in chunks(batch):
            words = plain_words(part.column("text"))
            size = np.diff(words.first)
            at, gram, near = pairs(words)
            lone = words.first[:-1][size == 1]
            at, near = np.append(at, lone), np.append(near, np.ones(len(lone), bool))
            gram = np.append(gram, gram_hashes(words.hash, 1)[lone])
            row = np.searchsorted(words.first, at, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [part.column("item_id").take(pa.array(row)), part.column("item").take(pa.array(row)),
                 pa.array(size[row]), pa.array(goals(size[row])), pa.array(at - words.first[row]),
                 pa.array(signed(gram)), pa.array(near)],
                ["item_id", "item", "size", "goal", "place", "gram", "near"])


def bits_for(number: int) -> int:
    """The bits of a bitmap for so many hashes, as a power of two."""
    return min(max((16 * number).bit_length(), SIEVE_BITS[0]), SIEVE_BITS[1])


def bitmap(hashes: DataFrame, column: str, bits: int) -> DataFrame:
    """bucket, bitmap: which slots of 2**bits the hashes fall into; at most 2**(bits - 15) rows of 4 KB."""
    slot = hashes.select((F.shiftrightunsigned(column, 64 - bits) + 1).alias("slot"))
    return slot.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bitmap"))


def likely(docs: DataFrame, hashes: Column, among: DataFrame, column: str, how: str) -> DataFrame:
    """left_semi: rows whose hash may be among others; left_anti: those whose hash is certainly not. Only a bitmap of
    bounded size is broadcast and no row is moved."""
    bits = bits_for(among.count())
    found = cut(bitmap(among, column, bits), "bitmap")
    slot = F.shiftrightunsigned(hashes, 64 - bits) + 1
    place = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring(found["bitmap"], F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10)
    inside = F.getbit(byte.cast("bigint"), (place % 8).cast("int")) == 1
    return docs.join(F.broadcast(found), (F.bitmap_bucket_number(slot) == found["bucket"]) & inside, how)


class Sieve:
    """A bitmap over hashes of pairs, of bounded size: what it lets through is looked up by a join."""

    def __init__(self, grams: DataFrame, number: int, lone: bool):
        self.bits, self.lone = bits_for(number), lone
        self.map = np.zeros((1 << self.bits - 15, 4096), np.uint8)
        for r in bitmap(grams, "gram", self.bits).collect():
            self.map[r["bucket"] - 1] = np.frombuffer(r["bitmap"], np.uint8)
        self.map = self.map.ravel()

    def passes(self, grams: np.ndarray) -> np.ndarray:
        slot = (grams >> np.uint64(64 - self.bits)).astype(np.int64)
        return np.flatnonzero(self.map[slot >> 3] >> (slot & 7).astype(np.uint8) & 1)

    def hits(self, words: Words) -> tuple[np.ndarray, ...]:
        """Text, word in it, hash and nearness of the pairs of some texts that pass; single words, where there are
        items of one word, once a text."""
        at, gram, near = pairs(words)
        some = self.passes(gram)
        at, gram, near = at[some], gram[some], near[some]
        text = np.searchsorted(words.first, at, "right") - 1
        if self.lone:
            single = gram_hashes(words.hash, 1)
            some = self.passes(single)
            owner = np.searchsorted(words.first, some, "right") - 1
            order = np.lexsort((some, single[some], owner))
            some, owner = some[order], owner[order]
            new = np.ones(len(some), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (single[some][1:] != single[some][:-1])
            some, owner = some[new], owner[new]
            at, text, gram = np.append(at, some), np.append(text, owner), np.append(gram, single[some])
            near = np.append(near, np.ones(len(some), bool))
        return text, at - words.first[text], gram, near


def _count(sieve):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                gram, many = np.unique(sieve.value.hits(plain_words(part.column("text")))[2], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(signed(gram)), pa.array(many)], ["gram", "n"])
    return count


def rare_seeds(grams: DataFrame, counts: DataFrame) -> DataFrame:
    """item_id, item, gram, near, need, span, room: the pairs that are looked up for each item, and the points that a
    passage has of them. Of the places of an item the most frequent in the corpus are set aside, as many as ASIDE
    of the points allow; pairs that no document holds seed nothing."""
    known = grams.join(counts, "gram", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    often = Window.partitionBy(*_ITEM, "place")
    rank = Window.partitionBy(*_ITEM).orderBy(F.desc("often"), "place")
    allowed = F.floor((F.col("goal") - MATCH) * ASIDE / MATCH)
    known = (known.withColumn("often", F.sum("n").over(often)).withColumn("rank", F.dense_rank().over(rank))
             .withColumn("aside", (F.col("rank") <= allowed) & (F.col("often") > 0)))
    away = F.coalesce(F.max(F.when(F.col("aside"), F.col("rank"))).over(Window.partitionBy(*_ITEM)), F.lit(0))
    span = 3 * F.col("size") - F.col("goal")
    return (known.withColumn("away", away).filter(~F.col("aside") & (F.col("n") > 0))
            .groupBy(*_ITEM, "gram").agg(
                F.max("near").alias("near"),
                F.max(F.greatest(F.lit(1), F.col("goal") - MATCH - MATCH * F.col("away"))).alias("need"),
                F.max(span).alias("span"), F.max(F.when(F.col("away") > 0, span).otherwise(0)).alias("room")))


# --- passages --------------------------------------------------------------------------------------------


def _hits(sieve):
    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                text, at, gram, near = sieve.value.hits(plain_words(part.column("text")))
                name = [part.column(n).take(pa.array(text)) for n in _NAME]
                yield pa.RecordBatch.from_arrays([*name, pa.array(at), pa.array(signed(gram)), pa.array(near)],
                                                 [*_NAME, "at", "gram", "near"])
    return hits


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All stretches of a text with the points an item needs; those that overlap are one."""
    for batch in batches:
        points = batch.column("points")
        need, span, room = (batch.column(c).to_numpy() for c in ("need", "span", "room"))
        row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(points).to_numpy(zero_copy_only=False))
        code = points.flatten().to_numpy()
        order = np.lexsort((code, row))
        row, code = row[order], code[order]
        most = np.ones(len(code), bool)  # the most points of a word
        most[:-1] = (row[1:] != row[:-1]) | (code[1:] >> 1 != code[:-1] >> 1)
        row, at, worth = row[most], code[most] >> 1, (code[most] & 1) + 1
        total = np.append(0, np.cumsum(worth))
        base = row << 40
        end = np.searchsorted(base + at, base + at + span[row])
        full = np.flatnonzero(total[end] - total[:-1] >= need[row])
        row, end = row[full], end[full]
        lo, hi = np.maximum(at[full] - room[row], 0), at[end - 1] + 3 + room[row]
        new = np.ones(len(full), bool)
        new[1:] = (row[1:] != row[:-1]) | (lo[1:] >= hi[:-1])
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(full))[:len(head)] - 1
        keys = [batch.column(c).take(pa.array(row[head])) for c in (*_NAME, *_ITEM)]
        yield pa.RecordBatch.from_arrays([*keys, pa.array(lo[head]), pa.array(hi[tail])], [*_NAME, *_ITEM, "lo", "hi"])


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cuts the windows out of their texts."""
    for batch in batches:
        for part in chunks(batch):
            words = words_of_column(part.column("text"), breaks=MARKS)
            spans = part.column("spans")
            row = np.repeat(np.arange(part.num_rows), pc.list_value_length(spans).to_numpy(zero_copy_only=False))
            spans = spans.flatten()
            lo = spans.field("lo").to_numpy()
            first = words.first[row] + lo
            last = np.minimum(words.first[row] + spans.field("hi").to_numpy(), words.first[row + 1]) - 1
            cuts = [words.data[a:b].tobytes().decode() for a, b in zip(words.start[first], words.end[last], strict=True)]
            name = [part.column(n).take(pa.array(row)) for n in _NAME]
            yield pa.RecordBatch.from_arrays(
                [*name, *(spans.field(c) for c in _ITEM), pa.array(lo), pa.array(cuts, pa.string())],
                [*_NAME, *_ITEM, "lo", "passage"])


def _table(words: Words, row: np.ndarray, size: np.ndarray, pad: int, back: bool = False) -> np.ndarray:
    """The first `size` words of some texts, forwards or backwards, filled up to one width."""
    place = np.arange(int(size.max()))
    at = words.first[row][:, None] + (size[:, None] - 1 - place if back else place)
    inside = place < size[:, None]
    return np.where(inside, words.hash[np.where(inside, at, 0)], np.uint64(pad))


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Aligns items with passages, those of like sizes together, as many as the table has room for."""
    for batch in batches:
        for part in chunks(batch, "passage"):
            items, body = plain_words(part.column("item_text")), plain_words(part.column("passage"))
            long, width = np.diff(items.first), np.diff(body.first)
            goal, lo = goals(long), part.column("lo").to_numpy()
            own = words_of_column(part.column("passage"), breaks=MARKS)
            rest = np.lexsort((width, long))
            rest = rest[(width[rest] > 0) & (long[rest] > 0)]
            found = [[], [], [], [], []]
            while len(rest):
                fit = max(1, int(np.searchsorted(np.maximum.accumulate(width[rest]) * np.arange(1, len(rest) + 1), CELLS)))
                some, rest = rest[:fit], rest[fit:]
                score, end = align(_table(items, some, long[some], 1), _table(body, some, width[some], 0))
                good = score >= goal[some]
                some, score, end = some[good], score[good], end[good]
                if len(some):
                    _, size = align(_table(items, some, long[some], 1, True), _table(body, some, end, 0, True))
                    for column, value in zip(found, (some, score / (MATCH * long[some]), end - size, end, lo[some]),
                                             strict=True):
                        column.append(value)
            if not found[0]:
                continue
            row, score, first, end, lo = (np.concatenate(x) for x in found)
            cuts = [own.data[own.start[a]:own.end[b - 1]].tobytes().decode()
                    for a, b in zip(own.first[row] + first, own.first[row] + end, strict=True)]
            keys = [part.column(c).take(pa.array(row)) for c in (*_NAME, *_ITEM)]
            yield pa.RecordBatch.from_arrays(
                [*keys, pa.array(score), pa.array(lo + first), pa.array(lo + end), pa.array(cuts, pa.string())],
                [*_NAME, *_ITEM, "score", "first_word", "end_word", "passage"])


def _named(text) -> list:
    """Two independent 64-bit hashes that name a text: equal texts are worked on once."""
    return [F.xxhash64(text), F.xxhash64(F.lit("text"), text)]


def text_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """_name1, _name2, item_id, item, score, first_word, end_word, passage: the best alignment of every different text
    and test item that counts; a stored table."""
    spark = docs.sparkSession
    names = ", ".join(f"{n} bigint" for n in _NAME)
    tests = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.xxhash64("text").alias("item"), "text")
    tests = cut(tests.filter("text is not null").distinct(), "test-items")
    grams = cut(tests.mapInArrow(_item_grams, "item_id bigint, item bigint, size bigint, goal bigint, place bigint, "
                                              "gram bigint, near boolean"), "item-grams")
    number, lone = grams.agg(F.count("*"), F.coalesce(F.max(F.col("size") == 1), F.lit(False))).first()
    texts = docs.select(*(c.alias(n) for c, n in zip(_named(F.col(text)), _NAME, strict=True)), F.col(text).alias("text"))
    # counts of items' pairs over all documents, then what is rare
    sieve = spark.sparkContext.broadcast(Sieve(grams, number, lone))
    counts = texts.select("text").mapInArrow(_count(sieve), "gram bigint, n bigint").groupBy("gram").agg(
        F.sum("n").alias("n"))
    seeds = cut(rare_seeds(grams, counts), "seeds")
    sieve = spark.sparkContext.broadcast(Sieve(seeds, seeds.count(), lone))
    # places of seeds in documents, joined to items
    hits = texts.mapInArrow(_hits(sieve), f"{names}, at bigint, gram bigint, near boolean")
    seed = seeds.withColumnRenamed("near", "item_near")
    points = F.col("at") * 2 + (F.col("near") & F.col("item_near")).cast("bigint")
    met = (hits.join(seed, "gram").groupBy(*_NAME, *_ITEM)
           .agg(F.collect_set(points).alias("points"), *(F.max(c).alias(c) for c in ("need", "span", "room")))
           .filter(F.size("points") * 2 >= F.col("need")))
    windows = cut(met.mapInArrow(_windows, f"{names}, item_id bigint, item bigint, lo bigint, hi bigint"), "windows")
    # their texts, and alignments
    spans = windows.groupBy(*_NAME).agg(F.collect_list(F.struct(*_ITEM, "lo", "hi")).alias("spans"))
    some = likely(texts, texts[_NAME[0]], windows, _NAME[0], "left_semi")
    passages = some.join(spans, _NAME).mapInArrow(
        _passages, f"{names}, item_id bigint, item bigint, lo bigint, passage string")
    scored = (passages.dropDuplicates([*_NAME, *_ITEM, "lo"])
              .join(tests.withColumnRenamed("text", "item_text"), _ITEM).mapInArrow(
                  _score, f"{names}, item_id bigint, item bigint, score double, first_word bigint, end_word bigint, "
                          "passage string"))
    best = scored.groupBy(*_NAME, *_ITEM).agg(
        F.max(F.struct("score", (-F.col("first_word")).alias("before"), "end_word", "passage")).alias("best"))
    return cut(best.select(*_NAME, *_ITEM, "best.score", (-F.col("best.before")).alias("first_word"), "best.end_word",
                           "best.passage"), "leaks")


def find_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, item_id, score, first_word, end_word, passage: the best alignment of every document and test item
    whose score is at least PART of the item's own score, or that of ENOUGH_WORDS equal words, and FLOOR or the
    item's whole own score: items up to 6 words are found only where all their words stand in a row.

    Words are runs of what is neither ASCII white space nor an ASCII mark, in lower case. Null and
    empty texts leak nothing, null items and those without words are found nowhere; equal test rows count once;
    repeated documents are reported as often as they stand there; extra columns of either table are ignored, whatever
    their names; an empty table on either side gives no rows. Texts and items count whole: a long text is aligned in
    windows of a few times the item, so a long item takes that much of it at once. Seeds, windows and leaks are written
    to the shared folder when this is called.
    """
    leaks = text_leaks(docs, benchmark, text)
    named = docs.select(F.col(key).alias("doc_id"), *(c.alias(n) for c, n in zip(_named(F.col(text)), _NAME, strict=True)))
    return named.join(leaks, _NAME).select("doc_id", "item_id", "score", "first_word", "end_word", "passage")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose text holds no test item, as they are. Null and empty texts stay, and all rows where the benchmark
    is empty; leaks are found as by find_leaks, extra columns may have any names. Rows whose text is no leak by a bitmap
    of leaking texts are not moved."""
    leaks = text_leaks(docs, benchmark, text).select(*_NAME).distinct()
    one, two = _named(docs[text])
    clean = likely(docs, one, leaks, _NAME[0], "left_anti")
    unsure = likely(docs, one, leaks, _NAME[0], "left_semi")
    return clean.union(
        unsure.join(leaks, (one == leaks[_NAME[0]]) & (two == leaks[_NAME[1]]), "left_anti"))
