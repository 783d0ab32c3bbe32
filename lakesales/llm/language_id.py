"""Language identification by rank-order profiles.

A profile is the list of a language's most frequent letter n-grams, the most frequent first. A document's own list
is held against each profile: every n-gram counts the distance between its two ranks, one that the profile lacks
counts the most. The language with the smallest sum wins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakesales.llm.common import chunks

#: Letters of an n-gram (a word has a blank on either side), and ranks of a profile and of a document.
GRAM_SIZES, RANKS = (1, 2, 3), 300
#: Characters that are worked on at once.
_CHARS = 1 << 20
_BITS = np.uint64(21)  # a character; three of them fill 63 bits
_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """All letter n-grams of a text in lower case, as numbers, and how often each is there."""
    grams, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    lo = 0
    while lo < len(text):
        hi = min(lo + _CHARS, len(text))
        if hi < len(text):  # end between two words if there is such a place
            gap = max(text.rfind(" ", lo, hi), text.rfind("\n", lo, hi))
            hi = gap + 1 if gap >= lo else hi
        code = np.frombuffer(text[lo:hi].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letter_table()[code]
        code = np.where(letter, code, 32).astype(np.uint64)
        # one blank between words and at both ends
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        code = np.concatenate([[np.uint64(32)], code[keep], [np.uint64(32)]])
        if len(code) > 1 and code[1] == 32:
            code = code[1:]
        if len(code) > 1 and code[-2] == 32:
            code = code[:-1]
        lo = hi
        if len(code) < 3:
            continue
        found = [code[code != 32]]
        for n in GRAM_SIZES[1:]:
            gram = np.zeros(len(code) - n + 1, np.uint64)
            for k in range(n):
                gram = (gram << _BITS) | code[k:len(code) - n + 1 + k]
            if n > 2:  # no blank inside
                gram = gram[code[1:len(code) - n + 2] != 32]
            found.append(gram)
        new, times = np.unique(np.concatenate(found), return_counts=True)
        if len(grams):
            new, place = np.unique(np.concatenate([grams, new]), return_inverse=True)
            times = np.bincount(place, np.concatenate([counts, times])).astype(np.int64)
        grams, counts = new, times
    return grams, counts


def ranked(grams: np.ndarray, counts: np.ndarray, ranks: int = RANKS) -> np.ndarray:
    """The most frequent n-grams, ties by the n-gram itself."""
    if len(grams) > 4 * ranks:
        floor = np.partition(counts, len(counts) - ranks)[len(counts) - ranks]
        grams, counts = grams[counts >= floor], counts[counts >= floor]
    return grams[np.lexsort((grams, -counts))[:ranks]]


def learn_profiles(docs: DataFrame, ranks: int = RANKS, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, gram, rank) from all texts with a language. Counts are added up inside each task first."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def merged(name: str) -> tuple[np.ndarray, np.ndarray]:
            grams, place = np.unique(np.concatenate([g for g, _ in held[name]]), return_inverse=True)
            return grams, np.bincount(place, np.concatenate([c for _, c in held[name]])).astype(np.int64)

        for batch in batches:
            for part in chunks(batch):
                for name, body in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
                    held.setdefault(name, []).append(gram_counts(body))
                for name in held:
                    held[name] = [merged(name)]
        for name in held:
            grams, counts = merged(name)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(grams), pa.string()),
                                              "gram": pa.array(grams.view(np.int64)), "n": pa.array(counts)})

    known = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    sums = known.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return sums.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= ranks).select(
        "lang", "gram", "rank")


class Profiles:
    """All profiles as one table: ranks[g, l] of n-gram grams[g] in language langs[l], `far` where it lacks it."""

    def __init__(self, rows: list, ranks: int = RANKS):
        self.far = ranks
        self.langs = sorted({r["lang"] for r in rows})
        self.grams = np.array(sorted({r["gram"] for r in rows}), np.int64).view(np.uint64)
        column = {name: i for i, name in enumerate(self.langs)}
        # the last row: n-grams of no profile
        self.ranks = np.full((len(self.grams) + 1, len(self.langs)), -1, np.int32)
        at = np.searchsorted(self.grams, np.array([r["gram"] for r in rows], np.int64).view(np.uint64))
        self.ranks[at, [column[r["lang"]] for r in rows]] = [r["rank"] - 1 for r in rows]

    def judge(self, text: str | None) -> tuple[str, float]:
        grams, counts = gram_counts(text or "")
        if not len(grams) or not self.langs:
            return "und", 0.0
        own = ranked(grams, counts, self.far)
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        at[self.grams[at] != own] = len(self.grams)
        there = self.ranks[at]
        apart = np.where(there < 0, self.far, np.abs(there - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(np.argmin(apart))
        return self.langs[best], 1.0 - float(apart[best]) / (self.far * len(own))


def identify(docs: DataFrame, profiles: DataFrame, ranks: int = RANKS, key: str = "doc_id",
             text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text; score: 1 - distance / largest possible distance.

    `und` with score 0 where a text is null, empty or has no letter, and where nothing was learned. Ties go to the
    first language by name. Repeated rows return as often as they stand there; extra columns are ignored; an empty
    table gives no rows. Profiles reach the tasks whole: `ranks` rows a language.
    """
    table = Profiles(profiles.collect(), ranks)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                found = [table.judge(x) for x in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"), "lang_pred": pa.array([f[0] for f in found], pa.string()),
                    "score": pa.array([f[1] for f in found], pa.float64())})

    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        predict, f"doc_id {dict(docs.dtypes)[key]}, lang_pred string, score double")


def keep_known(docs: DataFrame, profiles: DataFrame, least_score: float, ranks: int = RANKS,
               text: str = "text") -> DataFrame:
    """The rows whose text is in one of the languages, as they are: not `und`, and a score of at least
    `least_score`. Decided row by row, in one pass without a shuffle."""
    table = Profiles(profiles.collect(), ranks)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text):
                found = [table.judge(x) for x in part.column(text).to_pylist()]
                yield part.filter(pa.array([name != "und" and score >= least_score for name, score in found]))

    return docs.mapInArrow(keep, docs.schema)
