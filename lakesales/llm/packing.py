"""Best-fit packing by a grouping genetic algorithm on islands.

Documents are cut into pieces of at most `capacity` tokens. Full pieces are sequences already. The rest is dealt
into blocks of about BLOCK pieces. Islands breed packings of one block apart from each other: a crossover injects
whole well-filled bins of one packing into another, drops the bins that now hold a piece twice, and best-fits the
pieces that lost their place. Between rounds the best packing of each island migrates to the next one. The least
filled bins of every block are then opened and dealt into new blocks, until one block is left. So a block is bred
for few bins and then for little room lost in those that stay closed: what its opened bins have in room, a later
level fills.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakesales.llm.common import chunks, cut
from lakesales.llm.tokens import encoder

#: Pieces a block, islands a block, rounds between migrations, generations a round, packings an island.
BLOCK, ISLANDS, ROUNDS, GENERATIONS, PACKINGS = 2000, 3, 2, 6, 4
#: Bins of each block that are opened again for the next level.
OPENED = 8
_PIECE = "block bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
_PLACED = _PIECE + ", bin bigint, offset bigint, opened boolean"


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """Tokenises whole texts (null: empty), adds the end id and cuts what is longer than `capacity`.

    block: where a piece is packed, below 0 for a full piece, which is a sequence of its own. Blocks are filled in
    the order of reading, so none grows with a hot key.
    """
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, room, block, full = TaskContext.get().partitionId(), 0, -1, 0
        for batch in batches:
            for part in chunks(batch):
                ids, offsets = encoder(tokenizer).encode(part.column("text"), end_id)
                little = ids.astype("<u4")
                out = []
                for doc, lo, hi in zip(part.column("doc_id").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(),
                                       strict=True):
                    for n, at in enumerate(range(lo, hi, capacity)):
                        size = min(capacity, hi - at)
                        if size == capacity:
                            full += 1
                            own = -((task << 36) + full)
                        else:
                            if not room:
                                block, room = block + 1, BLOCK
                            room -= 1
                            own = (task << 20) + block
                        out.append((own, doc, n, at - lo, size, zlib.crc32(little[at:at + size].tobytes())))
                if out:
                    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)],
                        ["block", "doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(pieces, _PIECE)


# --- one block ---------------------------------------------------------------------------------------


def best_fit(sizes: list[int], order: list[int], capacity: int, bins: list[list[int]]) -> list[list[int]]:
    """Puts the pieces of `order` one by one into the fullest bin with room, or a new one; changes `bins`."""
    gaps = sorted([(capacity - sum([sizes[i] for i in b]), n) for n, b in enumerate(bins)])
    for i in order:
        at = bisect_left(gaps, (sizes[i], -1))
        if at < len(gaps):
            gap, n = gaps.pop(at)
            bins[n].append(i)
        else:
            gap, n = capacity, len(bins)
            bins.append([i])
        insort(gaps, (gap - sizes[i], n))
    return bins


def lost_room(sizes: list[int], bins: list[list[int]], capacity: int) -> int:
    """Tokens of room in the bins that are not opened again: no later level can use them."""
    gaps = sorted(capacity - sum([sizes[i] for i in b]) for b in bins)
    return sum(gaps[:-OPENED])


def fitness(sizes: list[int], bins: list[list[int]], capacity: int) -> tuple[int, int, float]:
    """Fewer bins first, then less room lost for the levels to come, then more uneven bins: a nearly empty one is
    nearly gone."""
    loads = sorted([sum([sizes[i] for i in b]) for b in bins], reverse=True)
    closed = loads[:-OPENED]
    return -len(bins), sum(closed) - capacity * len(closed), sum([load * load for load in loads]) / capacity ** 2


def cross(sizes: list[int], into: list[list[int]], giver: list[list[int]], capacity: int,
          rng: random.Random) -> list[list[int]]:
    filled = sorted(giver, key=lambda b: -sum([sizes[i] for i in b]))
    take = filled[:max(1, int(len(filled) * rng.uniform(0.2, 0.6)))]
    take = [list(b) for b in take if rng.random() < 0.8] or [list(filled[0])]
    injected = {i for b in take for i in b}
    apart = [injected.isdisjoint(b) for b in into]
    stay = [list(b) for b, own in zip(into, apart, strict=True) if own]
    lost = [i for b, own in zip(into, apart, strict=True) if not own for i in b if i not in injected]
    return best_fit(sizes, sorted(lost, key=lambda i: -sizes[i]), capacity, take + stay)


def mutate(sizes: list[int], bins: list[list[int]], capacity: int, rng: random.Random) -> list[list[int]]:
    """Empties the least filled bins and a few others that have room; full ones stay."""
    loads = [sum([sizes[i] for i in b]) for b in bins]
    ranked = sorted((n for n in range(len(bins)) if loads[n] < capacity), key=loads.__getitem__)
    drop = max(1, len(bins) // 50)
    gone = set(ranked[:drop] + rng.sample(ranked[drop:], min(drop, len(ranked[drop:]))))
    lost = sorted((i for n in gone for i in bins[n]), key=lambda i: -sizes[i] * rng.uniform(0.9, 1.1))
    return best_fit(sizes, lost, capacity, [list(b) for n, b in enumerate(bins) if n not in gone])


def evolve(sizes: list[int], population: list[list[list[int]]], capacity: int, seed: int,
           generations: int = GENERATIONS) -> list[list[list[int]]]:
    """The island's packings after some generations, the best one first. Stops early only at the least possible
    number of bins with no room lost in those that stay closed: more than that no packing of the block can do."""
    rng = random.Random(seed)
    if not sizes:
        return [[]]
    least = max(-(-sum(sizes) // capacity), sum(s * 2 > capacity for s in sizes))
    if not population:
        down = sorted(range(len(sizes)), key=lambda i: -sizes[i])
        population = [best_fit(sizes, down, capacity, [])]
    if len(population[0]) <= least and not lost_room(sizes, population[0], capacity):
        return population[:1]
    while len(population) < PACKINGS:
        shaken = sorted(range(len(sizes)), key=lambda i: -sizes[i] * rng.uniform(0.8, 1.2))
        population.append(best_fit(sizes, shaken, capacity, []))
    value = [fitness(sizes, b, capacity) for b in population]
    for _ in range(generations):
        for _ in range(PACKINGS):
            a, b = rng.sample(range(len(population)), 2)
            child = mutate(sizes, cross(sizes, population[a], population[b], capacity, rng), capacity, rng)
            worth = fitness(sizes, child, capacity)
            worst = min(range(len(value)), key=value.__getitem__)
            if worth > value[worst]:
                population[worst], value[worst] = child, worth
        if max(value)[:2] >= (-least, 0):
            break
    ranked = sorted(range(len(value)), key=lambda i: value[i], reverse=True)
    return [population[i] for i in ranked[:PACKINGS]]


def as_bins(numbers: list[int]) -> list[list[int]]:
    bins: list[list[int]] = [[] for _ in range(max(numbers, default=-1) + 1)]
    for i, n in enumerate(numbers):
        bins[n].append(i)
    return bins


def as_numbers(bins: list[list[int]], n: int) -> list[int]:
    out = [0] * n
    for number, b in enumerate(bins):
        for i in b:
            out[i] = number
    return out


# --- all blocks --------------------------------------------------------------------------------------

_ISLAND = "block bigint, island int, sizes array<int>, population array<array<int>>, bins int, lost int"


def _breed(capacity: int, turn: int):
    def breed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                before = [as_bins(p) for p in row["population"]]
                if row["migrant"]:
                    before = [as_bins(row["migrant"]), *before[:PACKINGS - 1]]
                    before.sort(key=lambda b: fitness(row["sizes"], b, capacity), reverse=True)
                seed = zlib.crc32(f"{row['block']}:{row['island']}:{turn}".encode())
                after = evolve(row["sizes"], before, capacity, seed)
                n = len(row["sizes"])
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([row["block"]], pa.int64()), "island": pa.array([row["island"]], pa.int32()),
                    "sizes": pa.array([row["sizes"]], pa.list_(pa.int32())),
                    "population": pa.array([[as_numbers(b, n) for b in after]], pa.list_(pa.list_(pa.int32()))),
                    "bins": pa.array([len(after[0])], pa.int32()),
                    "lost": pa.array([lost_room(row["sizes"], after[0], capacity)], pa.int32())})
    return breed


def _place(capacity: int, last: bool):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _PLACED.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.bool_()]
        for batch in batches:
            for row in batch.to_pylist():
                bins = as_bins(row["best"])
                sizes = [p["length"] for p in row["pieces"]]
                loads = [sum(sizes[i] for i in b) for b in bins]
                ranked = sorted(range(len(bins)), key=lambda b: loads[b])[:OPENED]
                opened = set() if last else {b for b in ranked if loads[b] < capacity}
                out = []
                for number, b in enumerate(bins):
                    at = 0
                    for i in sorted(b):
                        p = row["pieces"][i]
                        out.append((row["block"], p["doc_id"], p["piece"], p["start"], p["length"], p["ids_crc32"],
                                    number, at, number in opened))
                        at += p["length"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)
    return place


def pack_blocks(pieces: DataFrame, capacity: int, last: bool) -> DataFrame:
    """Packs each block for itself; `opened` marks the pieces of the bins that the next level packs again."""
    order = ["length", "doc_id", "piece", "start", "ids_crc32"]
    blocks = pieces.groupBy("block").agg(F.sort_array(F.collect_list(F.struct(*order))).alias("pieces"))
    islands = blocks.select(
        "block", F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])).alias("island"),
        F.transform("pieces", lambda p: p["length"].cast("int")).alias("sizes"),
        F.array().cast("array<array<int>>").alias("population"), F.lit(None).cast("array<int>").alias("migrant"))
    ring = Window.partitionBy("block").orderBy("island")
    whole = Window.partitionBy("block")
    for turn in range(ROUNDS):
        bred = islands.mapInArrow(_breed(capacity, turn), _ISLAND)
        elite = F.col("population")[0]
        islands = bred.withColumn("migrant", F.coalesce(
            F.lag(elite).over(ring), F.max_by(elite, "island").over(whole)))
    best = islands.groupBy("block").agg(F.min_by(F.col("population")[0], F.struct("bins", "lost", "island")).alias("best"))
    return blocks.join(best, "block").mapInArrow(_place(capacity, last), _PLACED)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 4096) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null text counts as empty, so its document is the end id alone. Documents with the same id, or none, are
    packed one by one. Extra columns are ignored. An empty table gives no rows. Only documents of more than
    `capacity` tokens are cut. In a sequence pieces lie from offset 0 without gaps.
    """
    level, done = 0, []
    pieces = cut(cut_pieces(docs, tokenizer, end_id, capacity), "pieces")
    done.append(pieces.filter("block < 0").select(
        *pieces.columns[1:], F.col("block").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")))
    open_pieces = pieces.filter("block >= 0")
    while True:
        blocks = open_pieces.select("block").distinct().count()
        placed = cut(pack_blocks(open_pieces, capacity, blocks <= 1), f"level{level}")
        done.append(placed.filter("not opened").select(
            *pieces.columns[1:], (F.lit(level << 57) + F.col("block") * F.lit(1 << 13) + F.col("bin"))
            .alias("sequence_id"), "offset"))
        if blocks <= 1:
            break
        left = placed.filter("opened").select(*pieces.columns)
        fewer = min(-(-left.count() // BLOCK), -(-blocks // 2))
        if not fewer:
            break
        # pieces of one block stay together, so a block gets whole groups of bins
        open_pieces = left.withColumn("block", F.pmod(F.xxhash64("block"), F.lit(fewer)))
        level += 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out
