"""N-gram Jaccard join: documents whose sets of word shingles overlap enough, by T-occurrence search.

Two sets with a Jaccard similarity of t or more share at least t * size elements of the larger one. So if each set
is put in one common order, rare elements first, and all but its last T - EXTRA elements are its prefix (T = t *
size), linked sets share EXTRA elements of their prefixes. Steps:

1. Every document becomes a set; equal sets are one node from here on. A sketch of fixed size counts how many
   documents hold an element; it only sets the common order, so its errors cost time, never a link.
2. Prefixes go to buckets as inverted lists. Short lists give pairs with a count. Lists longer than LONG are set
   aside: a pair that could have met in long lists needs fewer hits in short ones, and where it could have met
   in long lists alone, all nodes of that kind on a long list stay together.
3. Connected candidates form cells. In a cell the whole sets are indexed and every set searches it: short lists
   are merged by a heap, long ones only probed for what can still reach the overlap (DivideSkip). A cell that is too large
   for a task is split into blocks, and each pair of blocks is a cell.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesales.llm.common import (
    Words,
    chunks,
    cut,
    gram_hashes,
    mix,
    parts_for,
    signed,
    text_bytes,
    words_of_column,
)
from lakesales.llm.components import components
from lakesales.llm.exact_dedup import with_place

SHINGLE, PERCENT = 5, 75
#: Prefix elements that linked sets share at least, and the length from which a list is set aside.
EXTRA, LONG = 4, 16
#: Counters of the sketch for each word of text, and their smallest and largest number (powers of two).
SKETCH_SHARE, SKETCH_LEAST, SKETCH_MOST = 1 / 64, 16, 24
#: Prefix elements a bucket holds on average, elements of a cell, and bytes of prefixes sent at once.
BUCKET_ENTRIES, CELL_ELEMENTS, SENT_ENTRIES = 400_000, 1 << 18, 1 << 19
#: Entries of short lists that a heap merges; more are counted, and then only lists longer than PROBED are probed.
HEAPED, PROBED = 4096, 2048
#: What a binary probe costs beside an entry of a merge (DivideSkip's mu), and probes made at once.
PROBE_COST, PROBES = 0.02, 1 << 16
_STRIPE = 1 << 14


def least_overlap(n, percent: int = PERCENT):
    return -(-percent * n // 100)


def shingle_sets(words: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The sorted, distinct shingle hashes of each text, one text after another, and the n+1 offsets.
    A text with fewer words has its whole sequence as the one shingle, a text without words has none."""
    texts = len(words.first) - 1
    grams = gram_hashes(words.hash, size)
    text = np.searchsorted(words.first, np.arange(len(grams)), "right") - 1
    whole = np.arange(len(grams)) + size <= words.first[text + 1]
    grams, text = grams[whole], text[whole]
    count = np.diff(words.first)
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        own = [mix(np.array([sum((int(h) * (2 * k + 3)) for k, h in enumerate(words.hash[words.first[t]:words.first[t + 1]]))
                             % (1 << 64)], np.uint64) + np.uint64(count[t]))[0] for t in short.tolist()]
        grams, text = np.append(grams, np.array(own, np.uint64)), np.append(text, short)
    order = np.lexsort((grams, text))
    grams, text = grams[order], text[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])
    grams, text = grams[new], text[new]
    return grams, np.searchsorted(text, np.arange(texts + 1))


def node_names(grams: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit names of each set; 0 for an empty one."""
    out = []
    for salt in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
        total = np.zeros(len(grams) + 1, np.uint64)
        np.cumsum(mix(grams ^ np.uint64(salt)), out=total[1:])
        sums = total[offsets[1:]] - total[offsets[:-1]]
        out.append(np.where(np.diff(offsets) > 0, mix(sums) | np.uint64(1), np.uint64(0)))
    return out[0], out[1]


# --- 1 sets and the sketch -----------------------------------------------------------------------------


def _describe(bits: int, size: int, own: list[str]):
    """`own`: columns that rows keep as they are."""
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << bits, np.uint32)
        names = [*own, "n", "node", "proof", "stripe", "counts"]
        for batch in batches:
            for part in chunks(batch):
                grams, offsets = shingle_sets(words_of_column(part.column("text"), lower=True), size)
                sketch += np.bincount((grams >> np.uint64(64 - bits)).astype(np.int64),
                                      minlength=1 << bits).astype(np.uint32)
                node, proof = node_names(grams, offsets)
                n = part.num_rows
                yield pa.RecordBatch.from_arrays([
                    *[part.column(c) for c in own], pa.array(np.diff(offsets)), pa.array(signed(node)), pa.array(signed(proof)),
                    pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
                kinds = [part.schema.field(c).type for c in own]
        zip_ = zstandard.ZstdCompressor(level=1)
        for stripe in range(0, 1 << bits, _STRIPE):
            some = sketch[stripe:stripe + _STRIPE]
            if some.any():
                yield pa.RecordBatch.from_arrays([
                    *[pa.nulls(1, kind) for kind in kinds], *[pa.nulls(1, pa.int64())] * 3,
                    pa.array([stripe // _STRIPE], pa.int32()), pa.array([zip_.compress(some.tobytes())], pa.binary())],
                    names)
    return describe


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One stripe of the sketch: a byte a counter, on a logarithmic scale."""
    total, stripe = np.zeros(0, np.uint64), 0
    for batch in batches:
        stripe = batch.column("stripe")[0].as_py() if batch.num_rows else stripe
        for counts in batch.column("counts").to_pylist():
            some = np.frombuffer(zstandard.ZstdDecompressor().decompress(counts), np.uint32)
            total = some.astype(np.uint64) + (total if len(total) else np.uint64(0))
    rank = np.minimum(255, 6 * np.log2(1.0 + total)).astype(np.uint8)
    yield pa.RecordBatch.from_pydict({"stripe": pa.array([stripe], pa.int32()),
                                      "ranks": pa.array([rank.tobytes()], pa.binary())})


# --- 2 prefixes and lists ------------------------------------------------------------------------------


def _prefixes(ranks, bits: int, buckets: int, size: int, percent: int):
    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        held: list[tuple] = []
        zip_ = zstandard.ZstdCompressor(level=1)

        def flush() -> pa.RecordBatch:
            gram, node, n = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            bucket = (gram % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((gram, bucket))
            gram, node, n = gram[order], node[order], n[order]
            ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
            there = np.flatnonzero(np.diff(ends))
            parcels = []
            for b in there.tolist():
                lo, hi = ends[b], ends[b + 1]
                nodes, first, place = np.unique(node[lo:hi], return_index=True, return_inverse=True)
                parcels.append(zip_.compress(b"".join([
                    np.array([hi - lo, len(nodes)], np.int64).tobytes(), nodes.tobytes(),
                    n[lo:hi][first].astype(np.int64).tobytes(),
                    (gram[lo:hi] >> np.uint64(32)).astype(np.uint32).tobytes(), place.astype(np.uint32).tobytes()])))
            return pa.RecordBatch.from_pydict({"bucket": pa.array(there, pa.int32()),
                                               "parcel": pa.array(parcels, pa.binary())})

        waiting = 0
        for batch in batches:
            for part in chunks(batch):
                grams, offsets = shingle_sets(words_of_column(part.column("text"), lower=True), size)
                node, _ = node_names(grams, offsets)
                fresh = np.zeros(len(node), bool)
                for i, name in enumerate(node.tolist()):
                    if name and name not in met:
                        met.add(name)
                        fresh[i] = True
                if len(met) > 1_000_000:
                    met.clear()
                n = np.diff(offsets)
                text = np.repeat(np.arange(len(n)), n)
                rank = ranks.value[(grams >> np.uint64(64 - bits)).astype(np.int64)]
                order = np.lexsort((grams, rank, text))
                least = least_overlap(n, percent)
                take = n - least + np.minimum(EXTRA, least)
                keep = fresh[text] & (np.arange(len(grams)) - offsets[:-1][text] < take[text])
                held.append((grams[order][keep], node[text][keep], n[text][keep]))
                waiting += int(keep.sum())
                if waiting >= SENT_ENTRIES:
                    yield flush()
                    waiting = 0
        if waiting:
            yield flush()
    return prefixes


def _lists(long_list: int, percent: int):
    def lists(table: pa.Table) -> pa.Table:
        grams, nodes, sizes = [], [], []
        for parcel in table.column("parcel").to_pylist():
            data = zstandard.ZstdDecompressor().decompress(parcel)
            n, m = np.frombuffer(data, np.int64, 2).tolist()
            names, size = np.frombuffer(data, np.uint64, m, 16), np.frombuffer(data, np.int64, m, 16 + 8 * m)
            place = np.frombuffer(data, np.uint32, n, 16 + 16 * m + 4 * n)
            grams.append(np.frombuffer(data, np.uint32, n, 16 + 16 * m)), nodes.append(names[place])
            sizes.append(size[place])
        gram, node, size = np.concatenate(grams), np.concatenate(nodes), np.concatenate(sizes)
        order = np.lexsort((node, gram))
        gram, node, size = gram[order], node[order], size[order]
        new = np.ones(len(gram), bool)
        new[1:] = (gram[1:] != gram[:-1]) | (node[1:] != node[:-1])
        gram, node, size = gram[new], node[new], size[new]
        head = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))
        count = np.diff(np.append(head, len(gram)))
        a, b, na, nb = [], [], [], []
        for m in range(2, long_list + 1):
            runs = head[count == m]
            if len(runs):
                left, right = np.triu_indices(m, 1)
                i, j = (runs[:, None] + left).ravel(), (runs[:, None] + right).ravel()
                near = 100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j])
                a.append(node[i[near]]), b.append(node[j[near]]), na.append(size[i[near]]), nb.append(size[j[near]])
        names = ["a", "b", "na", "nb", "hits", "run"]
        out = []
        if a:
            a, b, na, nb = (np.concatenate(x) for x in (a, b, na, nb))
            order = np.lexsort((b, a))
            a, b, na, nb = a[order], b[order], na[order], nb[order]
            first = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))) if len(a) else np.zeros(0, int)
            hits = np.diff(np.append(first, len(a)))
            out.append(pa.Table.from_arrays([
                pa.array(signed(a[first])), pa.array(signed(b[first])), pa.array(na[first]), pa.array(nb[first]),
                pa.array(hits.astype(np.int64)), pa.nulls(len(first), pa.int64())], names))
        far = np.flatnonzero(count > long_list)
        if len(far):
            at = np.concatenate([np.arange(head[r], head[r] + count[r]) for r in far])
            run = np.repeat((table.column("bucket")[0].as_py() << 32) | gram[head[far]].astype(np.int64), count[far])
            n = len(at)
            out.append(pa.Table.from_arrays([
                pa.array(signed(node[at])), pa.nulls(n, pa.int64()), pa.array(size[at]), pa.nulls(n, pa.int64()),
                pa.nulls(n, pa.int64()), pa.array(run)], names))
        return pa.concat_tables(out) if out else pa.Table.from_arrays([pa.nulls(0, pa.int64())] * 6, names)
    return lists


def _least(n: Column, percent: int) -> Column:
    return F.ceil(n * percent / F.lit(100))


def candidate_links(found: DataFrame, percent: int) -> DataFrame:
    """(a, b): what has to be in one cell."""
    apart = found.filter("run is not null").select("a", "na", "run")
    aside = cut(apart.groupBy("a").agg(F.count(F.lit(1)).alias("aside"), F.first("na").alias("n")), "aside")
    pairs = found.filter("run is null").groupBy("a", "b").agg(
        F.sum("hits").alias("hits"), F.first("na").alias("na"), F.first("nb").alias("nb"))
    least = F.least(F.lit(EXTRA), _least(F.col("na"), percent), _least(F.col("nb"), percent))
    close = (pairs.filter(F.col("hits") >= 1)
             .join(aside.select("a", F.col("aside").alias("xa")), "a", "left")
             .join(aside.select(F.col("a").alias("b"), F.col("aside").alias("xb")), "b", "left")
             .filter(F.col("hits") >= least - F.least(F.coalesce("xa", F.lit(0)), F.coalesce("xb", F.lit(0)))))
    # nodes that a partner may have met in long lists alone
    smallest = _least(_least(F.col("n"), percent), percent)
    hot = aside.filter(F.col("aside") >= F.least(F.lit(EXTRA), smallest)).select("a")
    members = apart.join(hot, "a", "left_semi").select("a", "run")
    centres = members.groupBy("run").agg(F.min("a").alias("b"))
    return close.select("a", "b").union(members.join(centres, "run").select("a", "b"))


# --- 3 cells -------------------------------------------------------------------------------------------


def _sets(size: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            for part in chunks(batch):
                grams, offsets = shingle_sets(words_of_column(part.column("text"), lower=True), size)
                node, _ = node_names(grams, offsets)
                # another text with one hash may come along; repeated rows come once a task
                own = []
                for i in np.flatnonzero(signed(node) == part.column("node").to_numpy()).tolist():
                    if (name := int(node[i])) not in met:
                        met.add(name)
                        own.append(i)
                if len(met) > 1_000_000:
                    met.clear()
                some = part.take(pa.array(own, pa.int64()))
                yield pa.RecordBatch.from_arrays([
                    some.column("node"), some.column("copies"), some.column("comp"), some.column("cells"),
                    pa.array([grams[offsets[i]:offsets[i + 1]].tobytes() for i in own], pa.binary())],
                    ["node", "copies", "comp", "cells", "grams"])
    return sets


def merge_heap(lists: list[list[int]], need: int) -> tuple[list[int], list[int]]:
    """The numbers on at least `need` of some sorted lists, and on how many. The fronts of the lists lie in a heap;
    where the smallest front is on too few, `need` - 1 lists jump to the next front that may be on enough."""
    heap = [(one[0], k) for k, one in enumerate(lists) if one]
    heapq.heapify(heap)
    at = [0] * len(lists)
    found, times = [], []
    while len(heap) >= need:
        least, popped = heap[0][0], []
        while heap and heap[0][0] == least:
            popped.append(heapq.heappop(heap)[1])
        front = least + 1
        if len(popped) >= need:
            found.append(least)
            times.append(len(popped))
        else:
            while heap and len(popped) < need - 1:
                popped.append(heapq.heappop(heap)[1])
            if not heap:
                break
            front = heap[0][0]
        for k in popped:
            one = lists[k]
            at[k] = to = bisect_left(one, front, at[k])
            if to < len(one):
                heapq.heappush(heap, (one[to], k))
    return found, times


class Index:
    """Inverted lists of the sets of a cell: sorted numbers of sets, list behind list in one array."""

    def __init__(self, sets: list[np.ndarray], members: np.ndarray, least: int):
        """`least`: lists that are not longer lead to nothing."""
        self.sizes = np.array([len(s) for s in sets], np.int64)
        gram = np.concatenate([sets[k] for k in members.tolist()]) if len(members) else np.zeros(0, np.uint64)
        owner = np.repeat(members, self.sizes[members])
        order = np.argsort(gram, kind="stable")  # members ascend, so lists do
        gram, owner = gram[order], owner[order]
        head = np.flatnonzero(np.append(True, gram[1:] != gram[:-1])) if len(gram) else np.zeros(0, np.int64)
        length = np.diff(np.append(head, len(gram)))
        several = length > least
        keep = np.repeat(several, length)
        self.gram, self.length = gram[head[several]], length[several]
        self.owner = owner[keep]
        self.plain = self.owner.tolist()
        self.head = np.cumsum(self.length) - self.length
        #: All lists as one sorted array, so that any list is probed for any set by one binary search.
        self.code = np.repeat(np.arange(len(self.gram)), self.length) * len(sets) + self.owner

    def lists_of(self, grams: np.ndarray) -> np.ndarray:
        """The lists of some elements, shortest first."""
        if not len(self.gram):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.gram, grams), len(self.gram) - 1)
        at = at[self.gram[at] == grams]
        return at[np.argsort(self.length[at], kind="stable")]

    def merge(self, lists: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
        """The sets on at least `need` of the lists, and on how many. Lists of many entries together take a counter
        for each set, which is the same merge without the order."""
        lo = self.head[lists]
        hi = lo + self.length[lists]
        if int(self.length[lists].sum()) <= HEAPED:
            found, times = merge_heap([self.plain[a:b] for a, b in zip(lo.tolist(), hi.tolist(), strict=True)], need)
            return np.array(found, np.int64), np.array(times, np.int64)
        count = np.bincount(np.concatenate([self.owner[a:b] for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]),
                            minlength=len(self.sizes))
        found = np.flatnonzero(count >= need)
        return found, count[found]

    def probe(self, lists: np.ndarray, found: np.ndarray) -> np.ndarray:
        """On how many of the lists each set of `found` is."""
        code = (lists[:, None] * len(self.sizes) + found).ravel()
        at = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
        return (self.code[at] == code).reshape(len(lists), len(found)).sum(axis=0)

    def search(self, query: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
        """T-occurrence search: the sets on at least T of the query's inverted lists, T = percent of the query's
        elements, and on how many each is. The longest lists are set aside (DivideSkip); what the merged short ones
        leave too low to reach T is gone, the rest is looked up in the long lists by binary search, a stretch of
        lists at a time."""
        n = len(query)
        need = int(least_overlap(n, percent))
        lists = self.lists_of(query)
        if len(lists) < need:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        aside = min(need - 1, int(need / (PROBE_COST * math.log2(int(self.length[lists[-1]]) + 1) + 1)))
        if int(self.length[lists[:len(lists) - aside]].sum()) > HEAPED:
            # counters take an entry in a fraction of a probe's time: only lists of very many entries are probed
            aside = min(aside, int((self.length[lists] > PROBED).sum()))
        found, times = self.merge(lists[:len(lists) - aside], need - aside)
        near = (100 * self.sizes[found] >= percent * n) & (percent * self.sizes[found] <= 100 * n)
        found, times = found[near], times[near]
        far = lists[len(lists) - aside:]
        step = max(1, PROBES // max(1, len(found)))
        for lo in range(0, len(far), step):
            if not len(found):
                break
            times = times + self.probe(far[lo:lo + step], found)
            stay = times + max(0, len(far) - lo - step) >= need
            found, times = found[stay], times[stay]
        return found, times


def link_sets(sets: list[np.ndarray], percent: int = PERCENT, queries: np.ndarray | None = None,
              index: np.ndarray | None = None):
    """Yields (query, partners): sets with a Jaccard similarity of `percent` or more, itself left out. Searches all
    sets with all, or only `queries` in an index of `index`."""
    least = 1 if index is None else 0  # a list of one holds the query alone
    lists = Index(sets, np.arange(len(sets)) if index is None else index, least)
    for q in range(len(sets)) if queries is None else queries.tolist():
        found, times = lists.search(sets[q], percent)
        other = found != q
        found, times = found[other], times[other]
        yield q, found[100 * times >= percent * (lists.sizes[found] + lists.sizes[q] - times)]


def _search_cells(percent: int):
    def search_cells(table: pa.Table) -> pa.Table:
        names = table.column("node").to_numpy()
        comp, copies = table.column("comp").to_numpy(), table.column("copies").to_numpy()
        block, i, j = (table.column(c).to_numpy() for c in ("block", "i", "j"))
        data = table.column("grams").to_pylist()
        order = np.lexsort((names, comp))
        order = order[np.append(True, names[order][1:] != names[order][:-1])]  # a repeated row came twice
        bounds = np.append(np.flatnonzero(np.append(True, comp[order][1:] != comp[order][:-1])), len(order))
        out = [[], [], []]
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            own = order[lo:hi]
            sets = [np.frombuffer(data[k], np.uint64) for k in own.tolist()]
            cross = i[own[0]] != j[own[0]]
            root = list(range(len(own)))
            linked = [0] * len(own)

            def find(x: int, root: list[int] = root) -> int:
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            sides = [np.flatnonzero(block[own] == side[own[0]]) for side in (i, j)] if cross else [None, None]
            for q, partners in link_sets(sets, percent, *sides):
                linked[q] += int(copies[own[partners]].sum())
                for p in partners.tolist():
                    if cross:  # the other side asks nothing itself
                        linked[p] += int(copies[own[q]])
                    x, y = find(q), find(p)
                    if x != y:
                        root[max(x, y)] = min(x, y)
            out[0] += names[own].tolist()
            out[1] += linked
            out[2] += [int(names[own[find(k)]]) for k in range(len(own))]
        return pa.Table.from_arrays([pa.array(x, pa.int64()) for x in out], ["node", "linked", "root"])
    return search_cells


def jaccard_components(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE, key: str = "doc_id",
                       text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, n_links of every row.

    A-Z count as a-z; words are `[^\\x20\\x09-\\x0D]+`. Two rows link when 100 * intersection >= percent * union of
    their shingle sets. component_id: the smallest id that links lead to, its own included; n_links: linked rows.
    Null and empty texts, and texts of white space, have no shingles and link with nothing: component_id is their
    own id. Rows that repeat link with each other; rows without an id take part, and a component of such rows
    alone has a null id. Extra columns are ignored; an empty table gives no rows.
    """
    out = _grouped(docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text")), percent, size)
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                      F.coalesce("n_links", F.lit(0)).alias("n_links"))


def drop_near_copies(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE, key: str = "doc_id",
                     text: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns: of each component of linked rows one, that with the
    smallest id, of equal ids the first by file and row; rows without an id come last. Decided row by row, so
    repeated ids and rows without an id are groups like others."""
    placed = with_place(docs)
    rows = _grouped(placed.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"), "_row_place"),
                    percent, size)
    # a row alone in its component has no link
    linked = cut(rows.filter("n_links > 0").select("comp", "doc_id", "_row_place"), "linked-rows")
    stays = linked.groupBy("comp").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", "_row_place")).alias("keeper")).select("keeper._row_place")
    gone = cut(linked.select("_row_place").join(stays, "_row_place", "left_anti"), "near-copies")
    return placed.join(gone, "_row_place", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def _grouped(rows: DataFrame, percent: int, size: int) -> DataFrame:
    """The rows (doc_id, other columns) without their text, with n, comp, component_id and n_links; where a text has
    no shingles the last three are null."""
    spark = rows.sparkSession
    own = [c for c in rows.columns if c != "text"]
    # names a text where its id does not: a text is fetched by both
    rows = rows.withColumn("code", F.xxhash64("text"))
    words = text_bytes(rows) / 6
    bits = min(SKETCH_MOST, max(SKETCH_LEAST, math.ceil(math.log2(words * SKETCH_SHARE + 1))))
    described = cut(rows.mapInArrow(
        _describe(bits, size, [*own, "code"]), ", ".join(f"{c} {dict(rows.dtypes)[c]}" for c in [*own, "code"])
        + ", n bigint, node bigint, proof bigint, stripe int, counts binary"), "described")
    members = described.filter("stripe is null").select(*own, "code", "n", "node", "proof")
    ranks = np.zeros(1 << bits, np.uint8)  # a fixed size, whatever the data
    for r in described.filter("stripe is not null").select("stripe", "counts").groupBy("stripe").applyInArrow(
            _add_up, "stripe int, ranks binary").collect():
        ranks[r["stripe"] * _STRIPE:r["stripe"] * _STRIPE + len(r["ranks"])] = np.frombuffer(r["ranks"], np.uint8)
    shared = spark.sparkContext.broadcast(ranks)
    buckets = parts_for(words * (100 - percent) / 100, BUCKET_ENTRIES)
    found = cut(rows.select("text").mapInArrow(_prefixes(shared, bits, buckets, size, percent), "bucket int, parcel binary")
                .repartition(buckets, "bucket").groupBy("bucket").applyInArrow(
                    _lists(LONG, percent), "a bigint, b bigint, na bigint, nb bigint, hits bigint, run bigint"),
                "lists")
    comps = components(candidate_links(found, percent))

    same = F.min("proof") == F.max("proof")
    nodes = cut(members.filter("n > 0").groupBy("node").agg(
        F.min("doc_id").alias("least"),
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "code"))["code"].alias("code"),
        F.count(F.lit(1)).alias("copies"),
        F.when(same, F.first("n")).otherwise(F.raise_error(F.lit("two sets have one name"))).alias("n")), "nodes")
    cand = comps.join(nodes, "node")
    volume = cand.groupBy("comp").agg(F.sum("n").alias("volume")).withColumn(
        "blocks", F.when(F.col("volume") <= CELL_ELEMENTS, 1).otherwise(F.ceil(F.col("volume") * 2 / CELL_ELEMENTS)))
    total = cand.agg(F.sum("n")).first()[0] or 0
    groups = parts_for(total, CELL_ELEMENTS)
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    small = F.array(F.struct(F.pmod(F.xxhash64("comp"), F.lit(groups)).alias("cell"), F.lit(-1).cast("bigint").alias("i"),
                             F.lit(-1).cast("bigint").alias("j"), F.lit(0).cast("bigint").alias("block")))
    large = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1), lambda k: F.struct(
        F.col("comp").alias("cell"), F.least(k, block).alias("i"), F.greatest(k, block).alias("j"),
        block.alias("block")))
    cand = cut(cand.join(volume, "comp").select(
        F.col("least").alias("doc_id"), "code", "node", "copies", "comp", "blocks",
        F.when(F.col("blocks") == 1, small).otherwise(large).alias("cells")), "cells")
    # both sides grow with the data: never a broadcast, however small they look
    cells = (rows.join(cand.hint("merge"), rows["doc_id"].eqNullSafe(cand["doc_id"]) & (rows["code"] == cand["code"]))
             .select(rows["text"], "node", "copies", "comp", "cells")
             .mapInArrow(_sets(size), "node bigint, copies bigint, comp bigint, "
                         "cells array<struct<cell:bigint,i:bigint,j:bigint,block:bigint>>, grams binary")
             .select("node", "copies", "comp", F.explode("cells").alias("c"), "grams")
             .select("node", "copies", "comp", "c.*", "grams"))
    cells = cells.repartition(groups, "cell", "i", "j")
    linked = cut(cells.groupBy("cell", "i", "j").applyInArrow(
        _search_cells(percent), "node bigint, linked bigint, root bigint"), "linked")
    if cand.filter("blocks > 1").head(1):  # roots of one component may differ between its cells
        joined = components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")))
    else:
        joined = linked.select("node", F.col("root").alias("comp"))
    links = linked.groupBy("node").agg(F.sum("linked").alias("linked"))
    nodes = nodes.join(joined, "node", "left").join(links, "node", "left").withColumn(
        "comp", F.coalesce("comp", "node"))
    ids = nodes.groupBy("comp").agg(F.min("least").alias("component_id"))
    nodes = nodes.join(ids, "comp").select(
        "node", "comp", "component_id", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return members.join(nodes, "node", "left").select(*own, "n", "comp", "component_id", "n_links")
