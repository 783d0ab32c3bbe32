"""Byte-level BPE: text to ids and ids to bytes, by a file of token ranks.

Pieces of text are laid out as rows of padded matrices, pieces of like length together. In every round each row merges
its leftmost pair of lowest rank, found in a hash table of pairs, and closes the gap; rows with no pair left leave.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesales.llm.common import chunks, mix, text_buffers

RANKS = "byte_bpe_50k.tiktoken"
#: Longer pieces are merged one by one with a heap: the matrix takes the square of a row's length.
ROW_BYTES = 256
#: Cells of one matrix.
MATRIX_CELLS = 1 << 20
#: Units a worker remembers, and ids it keeps for them; it forgets all when there are more.
REMEMBERED, REMEMBERED_IDS = 400_000, 1 << 22
_NONE = np.int64(1 << 40)


class Pairs:
    """Rank of a pair of token ids, by open addressing: a pair lies at its hash or in the next free slots."""

    def __init__(self, keys: np.ndarray, ranks: np.ndarray):
        size = 1 << max(4, int(4 * len(keys)).bit_length())
        self.mask = np.uint64(size - 1)
        self.key, self.rank = np.full(size, -1, np.int64), np.full(size, _NONE)
        slot = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.key[slot] < 0)
            self.key[slot[free]] = keys[free]  # of several keys for one slot one stays
            placed = self.key[slot] == keys
            self.rank[slot[placed]] = ranks[placed]
            keys, ranks, slot = keys[~placed], ranks[~placed], (slot[~placed] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys.astype(np.uint64)) & self.mask).astype(np.int64)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the tokens that left and right make up; _NONE where there is none or an id is negative."""
        keys = left.astype(np.int64) << 32 | right
        found = np.full(keys.shape, _NONE)
        at = np.flatnonzero((left >= 0) & (right >= 0))
        slot = self._slot(keys[at])
        while len(at):
            there = self.key[slot]
            hit = there == keys[at]
            found[at[hit]] = self.rank[slot[hit]]
            more = ~hit & (there >= 0)
            at, slot = at[more], (slot[more] + 1) & int(self.mask)
        return found


class Vocabulary:
    """Tokens of a rank file (base64 of the bytes, a blank, the rank; the rank is the id) and the pattern that parts
    text into pieces before any merge."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as lines:
            self.tokens = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.split = regex.compile(pattern).findall
        keys, ranks = [], []
        for token, rank in self.tokens.items():
            for cut in range(1, len(token)):
                left, right = self.tokens.get(token[:cut]), self.tokens.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    ranks.append(rank)
        self.pairs = Pairs(np.array(keys, np.int64), np.array(ranks, np.int64))
        self.byte = np.array([self.tokens[bytes([b])] for b in range(256)], np.int64)
        n = max(self.tokens.values()) + 1
        self.size = np.full(n, -1, np.int64)
        for token, rank in self.tokens.items():
            self.size[rank] = len(token)
        named = sorted(self.tokens, key=self.tokens.get)
        self.data = np.frombuffer(b"".join(named), np.uint8)
        self.begin = np.cumsum(np.maximum(self.size, 0)) - np.maximum(self.size, 0)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)

    # --- text to ids ---

    def _merge_rows(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of pieces that fit one matrix."""
        width = max(map(len, pieces))
        sizes = np.array([len(p) for p in pieces])
        ids = np.full((len(pieces), width), -1, np.int64)
        ids[np.arange(width) < sizes[:, None]] = self.byte[np.frombuffer(b"".join(pieces), np.uint8)]
        rank = np.full(ids.shape, _NONE)  # of the pair that begins here; the last column never begins one
        rank[:, :-1] = self.pairs.of(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), -1)
        done: list[np.ndarray] = [None] * len(pieces)
        row = np.arange(len(pieces))
        while len(row):
            at = rank.argmin(axis=1)  # the leftmost of equals
            lowest = rank[np.arange(len(row)), at]
            over = lowest == _NONE
            for i in np.flatnonzero(over):
                done[row[i]] = ids[i][ids[i] >= 0]
            row, ids, rank, at, lowest = row[~over], ids[~over], rank[~over], at[~over], lowest[~over]
            if not len(row):
                break
            each = np.arange(len(row))
            ids[each, at] = lowest
            stay = np.ones(ids.shape, bool)
            stay[each, at + 1] = False
            ids, rank = (x[stay].reshape(len(row), -1) for x in (ids, rank))
            right = np.where(at + 1 < ids.shape[1], ids[each, np.minimum(at + 1, ids.shape[1] - 1)], -1)
            rank[each, at] = self.pairs.of(ids[each, at], right)
            inner = np.flatnonzero(at > 0)
            rank[inner, at[inner] - 1] = self.pairs.of(ids[inner, at[inner] - 1], ids[inner, at[inner]])
        return done

    def _merge_long(self, piece: bytes) -> np.ndarray:
        """The same merges of one piece, the lowest and leftmost pair taken from a heap."""
        end, before = list(range(1, len(piece) + 1)), list(range(-1, len(piece) - 1))  # of the part that begins here
        heap: list[tuple[int, int, int, int]] = []

        def offer(a: int) -> None:
            b = end[a]
            if b < len(piece) and (rank := self.tokens.get(piece[a:end[b]])) is not None:
                heapq.heappush(heap, (rank, a, b, end[b]))

        for a in range(len(piece)):
            offer(a)
        while heap:
            _, a, b, c = heapq.heappop(heap)
            if end[a] != b or end[b] != c:  # one of them was merged since
                continue
            end[a], end[b] = c, -1
            if c < len(piece):
                before[c] = a
            offer(a)
            if before[a] >= 0:
                offer(before[a])
        ids, a = [], 0
        while a < len(piece):
            ids.append(self.tokens[piece[a:end[a]]])
            a = end[a]
        return np.array(ids, np.int64)

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece; a piece that is a token whole is that token."""
        out: list[np.ndarray] = [None] * len(pieces)
        rows = []
        for i, piece in enumerate(pieces):
            whole = self.tokens.get(piece)
            if whole is not None:
                out[i] = np.array([whole], np.int64)
            elif len(piece) > ROW_BYTES:
                out[i] = self._merge_long(piece)
            else:
                rows.append(i)
        rows.sort(key=lambda i: len(pieces[i]))
        lo = 0
        while lo < len(rows):  # rows of one matrix differ in length by a factor of 2 at most
            shortest, hi = len(pieces[rows[lo]]), lo
            while hi < len(rows) and len(pieces[rows[hi]]) <= 2 * shortest \
                    and (hi + 1 - lo) * len(pieces[rows[hi]]) <= max(MATRIX_CELLS, ROW_BYTES):
                hi += 1
            for i, ids in zip(rows[lo:hi], self._merge_rows([pieces[i] for i in rows[lo:hi]]), strict=True):
                out[i] = ids
            lo = hi
        return out

    def _places(self, units: list[str]) -> np.ndarray:
        """Where the ids of each unit are in the store; new units are encoded, each different piece once."""
        new = [u for u in units if u not in self.known]
        if new:
            split = [[p.encode() for p in self.split(u)] for u in new]
            number: dict[bytes, int] = {}
            index = [number.setdefault(p, len(number)) for pieces in split for p in pieces]
            found = self.encode_pieces(list(number))
            ids = np.concatenate([found[i] for i in index]).astype(np.uint32) if index else np.zeros(0, np.uint32)
            sizes = np.array([len(f) for f in found], np.int64)
            ends = np.cumsum(sizes[index]) if index else np.zeros(0, np.int64)
            last = np.cumsum([len(pieces) for pieces in split])
            count = np.diff(np.append(0, ends)[last], prepend=0)
            while self.used + len(ids) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            self.ids[self.used:self.used + len(ids)] = ids
            self.known.update(zip(new, range(len(self.count), len(self.count) + len(new)), strict=True))
            self.first = np.concatenate([self.first, self.used + np.cumsum(count) - count])
            self.count = np.concatenate([self.count, count])
            self.used += len(ids)
        return np.array([self.known[u] for u in units], np.int64)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a column of texts one after another and the n+1 offsets of the texts; null counts as empty."""
        if len(self.known) > REMEMBERED or self.used > REMEMBERED_IDS:
            self.forget()
        data, offsets = text_buffers(column)
        data, offsets = data[offsets[0]:offsets[-1]], offsets - offsets[0]
        cuts = unit_cuts(data, offsets)
        units = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(data)).dictionary_encode()
        place = self._places(units.dictionary.to_pylist())[units.indices.to_numpy(zero_copy_only=False)]
        before = np.append(0, np.cumsum(self.count[place]))
        ids = self.ids[np.arange(before[-1]) + np.repeat(self.first[place] - before[:-1], self.count[place])]
        return ids, before[np.searchsorted(cuts, offsets)]

    # --- ids to bytes ---

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts one after another and their offsets."""
        if len(ids) and (int(ids.max()) >= len(self.size) or self.size[ids].min() < 0):
            raise ValueError("an id is not in the vocabulary")
        size = self.size[ids]
        ends = np.append(0, np.cumsum(size))
        data = self.data[np.arange(ends[-1]) + np.repeat(self.begin[ids] - ends[:-1], size)]
        return data, ends[offsets]


_PLAIN = np.zeros(256, bool)
_PLAIN[33:127] = True


def unit_cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Offsets of units that can be split into pieces on their own: at texts, and before a blank between two visible
    ASCII characters. There every match of the pattern ends: a blank is the first character of its match unless the
    match is all white space, and one before a visible character is taken as that one's."""
    new = np.zeros(len(data) + 1, bool)
    if len(data) > 2:
        plain = _PLAIN[data]
        new[1:-2] = (data[1:-1] == 32) & plain[:-2] & plain[2:]
    new[offsets] = True
    return np.flatnonzero(new)


_VOCABULARIES: dict[tuple[str, str], Vocabulary] = {}


def vocabulary(path: str, pattern: str) -> Vocabulary:
    """One a worker process."""
    if (path, pattern) not in _VOCABULARIES:
        _VOCABULARIES[path, pattern] = Vocabulary(path, pattern)
    return _VOCABULARIES[path, pattern]


def ranks_path(name: str = RANKS) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def piece_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [
        None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of every row: ids as little-endian unsigned 32-bit integers, without special tokens.

    Null text counts as empty and has no ids; a text that spells a special token is ordinary text. Repeated rows and
    ids come back as often as they stand there, other columns are ignored, an empty table gives no rows. Texts are
    worked on whole, some megabytes of them at once; a longer one comes alone. No shuffle.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                ids, offsets = vocabulary(path, pattern).encode(part.column("text"))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"), "n_tokens": pa.array(np.diff(offsets), pa.int64()),
                    "ids": _binary(ids.astype("<u4").view(np.uint8), offsets * 4)})

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids binary")


def decode(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """Adds `decoded`, the bytes that the ids of rows of encode() stand for; an unknown id is an error."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "ids"):
                data, offsets = text_buffers(part.column("ids").view(pa.string()))  # only its buffers are used
                ids = data[offsets[0]:offsets[-1]].view("<u4")
                decoded = vocabulary(path, pattern).decode(ids, (offsets - offsets[0]) // 4)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"), "n_tokens": part.column("n_tokens"), "ids": part.column("ids"),
                    "decoded": _binary(*decoded)})

    return tokens.select("doc_id", "n_tokens", "ids").mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids binary, decoded binary")
