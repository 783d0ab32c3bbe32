"""Token ids of whole Arrow columns.

The public word tokenizer drops white space and never joins what white space parts. So a text is split at
blanks, line ends and common marks, each different piece is encoded once, and the ids are laid out for every text by position.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from lakesales.llm.common import hash_spans, text_buffers

WORD_BPE = "word_bpe_49k.json"
#: Pieces whose ids a worker remembers; it forgets all of them when there are more.
REMEMBERED = 800_000
#: Pieces that are encoded in one text, and what stands between them.
JOINED, PART = 1000, "\x01"


def tokenizer_path(name: str = WORD_BPE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Encodes columns of text as the tokenizer would encode each whole text, without special tokens added."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.part = self.tokenizer.encode(PART, add_special_tokens=False).ids[0]
        self.forget()

    def forget(self) -> None:
        self.known, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # hashes in order, and where
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.begin, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.proof = np.zeros(0, np.uint64)

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces one after another, and how many each has. Plain pieces go through in one text,
        parted by a character whose id no plain piece can have."""
        part = np.uint32(self.part)
        out, counts = [], []
        for lo in range(0, len(pieces), JOINED):
            text = f" {PART} ".join(pieces[lo:lo + JOINED])
            if text.count(PART) == len(pieces[lo:lo + JOINED]) - 1 and "<|" not in text:
                ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
                ends = np.append(np.flatnonzero(ids == part), len(ids))
                counts.append(np.diff(ends, prepend=-1) - 1)
                out.append(ids[ids != part])
            else:
                found = self.tokenizer.encode_batch_fast(pieces[lo:lo + JOINED], add_special_tokens=False)
                counts.append(np.array([len(x.ids) for x in found], np.int64))
                out.append(np.array([i for x in found for i in x.ids], np.uint32))
        return np.concatenate(out), np.concatenate(counts)

    def places(self, names: pa.Array) -> np.ndarray:
        """Where the ids of each of these different pieces are in the store. Pieces are told apart by two
        independent 64-bit hashes."""
        data, offsets = text_buffers(names)
        one, two = (hash_spans(data, offsets[:-1], np.diff(offsets), salt) for salt in (0, 0x5BF03635))
        place, new = np.zeros(len(one), np.int64), np.arange(len(one))
        if len(self.known):
            at = np.minimum(np.searchsorted(self.known, one), len(self.known) - 1)
            place = self.place[at]
            new = np.flatnonzero((self.known[at] != one) | (self.proof[place] != two))
            if len(new) and len(self.known) + len(new) > REMEMBERED:
                self.forget()
                new = np.arange(len(one))
        if len(new):
            ids, counts = self._encode_pieces(names.take(pa.array(new)).to_pylist())
            while self.used + len(ids) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            self.ids[self.used:self.used + len(ids)] = ids
            place[new] = np.arange(len(self.count), len(self.count) + len(new))
            order = np.argsort(one[new])
            at = np.searchsorted(self.known, one[new][order])
            self.known = np.insert(self.known, at, one[new][order])
            self.place = np.insert(self.place, at, place[new][order])
            self.begin = np.concatenate([self.begin, self.used + np.cumsum(counts) - counts])
            self.count = np.concatenate([self.count, counts])
            self.proof = np.concatenate([self.proof, two[new]])
            self.used += len(ids)
        return place

    def encode(self, column: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another and the n+1 offsets of the texts; null counts as empty."""
        data, offsets = text_buffers(column)
        data, offsets = data[offsets[0]:offsets[-1]], offsets - offsets[0]
        cuts = _cuts(data, offsets)
        pieces = pa.LargeStringArray.from_buffers(
            len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(data)) if len(cuts) > 1 else pa.array([], pa.large_string())
        coded = pieces.dictionary_encode()
        place = self.places(coded.dictionary)
        index = coded.indices.to_numpy(zero_copy_only=False)
        count = self.count[place][index]
        before = np.zeros(len(count) + 1, np.int64)
        np.cumsum(count, out=before[1:])
        # ids of a piece stay together: the gap to their place in the store is the same for all of them
        gap = self.begin[place][index] - before[:-1]
        ids = self.ids[np.arange(before[-1]) + np.repeat(gap, count)]
        offsets = before[np.searchsorted(cuts, offsets)]
        if end_id is None:
            return ids, offsets
        out = np.full(len(ids) + len(column), end_id, np.uint32)
        keep = np.ones(len(out), bool)
        ends = offsets[1:] + np.arange(len(column))
        keep[ends] = False
        out[keep] = ids
        return out, np.concatenate([[0], ends + 1])


# Pieces end at blanks and line ends, and between an ASCII letter and one of these marks: the tokenizer parts
# letters from marks, and none of these begins a contraction, a combined character or a special token.
_GAP, _LETTER, _MARK = (np.zeros(256, bool) for _ in range(3))
_GAP[[10, 32]] = True
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK[list(b".,;:!?*#%&$")] = True


def _cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    gap = _GAP[data]
    new = np.zeros(len(data) + 1, bool)
    new[1:-1] = (gap[1:] != gap[:-1]) | (_LETTER[data[:-1]] & _MARK[data[1:]])
    new[offsets] = True
    return np.flatnonzero(new)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder a worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
