"""Simple-8b in numpy: whole 64-bit words, each a selector of 4 bits and as many ids as it says.

A block holds whole documents. Its ids are coded in frames of FRAME ids; the offset of every frame's first word
stands in the block's head, so frames are coded side by side and any of them can be read alone.

Layout, little-endian: magic, documents u32, ids u64, frames u32; frame offsets u64 (frames + 1, in words);
document ids i64; 1 byte a document, 1 where its id is null; ids of each document u64; the words.
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"TOKS8B01"
FRAME = 4096
# fixed values: ids a word and bits an id for each selector; 0 is the escape, the next word is the id itself
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1], np.int64)
BITS = np.array([64, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 45, 60], np.int64)
_HEAD = struct.Struct("<8sIQI")


def _widths(ids: np.ndarray) -> np.ndarray:
    """Bits of each id."""
    out = _WIDTH[(ids & np.uint64(0xFFFF)).astype(np.int64)]
    for shift in (16, 32, 48):
        high = (ids >> np.uint64(shift)) & np.uint64(0xFFFF)
        if high.any():
            out = np.where(high != 0, _WIDTH[high.astype(np.int64)] + np.uint8(shift), out)
    return out


_WIDTH = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.uint8)


def _selectors(ids: np.ndarray) -> np.ndarray:
    """For each id of padded frames the selector that takes most ids from there on; the padding counts as zeros."""
    width = _widths(ids)
    best = np.zeros(ids.shape, np.uint8)
    highest, have = width, 1
    for s in range(15, 0, -1):  # more and more ids a word
        while have < COUNTS[s]:
            step = min(have, COUNTS[s] - have)
            highest = np.maximum(highest[:, :-step], highest[:, step:])
            have += step
        best[:, :highest.shape[1]][highest <= BITS[s]] = s
    return best


def encode(ids: np.ndarray, frame: int = FRAME) -> tuple[np.ndarray, np.ndarray]:
    """Words and the offsets of the frames' first words."""
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(1, np.uint64)
    frames = -(-n // frame)
    broad = frame + int(COUNTS.max())
    table = np.zeros((frames, broad), np.uint64)
    whole = np.zeros(frames * frame, np.uint64)
    whole[:n] = ids
    table[:, :frame] = whole.reshape(frames, frame)
    best = _selectors(table).ravel()
    table = table.ravel()
    step = np.where(best == 0, 1, COUNTS[best])
    at = np.arange(frames) * broad
    stop = at + np.minimum(frame, n - np.arange(frames) * frame)
    taken = []
    while len(at):  # one word of every frame at a time
        taken.append(at)
        at = at + step[at]
        live = at < stop
        at, stop = at[live], stop[live]
    position = np.sort(np.concatenate(taken))
    selector = best[position]
    room = 1 + (selector == 0)
    slot = np.cumsum(room) - room
    words = np.zeros(int(room.sum()), np.uint64)
    for s in np.unique(selector).tolist():
        of = np.flatnonzero(selector == s)
        if s == 0:
            words[slot[of] + 1] = table[position[of]]
            continue
        value = np.full(len(of), s << 60, np.uint64)
        for k in range(COUNTS[s]):
            value |= table[position[of] + k] << np.uint64(k * BITS[s])
        words[slot[of]] = value
    offsets = np.zeros(frames + 1, np.uint64)
    offsets[1:] = np.cumsum(np.bincount(position // broad, weights=room, minlength=frames)).astype(np.uint64)
    return words, offsets


def decode(words: np.ndarray, offsets: np.ndarray, n: int, frame: int = FRAME) -> np.ndarray:
    """The n ids of encode()."""
    if not n:
        return np.zeros(0, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    for at in np.flatnonzero(selector == 0):  # an escape, or an id that looks like one
        if not raw[at]:
            raw[at + 1] = True
    heads = np.flatnonzero(~raw)
    selector = selector[heads]
    count = COUNTS[selector]
    owner = np.searchsorted(offsets[1:].astype(np.int64), heads, "right")
    before = np.cumsum(count) - count
    # the last word of a frame may hold fewer ids than its selector says
    first = np.searchsorted(heads, offsets[:-1].astype(np.int64))
    place = owner * frame + before - before[first][owner]
    out = np.zeros(n + int(COUNTS.max()), np.uint64)
    stop = np.minimum((owner + 1) * frame, n)
    for s in np.unique(selector):
        of = np.flatnonzero(selector == s)
        if s == 0:
            out[place[of]] = words[heads[of] + 1]
            continue
        mask = np.uint64((1 << int(BITS[s])) - 1)
        value = words[heads[of]] & np.uint64((1 << 60) - 1)
        for k in range(COUNTS[s]):
            keep = place[of] + k < stop[of]
            out[place[of][keep] + k] = (value[keep] >> np.uint64(k * BITS[s])) & mask
    return out[:n]


def pack_block(doc_ids: list, counts: np.ndarray, ids: np.ndarray, frame: int = FRAME) -> bytes:
    words, offsets = encode(ids, frame)
    missing = np.array([d is None for d in doc_ids], np.uint8)
    known = np.array([0 if d is None else d for d in doc_ids], np.int64)
    return b"".join([_HEAD.pack(MAGIC, len(doc_ids), len(ids), len(offsets) - 1), offsets.astype("<u8").tobytes(),
                     known.astype("<i8").tobytes(), missing.tobytes(), np.asarray(counts).astype("<u8").tobytes(),
                     words.astype("<u8").tobytes()])


def read_block(block: bytes, frame: int = FRAME) -> tuple[list, np.ndarray, np.ndarray]:
    """Document ids, ids of each document, all ids."""
    magic, docs, n, frames = _HEAD.unpack_from(block)
    if magic != MAGIC:
        raise ValueError("not a block of token ids")
    at = _HEAD.size

    def take(kind: str, many: int) -> np.ndarray:
        nonlocal at
        x = np.frombuffer(block, kind, many, at)
        at += x.nbytes
        return x

    offsets, known, missing, counts = take("<u8", frames + 1), take("<i8", docs), take("u1", docs), take("<u8", docs)
    words = take("<u8", int(offsets[-1]))
    doc_ids = [None if m else int(d) for d, m in zip(known, missing, strict=True)]
    return doc_ids, counts.astype(np.int64), decode(words, offsets, n, frame)
