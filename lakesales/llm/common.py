"""What the operators share: tables in the shared folder, sizes, and words of a whole Arrow column."""

from __future__ import annotations

import gc
import math
import time
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesales.session import scratch_path

#: Bytes of text that are worked on at once inside a task.
CHUNK_BYTES = 2 << 20


def cut(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: later steps neither repeat nor lose the work."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark) -> None:
    """Lets Spark delete the shuffle files that nothing refers to any more now, not when the driver happens to
    collect its garbage: before a further large shuffle they would only fill disks."""
    for _ in range(2):  # Python lets go of its handles a moment after it collects them
        gc.collect()
        time.sleep(1)
        spark.sparkContext._jvm.System.gc()


def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(df: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of all texts, added up by Spark."""
    return df.agg(F.sum(F.octet_length(text)).alias("b")).first()["b"] or 0


def parts_for(total: float, each: float, least: int = 12) -> int:
    """How many parts keep the average part at `each`; grows with the data, no upper limit."""
    return max(least, math.ceil(total / each))


# --- words -----------------------------------------------------------------------------------------

_BREAK = np.zeros(256, bool)
_BREAK[[9, 10, 11, 12, 13, 32]] = True
#: White space and all ASCII marks: what parts words where only letters and digits matter.
MARKS = _BREAK.copy()
MARKS[:48] = MARKS[58:65] = MARKS[91:97] = MARKS[123:128] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# fixed random odd numbers: every task must hash alike
_RANDOM = np.random.default_rng(8191)
_LENGTH = np.uint64(int(_RANDOM.integers(1 << 61, 1 << 62)) * 2 + 1)
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have) <= n:
        steps = np.full(max(n, 1 << 16) + 1, base, np.uint64)
        steps[0] = 1
        have = _POWERS[base] = np.cumprod(steps, dtype=np.uint64)
    return have[: n + 1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words(NamedTuple):
    """Words of several texts: word w lies at data[start[w]:end[w]], text t has words first[t]..first[t+1]."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def _pieces(data: np.ndarray, lo: int, hi: int, breaks: np.ndarray):
    """Cuts lo..hi at white space into pieces of about CHUNK_BYTES; a longer word stays whole."""
    while lo < hi:
        at = min(lo + CHUNK_BYTES, hi)
        if at < hi:
            gaps = np.flatnonzero(breaks[data[lo:at]])
            if len(gaps):
                at = lo + int(gaps[-1]) + 1
            else:
                step = at
                while step < hi:
                    gaps = np.flatnonzero(breaks[data[step:step + CHUNK_BYTES]])
                    if len(gaps):
                        break
                    step += CHUNK_BYTES
                at = min(hi, step + int(gaps[0]) + 1) if len(gaps) else hi
        yield lo, at
        lo = at


def _word_hashes(data: np.ndarray, cuts: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and 64-bit hashes of the words of one piece; cuts: where a new text begins."""
    inside = ~breaks[data]
    left = inside.copy()
    left[1:] &= ~inside[:-1]
    left[cuts] |= inside[cuts]
    right = inside.copy()
    right[:-1] &= ~inside[1:]
    before = cuts[cuts > 0] - 1
    right[before] |= inside[before]
    start, end = np.flatnonzero(left), np.flatnonzero(right) + 1
    return start, end, hash_spans(data, start, end - start)


def hash_spans(data: np.ndarray, start: np.ndarray, size: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit hashes of data[start:start + size], eight bytes at a time; different for all spans of one length
    up to 8. Another salt gives an independent hash."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(data),), np.uint64, padded, 0, (1,))
    code = size.astype(np.uint64) * _LENGTH + np.uint64(salt)
    at, left, live = start, size, slice(None)
    while len(at):
        bits = (np.minimum(left, 8) * 8).astype(np.uint64)
        part = lanes[at] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - bits))
        code[live] = mix(code[live] ^ part)
        more = np.flatnonzero(left > 8)
        live = more if isinstance(live, slice) else live[more]
        at, left = at[more] + 8, left[more] - 8
    return code


def words_of(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = _BREAK) -> Words:
    """Words (`[^\\x20\\x09-\\x0D]+` by default) of texts that lie at data[offsets[t]:offsets[t+1]]."""
    starts, ends, hashes = [], [], []
    lo, hi = int(offsets[0]), int(offsets[-1])
    for a, b in _pieces(data, lo, hi, breaks):
        cuts = offsets[np.searchsorted(offsets, a):np.searchsorted(offsets, b)]
        s, e, h = _word_hashes(data[a:b], np.unique(cuts) - a, breaks)
        starts.append(s + a), ends.append(e + a), hashes.append(h)
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    end = np.concatenate(ends) if ends else np.zeros(0, np.int64)
    code = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    return Words(data, start, end, code, np.searchsorted(start, offsets))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


def chunks(batch: pa.RecordBatch, text: str = "text", limit: int = CHUNK_BYTES):
    """Slices of a batch with about `limit` bytes of text each; a longer text comes alone."""
    if not batch.num_rows:
        return
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
    lo = 0
    while lo < batch.num_rows:
        done = int(sizes[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(sizes, done + limit, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def words_of_column(column: pa.Array, lower: bool = False, breaks: np.ndarray = _BREAK) -> Words:
    """`lower`: A-Z count as a-z."""
    data, offsets = text_buffers(column)
    return words_of(_LOWER[data] if lower else data, offsets, breaks)


_GRAM = _RANDOM.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def gram_hashes(code: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of every n consecutive word hashes."""
    if len(code) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(code) - n + 1, np.uint64)
    for k in range(n):
        total += code[k:len(code) - n + 1 + k] * _GRAM[k]
    return mix(total)


def pair_hashes(code: np.ndarray, apart: int) -> np.ndarray:
    """64-bit hash of every word hash and the one `apart` places on; the same two give the same at any distance."""
    return mix(code[:-apart] * _GRAM[0] + code[apart:] * _GRAM[1])


_ROLL = [int(x) * 2 + 1 for x in _RANDOM.integers(1 << 61, 1 << 62, 2)]


def window_hashes(code: np.ndarray, n: int, which: int = 0) -> np.ndarray:
    """64-bit hash of every n consecutive word hashes, for a large n; `which` picks one of two independent ones."""
    if len(code) < n:
        return np.zeros(0, np.uint64)
    base = _ROLL[which]
    total = np.zeros(len(code) + 1, np.uint64)
    np.cumsum(code * powers(base, len(code))[:-1], out=total[1:])
    return mix((total[n:] - total[:-n]) * powers(pow(base, -1, 1 << 64), len(code))[:len(code) - n + 1])


def window_minimum(x: np.ndarray, n: int) -> np.ndarray:
    """The smallest of every n consecutive values."""
    have = 1
    while have < n:
        step = min(have, n - have)
        x = np.minimum(x[:-step], x[step:]) if len(x) > step else x[:0]
        have += step
    return x


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
