"""Substring deduplication: every word that lies in a repeated window of words goes.

Super-k-mers: the smallest hash of the GRAM-word grams of a window is its minimiser. Neighbouring windows with the
same minimiser travel as one packed string to the minimiser's bucket. Equal windows have equal minimisers, so all
windows with one sequence of words meet in one bucket, where sorting counts them.

A minimiser of very many windows (a line that a third of all texts hold, amid words of their own) would make one bucket
of any size. Such minimisers are counted beforehand, and their windows travel one by one, as two hashes and a place, to
buckets of the window's own hash.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesales.llm.common import (
    chunks,
    cut,
    gram_hashes,
    parts_for,
    release,
    signed,
    text_bytes,
    window_hashes,
    window_minimum,
    words_of,
    words_of_column,
)

WINDOW, GRAM = 35, 5
#: Windows of one packed string at most; a longer run goes in several.
RUN = 32
#: Bytes of packed strings a bucket holds on average, and how much longer than the text they are.
BUCKET_BYTES, BLOW_UP = 8 << 20, 3.2
#: Bytes that a task gathers before it sends them, and strings of which it remembers how often it met them.
SENT_BYTES, REMEMBERED = 16 << 20, 250_000
#: A minimiser of more windows than this is split, or of more than a part of all text bytes: then a million such
#: minimisers exist at most, and their list is sent to every task. A task reports those it met LEAST_MET times.
HOT_WINDOWS, HOT_PART, LEAST_MET = 50_000, 2_000_000, 4
_KEY = 16
_WINDOW = np.dtype([("one", "<u8"), ("two", "<u8"), ("key", f"S{_KEY}"), ("at", "<i8")])
_HEAD = struct.Struct("<qqqq")


def text_key(text: Column) -> Column:
    """What stands for a text in joins: 16 bytes of its sha256. Rows with one text lose the same words."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)), 1, _KEY)


class Parcel:
    """What goes to one bucket: packed strings with their places, places already known to repeat, and single
    windows."""

    def __init__(self):
        self.keys, self.starts, self.strings, self.known, self.windows = [], [], [], [], []

    def pack(self) -> bytes:
        strings = b"\n".join(self.strings)
        known = b"".join(k + struct.pack("<qq", lo, hi) for k, lo, hi in self.known)
        windows = b"".join(w.tobytes() for w in self.windows)
        return zstandard.ZstdCompressor(level=1).compress(b"".join([
            _HEAD.pack(len(self.keys), len(strings), len(self.known), len(windows) // _WINDOW.itemsize), b"".join(self.keys),
            np.array(self.starts, "<i8").tobytes(), strings, known, windows]))


def unpack(parcel: bytes) -> tuple[list[bytes], np.ndarray, bytes, list[tuple[bytes, int, int]], np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(parcel)
    n, size, known, windows = _HEAD.unpack_from(data)
    at = _HEAD.size
    keys = [data[at + i * _KEY:at + (i + 1) * _KEY] for i in range(n)]
    at += n * _KEY
    starts = np.frombuffer(data, "<i8", n, at)
    at += 8 * n
    rest = at + size
    step = _KEY + 16
    return keys, starts, data[at:rest], [
        (data[rest + i * step:rest + i * step + _KEY], *struct.unpack_from("<qq", data, rest + i * step + _KEY))
        for i in range(known)], np.frombuffer(data, _WINDOW, windows, rest + known * step)


def _runs(words, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last window (as word numbers) and minimiser of every super-k-mer of a chunk."""
    low = window_minimum(gram_hashes(words.hash, GRAM), n - GRAM + 1)
    text = np.searchsorted(words.first, np.arange(len(low)), "right") - 1
    whole = np.flatnonzero(np.arange(len(low)) + n <= words.first[text + 1])
    if not len(whole):
        return whole, whole, low[:0]
    new = np.ones(len(whole), bool)
    new[1:] = (low[whole[1:]] != low[whole[:-1]]) | (whole[1:] != whole[:-1] + 1)
    head = np.flatnonzero(new)
    rank = np.arange(len(whole)) - np.repeat(head, np.diff(np.append(head, len(whole))))
    new |= rank % RUN == 0
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(whole)) - 1
    return whole[head], whole[last], low[whole[head]]


def _meet(n: int):
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lows, many = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def flush() -> pa.RecordBatch:
            often = many >= LEAST_MET
            return pa.RecordBatch.from_pydict({"low": signed(lows[often]), "many": many[often]})

        for batch in batches:
            for part in chunks(batch):
                first, last, low = _runs(words_of_column(part.column("text")), n)
                lows, run = np.unique(np.concatenate([lows, low]), return_inverse=True)
                many = np.bincount(run, np.concatenate([many, last - first + 1]), len(lows)).astype(np.int64)
                if len(lows) > REMEMBERED:
                    yield flush()
                    lows, many = lows[:0], many[:0]
        yield flush()
    return meet


def hot_minimisers(rows: DataFrame, n: int, size: int) -> np.ndarray:
    """Minimisers of more windows than a bucket should hold, in order. Who is on the list decides only how windows
    travel, so that tasks leave out what they met hardly ever changes no result."""
    bound = max(HOT_WINDOWS, size // HOT_PART)
    counts = rows.select("text").mapInArrow(_meet(n), "low bigint, many bigint").groupBy("low").agg(F.sum("many").alias("many"))
    found = counts.filter(F.col("many") > bound).select("low").collect()
    return np.sort(np.array([r["low"] for r in found], np.int64).view(np.uint64))


def _send_windows(words, keys: np.ndarray, first: np.ndarray, last: np.ndarray, n: int, buckets: int, met: dict[int, int],
                  parcels: dict[int, Parcel]) -> int:
    """Puts the windows first..last of each run into parcels one by one; returns the bytes. Of a window that is met
    three times, here or in the task before, two are sent and the others are known to repeat."""
    size = last - first + 1
    window = np.repeat(first, size) + np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    text = np.searchsorted(words.first, window, "right") - 1
    sent = np.zeros(len(window), _WINDOW)
    sent["one"], sent["two"] = (window_hashes(words.hash, n, which)[window] for which in (0, 1))
    sent["key"], sent["at"] = keys[text], window - words.first[text]
    order = np.lexsort((sent["two"], sent["one"]))
    new = np.ones(len(order), bool)
    new[1:] = (sent["one"][order][1:] != sent["one"][order][:-1]) | (sent["two"][order][1:] != sent["two"][order][:-1])
    head = np.flatnonzero(new)
    many = np.diff(np.append(head, len(order)))
    rank = np.arange(len(order)) - np.repeat(head, many)
    allowed = np.full(len(head), 2)
    for i in np.flatnonzero(many > 1).tolist():
        name = int(sent["one"][order[head[i]]]) << 64 | int(sent["two"][order[head[i]]])
        allowed[i] = max(0, 2 - met.get(name, 0))
        if len(met) >= REMEMBERED:
            met.clear()
        met[name] = 2
    stays = rank < np.repeat(allowed, many)
    go = sent[order[stays]]
    bucket = (go["one"] % np.uint64(buckets)).astype(np.int64)
    by = np.argsort(bucket, kind="stable")
    for some in np.split(by, np.flatnonzero(np.diff(bucket[by])) + 1) if len(by) else []:
        parcels.setdefault(int(bucket[some[0]]), Parcel()).windows.append(go[some])
    rest, places = sent[np.sort(order[~stays])], []
    if len(rest):  # neighbouring windows of a text are one place
        cut_at = np.flatnonzero((rest["at"][1:] != rest["at"][:-1] + 1) | (rest["key"][1:] != rest["key"][:-1])) + 1
        places = np.split(rest, cut_at)
        for some in places:
            key = some["key"][0].ljust(_KEY, b"\0")
            parcels.setdefault(int(some["at"][0]) % buckets, Parcel()).known.append(
                (key, int(some["at"][0]), int(some["at"][-1]) + n))
    return len(go) * _WINDOW.itemsize + len(places) * 200  # a place is kept as Python objects


def _send(buckets: int, n: int, hot: np.ndarray):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parcels: dict[int, Parcel] = {}
        met: dict[bytes, int] = {}
        met_windows: dict[int, int] = {}
        held = 0

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict({
                "bucket": pa.array(list(parcels), pa.int32()),
                "parcel": pa.array([p.pack() for p in parcels.values()], pa.binary())})
            parcels.clear()
            return out

        for batch in batches:
            for part in chunks(batch):
                words = words_of_column(part.column("text"))
                keys = part.column("key").to_pylist()
                first, last, low = _runs(words, n)
                if len(hot) and len(low):
                    split = hot[np.minimum(np.searchsorted(hot, low), len(hot) - 1)] == low
                    held += _send_windows(words, np.array(keys, f"S{_KEY}"), first[split], last[split], n, buckets, met_windows, parcels)
                    first, last, low = first[~split], last[~split], low[~split]
                # the chunk's words with one blank between them
                size = words.end - words.start
                new = np.cumsum(size + 1) - size - 1
                plain = words.data[np.minimum(np.arange(int((size + 1).sum())) + np.repeat(words.start - new, size + 1),
                                              len(words.data) - 1)]
                plain[new + size] = 32
                plain = plain.tobytes()
                stop = last + n - 1
                text = np.searchsorted(words.first, first, "right") - 1
                for a, b, at, t, bucket, runs in zip(
                        new[first].tolist(), (new[stop] + size[stop]).tolist(), (first - words.first[text]).tolist(),
                        text.tolist(), (low % np.uint64(buckets)).tolist(), (last - first).tolist(), strict=True):
                    string = plain[a:b]
                    name = xxhash.xxh3_128_digest(string)
                    times = met.get(name, 0)
                    if times < 2:
                        if len(met) >= REMEMBERED:
                            met.clear()
                        met[name] = times + 1
                        if (parcel := parcels.get(bucket)) is None:
                            parcel = parcels[bucket] = Parcel()
                        parcel.keys.append(keys[t]), parcel.starts.append(at), parcel.strings.append(string)
                        held += len(string) + _KEY + 8
                    else:  # two of them were sent: this one repeats, and the bucket needs no third
                        bucket = t % buckets
                        if (parcel := parcels.get(bucket)) is None:
                            parcel = parcels[bucket] = Parcel()
                        parcel.known.append((keys[t], at, at + runs + n))
                        held += _KEY + 16
                if held >= SENT_BYTES:
                    yield flush()
                    held = 0
        if parcels:
            yield flush()
    return send


def _ranges(keys: list[bytes], lo, hi) -> pa.Table:
    return pa.table({"key": pa.array(keys, pa.binary()), "lo": pa.array(lo, pa.int64()),
                     "hi": pa.array(hi, pa.int64())})


def _count(n: int):
    def count(table: pa.Table) -> pa.Table:
        keys, starts, strings, known, single = [], [], [], [], []
        for parcel in table.column("parcel").to_pylist():
            k, s, text, more, windows = unpack(parcel)
            keys += k
            starts.append(s)
            strings += text.split(b"\n") if k else []
            known += more
            single.append(windows)
        known = list(set(known))
        out = [_ranges([k for k, _, _ in known], [a for _, a, _ in known], [b for _, _, b in known])]
        single = np.concatenate(single) if single else np.zeros(0, _WINDOW)
        if len(single):
            single = single[np.lexsort((single["two"], single["one"]))]
            same = (single["one"][1:] == single["one"][:-1]) & (single["two"][1:] == single["two"][:-1])
            twice = single[np.append(same, False) | np.insert(same, 0, False)]
            out.append(_ranges([k.ljust(_KEY, b"\0") for k in twice["key"].tolist()], twice["at"], twice["at"] + n))
        if keys:
            offsets = np.zeros(len(strings) + 1, np.int64)
            np.cumsum([len(s) for s in strings], out=offsets[1:])
            words = words_of(np.frombuffer(b"".join(strings), np.uint8), offsets)
            del strings
            string = np.searchsorted(words.first, np.arange(max(0, len(words.hash) - n + 1)), "right") - 1
            whole = np.flatnonzero(np.arange(len(string)) + n <= words.first[string + 1])
            string = string[whole]
            one, two = (window_hashes(words.hash, n, which)[whole] for which in (0, 1))
            order = np.argsort(one, kind="stable")
            if ((one[order][1:] == one[order][:-1]) & (two[order][1:] != two[order][:-1])).any():
                order = np.lexsort((two, one))
            same = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
            repeats = np.zeros(len(whole), bool)
            repeats[order[1:][same]] = True
            repeats[order[:-1][same]] = True
            hit = np.flatnonzero(repeats)
            if len(hit):
                new = np.ones(len(hit), bool)
                new[1:] = (hit[1:] != hit[:-1] + 1) | (string[hit[1:]] != string[hit[:-1]])
                head = np.flatnonzero(new)
                last = np.append(head[1:], len(hit)) - 1
                of = string[hit[head]]
                base = np.concatenate(starts)[of] - words.first[of]
                out.append(_ranges([keys[i] for i in of.tolist()], whole[hit[head]] + base, whole[hit[last]] + base + n))
        return pa.concat_tables(out)
    return count


def repeated_ranges(docs: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """(key, lo, hi): words lo..hi-1 of the texts with that key lie in windows that start more than once."""
    table = cut(_found_ranges(docs, window, text), "ranges").distinct()
    release(docs.sparkSession)  # the packed strings, about three times the text, are done with
    return table


def _found_ranges(docs: DataFrame, window: int, text: str) -> DataFrame:
    rows = docs.select(text_key(F.col(text)).alias("key"), F.coalesce(text, F.lit("")).alias("text"))
    size = text_bytes(rows)
    buckets = parts_for(size * BLOW_UP, BUCKET_BYTES)
    sent = rows.mapInArrow(_send(buckets, window, hot_minimisers(rows, window, size)), "bucket int, parcel binary")
    return sent.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(
        _count(window), "key binary, lo bigint, hi bigint")


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    for batch in batches:
        for part in chunks(batch):
            n_words, gone, shas, kept = [], [], [], []
            for body, ranges in zip(part.column("text").to_pylist(), part.column("ranges").to_pylist(), strict=True):
                words = body.encode().split()
                n = len(words)
                if ranges:
                    stay, at = [], 0
                    for r in sorted(ranges, key=lambda r: r["lo"]):
                        stay += words[at:max(at, r["lo"])]
                        at = max(at, r["hi"])
                    words = stay + words[at:]
                left = b" ".join(words)
                n_words.append(n), gone.append(n - len(words)), kept.append(left.decode())
                shas.append(hashlib.sha256(left).hexdigest())
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column("doc_id"), "n_words": pa.array(n_words, pa.int64()),
                "n_removed": pa.array(gone, pa.int64()), "kept_text": pa.array(kept, pa.string()),
                "kept_sha256": pa.array(shas, pa.string())})


def remove_repeats(docs: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_text, kept_sha256 of every row.

    Words are `[^\\x20\\x09-\\x0D]+`, unchanged. Each word goes that is covered by a window of `window` words whose
    sequence starts anywhere else too, in the same text or another; windows are judged on the input. Null, empty
    and short texts lose nothing; of repeated rows each loses its repeated windows. Kept words are joined by one
    blank. Extra columns are ignored; an empty table gives no rows.
    """
    # the ranges of one text: no more than the text has windows
    ranges = repeated_ranges(docs, window, text).groupBy("key").agg(
        F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"),
                       text_key(F.col(text)).alias("key"))
    return rows.join(ranges, "key", "left").select("doc_id", "text", "ranges").mapInArrow(
        _remove, f"doc_id {dict(docs.dtypes)[key]}, n_words bigint, n_removed bigint, kept_text string, "
                 "kept_sha256 string")
