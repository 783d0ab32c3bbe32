"""Filter audit, source divergence and byte-level BPE against brute force."""

from __future__ import annotations

import base64
import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakesales.llm import byte_bpe, filter_audit, source_divergence
from lakesales.llm import queries as llm
from tests.llm.conftest import DOCS, edge_rows, prose

SF = "/root/testdata/sf0.001"


# --- 12 byte-level BPE -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    with open(byte_bpe.ranks_path(), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=byte_bpe.piece_pattern(), mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own():
    return byte_bpe.Vocabulary(byte_bpe.ranks_path(), byte_bpe.piece_pattern())


def ids_of(own, texts):
    ids, offsets = own.encode(pa.array(texts, pa.string()))
    data, ends = own.decode(ids, offsets)
    for i, text in enumerate(texts):
        assert data[ends[i]:ends[i + 1]].tobytes() == (text or "").encode()
    return [ids[a:b].tolist() for a, b in itertools.pairwise(offsets)]


AWKWARD = ["", None, " ", "  ", "a", " a", "a ", "a  b", "it's we'LL don't", "x\n\n y\t z ", " a b c", "  lead", "trail  ",
           "\x1c a \x1f", "<|endoftext|> a", "naïve — ΑΣΟΣ é ̸= 12ab३४", "😀😀 👩‍👩‍👧 ok", "zzzz" * 200, "ab" * 700, "a b " * 50, "\r\n\r\n",
           "!?!?!?...", "日本語のテキスト", "a​b", "'s 's's", "1 2 3  4"]


def test_ids_are_the_librarys(own, library):
    assert ids_of(own, AWKWARD) == [library.encode_ordinary(t or "") for t in AWKWARD]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(list(" abcdeinorst'.,\n\t é")), st.characters(exclude_categories=("Cs",))),
                        max_size=60), min_size=1, max_size=6))
def test_ids_of_any_text_are_the_librarys(own, library, texts):
    assert ids_of(own, texts) == [library.encode_ordinary(t) for t in texts]


def test_heap_and_matrix_merge_alike(own, library, monkeypatch):
    rng = random.Random(3)
    pieces = ["".join(rng.choices("abcdeinorst", k=rng.randrange(2, 120))).encode() for _ in range(300)]
    want = [library.encode_ordinary(p.decode()) for p in pieces]
    for row_bytes, cells in ((256, 1 << 20), (1, 1 << 20), (256, 64), (30, 1000)):
        monkeypatch.setattr(byte_bpe, "ROW_BYTES", row_bytes)
        monkeypatch.setattr(byte_bpe, "MATRIX_CELLS", cells)
        assert [x.tolist() for x in own.encode_pieces(pieces)] == want


def test_equal_pairs_merge_leftmost_first(own, library):
    runs = ["a" * n for n in range(1, 60)] + ["=" * n for n in range(1, 60)] + ["ha" * n for n in range(1, 40)]
    assert ids_of(own, runs) == [library.encode_ordinary(t) for t in runs]


def test_pairs_are_found_through_full_slots():
    rng = np.random.default_rng(1)
    left, right = rng.integers(0, 40, 3000), rng.integers(0, 40, 3000)
    keys, first = np.unique(left << 32 | right, return_index=True)
    pairs = byte_bpe.Pairs(keys[::2], first[::2])
    known = dict(zip(keys[::2].tolist(), first[::2].tolist(), strict=True))
    got = pairs.of(left, right)
    assert got.tolist() == [known.get(k, int(byte_bpe._NONE)) for k in (left << 32 | right).tolist()]
    assert pairs.of(np.array([-1, 3]), np.array([3, -1])).tolist() == [int(byte_bpe._NONE)] * 2


def test_a_worker_that_forgets_gives_the_same_ids(own, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 10)
    for seed in range(3):
        texts = [prose(seed * 10 + k, 40) for k in range(5)]
        assert ids_of(own, texts) == [library.encode_ordinary(t) for t in texts]


def test_unknown_ids_are_refused(own):
    with pytest.raises(ValueError):
        own.decode(np.array([50256], np.uint32), np.array([0, 1]))


def digests(library, doc_id, text):
    ids = library.encode_ordinary(text or "")
    return (doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


def test_byte_bpe_query_by_the_library(spark, library, edge_docs, edge_dir):
    for at in (SF, edge_dir):
        want = collections.Counter(digests(library, r["doc_id"], r["text"])
                                   for r in spark.read.parquet(f"{at}/documents.parquet").collect())
        assert collections.Counter(tuple(r) for r in llm.QUERIES["op12_byte_bpe"](spark, at).collect()) == want


# --- 13 filter audit ---------------------------------------------------------------------------------


def audited(rows, n):
    """rows of (part, mask, good, toxic)"""
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r[1:] for r in rows if r[0] == part]
        removed = collections.Counter()
        for order in itertools.permutations(range(n)):
            for step, f in enumerate(order):
                earlier = sum(1 << k for k in order[:step])
                gone = [(m, g, t) for m, g, t in mine if m >> f & 1 and not m & earlier]
                removed[f] += len(gone)
                out[part, "".join("ABCDE"[k] for k in order), step + 1] = [
                    sum(not m & (earlier | 1 << f) for m, _, _ in mine), len(gone),
                    sum(bool(m >> f & 1 and m & earlier) for m, _, _ in mine), sum(m == 1 << f for m, _, _ in mine),
                    sum(g for _, g, _ in gone), sum(t for _, _, t in gone), f]
        for (p, _, _), counts in out.items():
            if p == part:
                counts[-1] = removed[counts[-1]]
    return {(*k, *v) for k, v in out.items()}


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_audit_by_brute_force(spark, n):
    rng = random.Random(n)
    rows = [(rng.choice(["", "a", "b"]), rng.randrange(1 << n), rng.random() < .5, rng.random() < .3) for _ in range(200)]
    marked = spark.createDataFrame(rows, "part string, mask int, good boolean, toxic boolean").repartition(5)
    got = [tuple(r) for r in filter_audit.audit(marked, "ABCDE"[:n]).collect()]
    assert len(got) == len(set(got)) and set(got) == audited(rows, n)


def test_wide_sums_do_not_run_over():
    """Any counts a table can have come back out of the fields."""
    big = (1 << 62) - 1
    total = big * filter_audit.packed(5, 31, True, True) + big * filter_audit.packed(5, 0, True, False) \
        + 3 * filter_audit.packed(5, 16, False, True)
    fields = filter_audit.unpack(total, 5)
    first = list(itertools.permutations(range(5))).index((4, 0, 1, 2, 3))
    assert fields[first, 0].tolist() == [big, big + 3, 0, 3, big, big + 3]
    assert fields[first, 4].tolist() == [big, 0, big, 0, 0, 0]


def failing(rows):
    """Masks of (doc_id, text) by the five conditions as they are written down."""
    out = []
    for doc_id, text in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        out.append(sum(1 << k for k, fails in enumerate([
            len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            re.search(r"[#$%&*|]", text) is not None,
            doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t in rows)]) if fails))
    return out


def test_masks_by_brute_force(spark):
    rows = [(r[0], r[1], r[2], r[3]) for r in edge_rows()]
    rows += [(100 + k, t, "en", "a") for k, t in enumerate(
        ["w " * 100, " ".join(map(str, range(99))), " ".join(map(str, range(100))), " ".join(map(str, range(80))) + " 0" * 20,
         " ".join(map(str, range(79))) + " 0" * 21, "A123456789", "AB12345678", "Ää1234567é", "a|b", "50%", "é" * 9 + "A", "é" * 10 + "A"])]
    rows += [(100, "w " * 100, None, "a"), (None, "w " * 100, None, None), (90, "w " * 100, "x", None), (110, "", "en", "a")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], DOCS).withColumn("mask", F.lit("x")).withColumn("part", F.lit("x"))
    got = filter_audit.fail_masks(docs.repartition(3)).collect()
    want = failing([r[:2] for r in rows])
    assert collections.Counter(tuple(r) for r in got) == collections.Counter(
        (r[0], r[2] or "", m) for r, m in zip(rows, want, strict=True))


def test_labels_of_an_audit(spark):
    masks = spark.createDataFrame([(1, "a", 3), (2, "a", 0), (None, "b", 1), (3, "b", 1), (3, "b", 1)],
                                  "doc_id bigint, part string, mask int")
    labels = spark.createDataFrame([(1, 0, 0), (1, 1, None), (2, None, 1), (None, 1, 1), (3, 0, 0)],
                                   "doc_id bigint, quality int, toxic int")
    got = sorted(tuple(r) for r in filter_audit.with_labels(masks, labels).collect())
    assert got == [("a", 0, False, True), ("a", 3, True, False), *[("b", 1, False, False)] * 3]


# --- 11 source divergence ----------------------------------------------------------------------------


def diverging(rows, least, top):
    """rows of (text, lang, source)"""
    rows = [tuple(x or "" for x in r) for r in rows]
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    found = [(lang, source, re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(lower))) for text, lang, source in rows]
    out = set()
    for lang in {r[0] for r in found}:
        held = collections.Counter(t for x, _, ts in found if x == lang for t in set(ts))
        kept = {t for t, n in held.items() if n >= least}
        sources = {s for x, s, _ in found if x == lang}
        count = {s: collections.Counter(t for x, y, ts in found if x == lang and y == s for t in ts if t in kept) for s in sources}
        whole = sum(count.values(), collections.Counter())

        def p(c, t):
            return 1 + 1_000_000_000 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept))

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        for s in sources:
            pairs = [(-sum(f(p(count[s], t), p(count[o], t)) for t in kept), o.encode()) for o in sources if o != s]
            terms = [(-f(p(count[s], t), p(whole, t)), t.encode()) for t in kept if count[s][t] and p(count[s], t) > p(whole, t)]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out |= {(lang, s, part, item.decode(), -v, rank) for rank, (v, item) in enumerate(items, 1)}
    return out


@pytest.mark.parametrize("seed,bucket,cells", [(1, 250_000, 1 << 21), (2, 40, 1 << 21), (3, 30, 7), (4, 1, 1)])
def test_divergence_by_brute_force(spark, monkeypatch, seed, bucket, cells):
    monkeypatch.setattr(source_divergence, "BUCKET_ROWS", bucket)
    monkeypatch.setattr(source_divergence, "MATRIX_CELLS", cells)
    monkeypatch.setattr(source_divergence, "COUNTED_BYTES", 2000)
    rng = random.Random(seed)
    vocabulary = ["Ab", "aB", "é", "É", "ß", "x", "zz", "日本", "ā", "á", "q", *[f"w{chr(97 + k)}" for k in range(12)]]
    rows = [(None, "l0", "s0"), ("", None, None), ("1 2 3 [_]", "l0", "empty"), ("rare", "lone", "s"), ("rare", "lone", "t")]
    for k in range(150):
        words = rng.choices(vocabulary, weights=range(1, len(vocabulary) + 1), k=rng.randrange(0, 30))
        rows.append((rng.choice([" ", "1", "-_", "\x7f", "\n"]).join(words), rng.choice(["l0", "l1", None]), rng.choice(["s0", "s1", "é", "z", None])))
    rows += rows[10:30]
    docs = spark.createDataFrame(rows, "text string, lang string, source string").withColumns(
        {c: F.lit("x") for c in ("term", "n", "doc_id", "bucket", "value", "rank", "total")}).repartition(4)
    for least, top in ((3, 10), (10, 2)):
        got = [tuple(r) for r in source_divergence.source_divergence(docs, least, top).collect()]
        assert len(got) == len(set(got)) and set(got) == diverging(rows, least, top)


def test_shares_of_huge_counts_are_exact(spark):
    rows = [(0, 5, 3), (3, 10, 1), (10 ** 17, 9 * 10 ** 17, 10 ** 9), (7 * 10 ** 12 + 1, 10 ** 13 + 7, 3 * 10 ** 7)]
    df = spark.createDataFrame(rows, "n bigint, total bigint, terms bigint")
    got = df.select(source_divergence.share(F.col("n"), F.col("total"), F.col("terms")).alias("p")).collect()
    assert [r["p"] for r in got] == [1 + 10 ** 9 * (n + 2) // (t + 2 * v) for n, t, v in rows]
