from __future__ import annotations

import collections
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakesales.llm import common, simple8b, token_counts, token_files
from lakesales.llm import queries as llm
from lakesales.llm.tokens import Encoder, tokenizer_path
from tests.llm.conftest import edge_rows

SF = "/root/testdata/sf0.001"
TEXTS = st.lists(st.one_of(st.none(), st.text(max_size=40), st.text(alphabet="aBé \t\n\x0b'.,*<|≯́≠1 ", max_size=60)),
                 max_size=6)


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def encoder():
    return Encoder(tokenizer_path())


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_ids_are_those_of_the_whole_text(plain, encoder, texts):
    texts = [t if t is None else t.encode("utf-8", "ignore").decode() for t in texts]
    ids, offsets = encoder.encode(pa.array(texts, pa.string()), 7)
    got = [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    assert got == [plain.encode(t or "", add_special_tokens=False).ids + [7] for t in texts]


def test_forgotten_pieces_are_learned_again(plain, encoder, monkeypatch):
    from lakesales.llm import tokens

    monkeypatch.setattr(tokens, "REMEMBERED", 5)
    for text in ("one two three", "four five six", "one six <|endoftext|> \x01"):
        ids, _ = encoder.encode(pa.array([text]))
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_bytes(texts):
    texts = [t if t is None else t.encode("utf-8", "ignore").decode() for t in texts]
    words = common.words_of_column(pa.array(texts, pa.string()))
    got = [[words.data[words.start[i]:words.end[i]].tobytes() for i in range(words.first[t], words.first[t + 1])]
           for t in range(len(texts))]
    want = [(t or "").encode().split() for t in texts]
    assert got == want
    every = [w for t in want for w in t]
    assert len(set(every)) == len(set(words.hash.tolist()))
    assert len({*zip(every, words.hash.tolist(), strict=True)}) == len(set(every))


def test_pieces_of_a_long_text_change_nothing(monkeypatch):
    text = pa.array(["ab  cde\tf " * 50 + "x" * 300 + " y", "z z"])
    whole = common.words_of_column(text)
    monkeypatch.setattr(common, "CHUNK_BYTES", 16)
    assert (common.words_of_column(text).hash == whole.hash).all()
    assert (common.words_of_column(text).first == whole.first).all()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50_000), st.integers(0, 2**64 - 1)), max_size=300),
       st.sampled_from([1, 7, 64, 4096]))
def test_simple8b_round_trip(ids, frame):
    ids = np.array(ids, np.uint64)
    words, offsets = simple8b.encode(ids, frame)
    assert (simple8b.decode(words, offsets, len(ids), frame) == ids).all()
    block = simple8b.pack_block([None, 5], np.array([0, len(ids)]), ids, frame)
    docs, counts, back = simple8b.read_block(block, frame)
    assert docs == [None, 5] and counts.tolist() == [0, len(ids)] and (back == ids).all()


def test_a_frame_is_read_alone():
    ids = np.arange(10_000, dtype=np.uint64) % 777
    words, offsets = simple8b.encode(ids)
    lo, hi = int(offsets[1]), int(offsets[2])
    assert (simple8b.decode(words[lo:hi], np.array([0, hi - lo], np.uint64), 4096) == ids[4096:8192]).all()


def test_words_hold_several_ids():
    words, _ = simple8b.encode(np.full(6000, 1000, np.uint64))
    assert len(words) <= 6000 / 6 + 2


def token_index(plain, docs, end):
    rows, start = [], 0
    for doc_id, text in docs:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [end]
        rows.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return rows


def test_token_files_by_brute_force(spark, plain):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = llm.QUERIES["op3_token_files"](spark, SF)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(tuple(r) for r in got.collect()) == token_index(plain, docs, 2)


def test_token_files_of_edge_documents(spark, plain, edge_docs, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 50)
    path = str(tmp_path / "tokens")
    token_files.write_token_files(edge_docs, path, tokenizer_path(), end_id=2)
    got = sorted((tuple(r) for r in token_files.token_index(spark, path).collect()), key=lambda r: r[1])
    # without an id first, then by id; the order of equal ids is free
    assert [r[0] for r in got] == [None] * 3 + sorted(r[0] for r in edge_rows() if r[0] is not None)
    at = 0
    for _, start, n, _ in got:
        assert start == at
        at += n
    want = collections.Counter((r[0], *r[2:]) for r in token_index(plain, [r[:2] for r in edge_rows()], 2))
    assert collections.Counter((r[0], *r[2:]) for r in got) == want
    ids = collections.Counter((r["doc_id"], tuple(r["ids"])) for r in token_files.read_token_ids(spark, path).collect())
    assert ids == collections.Counter(
        (i, (*plain.encode(t or "", add_special_tokens=False).ids, 2)) for i, t, *_ in edge_rows())


def totals(plain, docs, toxic, end=1):
    sums = collections.defaultdict(lambda: [0, 0, 0])
    for doc_id, text, lang, source in docs:
        if doc_id is None or doc_id not in toxic:
            row = sums[source, lang]
            row[0] += 1
            row[1] += len((text or "").encode())
            row[2] += len(plain.encode(text or "", add_special_tokens=False).ids) + end
    return {k: tuple(v) for k, v in sums.items()}


@pytest.mark.parametrize("which", ["sf", "edge"])
def test_rollup_by_brute_force(spark, plain, edge_dir, which):
    at = SF if which == "sf" else edge_dir
    docs = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in spark.read.parquet(f"{at}/documents.parquet").collect()]
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{at}/labels.parquet").collect() if r["toxic"] == 1} - {None}
    got = llm.QUERIES["op9_token_counts"](spark, at).collect()
    assert {(r["source"], r["lang"]): (r["n_docs"], r["n_bytes"], r["n_tokens"]) for r in got} == totals(plain, docs, toxic)


def test_rollup_batches_count_once_and_groups_vanish(spark, edge_docs, tmp_path):
    facts = token_counts.count_tokens(edge_docs, tokenizer_path(), "v1").cache()
    rollup = token_counts.Rollup(spark, str(tmp_path / "rollup"))
    rollup.commit("1", token_counts.inserts(facts))
    once = sorted(map(str, rollup.totals().collect()))
    rollup.commit("1", token_counts.inserts(facts))
    assert sorted(map(str, rollup.totals().collect())) == once
    rollup.commit("2", token_counts.revisions(facts, facts.withColumn("tokenizer", facts["lang"])))
    assert {r["tokenizer"] for r in rollup.totals().collect()} == {r["lang"] for r in facts.collect()}
    rollup.commit("2", token_counts.deletes(facts))
    assert rollup.totals().collect() == []


def test_a_commit_that_is_ended_counts_nothing(spark, edge_docs, tmp_path, monkeypatch):
    facts = token_counts.count_tokens(edge_docs, tokenizer_path(), "v1").cache()
    rollup = token_counts.Rollup(spark, str(tmp_path / "rollup"))
    assert rollup.totals().collect() == []
    rollup.commit("1", token_counts.inserts(facts))
    once = sorted(map(str, rollup.totals().collect()))

    def ended(self, number, state):
        raise InterruptedError

    for batch in ("1", "2"):  # the delta is written, the commit is not
        with monkeypatch.context() as m:
            m.setattr(token_counts.Rollup, "_publish", ended)
            with pytest.raises(InterruptedError):
                rollup.commit(batch, token_counts.deletes(facts))
        assert sorted(map(str, rollup.totals().collect())) == once
    rollup.commit("2", token_counts.deletes(facts))
    assert rollup.totals().collect() == []


def test_folded_batches_count_once(spark, edge_docs, tmp_path):
    facts = token_counts.count_tokens(edge_docs, tokenizer_path(), "v1").cache()
    rollup = token_counts.Rollup(spark, str(tmp_path / "rollup"), fold_after=2)
    rollup.commit("a", token_counts.inserts(facts))
    once = sorted(map(str, rollup.totals().collect()))
    rollup.commit("b", token_counts.revisions(facts, facts))  # folds
    assert rollup._state()[1]["deltas"] == {} and rollup._state()[1]["folded"] == ["a", "b"]
    assert sorted(map(str, rollup.totals().collect())) == once
    for _ in range(3):
        rollup.commit("a", token_counts.inserts(facts))
    assert sorted(map(str, rollup.totals().collect())) == once
    rollup.commit("c", token_counts.deletes(facts))
    rollup.commit("d", token_counts.inserts(facts.limit(0)))
    assert rollup.totals().collect() == [] and rollup._state()[1]["folded"] == ["a", "b", "c", "d"]


def test_chunks_hold_every_row_once():
    rng = random.Random(3)
    batch = pa.RecordBatch.from_pydict({"text": ["x" * rng.randrange(100) if rng.random() < 0.9 else None for _ in range(200)]})
    parts = list(common.chunks(batch, limit=150))
    assert pa.Table.from_batches(parts).column(0).to_pylist() == batch.column(0).to_pylist()
    assert all(p.nbytes < 3000 for p in parts) and list(common.chunks(batch.slice(0, 0))) == []
