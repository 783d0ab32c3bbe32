from __future__ import annotations

import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns that the operators use inside: their names in a table must do no harm.
EXTRA = ["key", "node", "n", "size", "bucket", "digest", "file", "row", "shard", "slot", "ranges", "cells", "block",
         "copies", "comp", "gram", "score", "kept", "keep_id", "_place", "start", "length"]
TABLES = {"documents": DOCS, "labels": "doc_id bigint, quality int, toxic int", "benchmark": "item_id bigint, text string",
          "pages": "page_id bigint, url string, html string"}


def prose(seed: int, n: int, vocabulary: int = 500) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


def edge_rows():
    long_text = prose(1, 30_000, 5000)
    passage = prose(2, 60)
    rows = [
        (1, "One two three four five six seven.", "en", "a"), (2, None, "en", "a"), (3, "", None, None),
        (4, " \t\n ", "de", "a"), (5, "one TWO three four five six seven.", "en", None),
        (6, "One two  three\nfour five six seven.", "en", "a"), (7, long_text, "en", "b"), (7, long_text, "en", "b"),
        (7, "another text under the id of a long one", "en", "b"), (None, prose(3, 80), "en", "b"),
        (None, prose(3, 80), "en", "b"), (None, None, None, None), (8, "x<|endoftext|>y <|startoftext|>\x01 z\x01", "en", "a"),
        (9, "İ ΑΣΟΣ é ̸= ≠ don't I'LL 12ab　\xa0 zz… naïve—dash", "fr", "a"), (10, "123 ... 456 !!", "es", "a"),
        (11, "short one", "en", "a"), (12, "short one", "en", "a"), (13, "Short  one", "en", "a"),
        (14, prose(4, 50) + " " + passage + " " + prose(5, 50), "en", "a"),
        (15, prose(6, 50) + "\t" + passage + "\n" + prose(7, 50), "de", "c"),
        (16, "again " * 500, "en", "a"), (17, passage, "en", "a"), (18, passage + " end", "en", "a"),
        (-5, passage, "en", "a"), (19, "y" * 20_000, "en", "a"), (20, "le la les " * 40, "fr", "a"),
        (21, "der die das " * 40, "de", "a"), (22, "a b c d", "en", "a"), (23, "A b C d", "en", "a"),
    ]
    return [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]


@pytest.fixture(scope="session")
def edge_docs(spark, tmp_path_factory):
    """Nulls in any column, empty and very long texts, repeated rows and ids, clashing extra columns, as files."""
    path = str(tmp_path_factory.mktemp("edge") / "documents.parquet")
    df = spark.createDataFrame(edge_rows(), DOCS).repartition(3)
    df.selectExpr("*", *[f"'x' as `{c}`" for c in EXTRA]).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def edge_dir(spark, edge_docs, tmp_path_factory):
    path = tmp_path_factory.mktemp("edge_tables")
    edge_docs.write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame([(1, 0, 1), (2, None, 1), (None, 1, 1), (7, 1, 1), (9, 1, 0), (1, 0, 1)],
                          TABLES["labels"]).write.parquet(str(path / "labels.parquet"))
    spark.createDataFrame([(1, prose(2, 60)), (2, None), (3, ""), (4, "two words"), (None, prose(6, 30)),
                           (1, prose(2, 60))], TABLES["benchmark"]).write.parquet(str(path / "benchmark.parquet"))
    return str(path)


@pytest.fixture(scope="session")
def empty_dir(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("empty")
    for name, schema in TABLES.items():
        spark.createDataFrame([], schema).write.parquet(str(path / f"{name}.parquet"))
    return str(path)
