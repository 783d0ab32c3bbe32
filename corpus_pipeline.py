"""A corpus pipeline over `documents`: each stage works on what the one before it kept.

ORACLE_SQL is None: no SQL expresses the language profiles or the tokenizer. tests/llm holds run() against a
brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakesales.llm import decontamination, exact_dedup, language_id, ngram_join, packing
from lakesales.llm.tokens import tokenizer_path
from lakesales.session import scratch_path

#: A text that is as far from every language as this is in none of them.
LEAST_SCORE = 0.1
CAPACITY, END_ID = 4096, 1


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language stay: those without letters, null and empty texts among them, and those near no
    profile, go. Profiles are learned from all documents with a language; a document's own language, source and id
    decide nothing. As in all filters, rows that stay keep all their columns, repeated rows are judged alike, and an
    empty table stays empty; where no row has a language, none is known and all go."""
    return language_id.keep_known(docs, language_id.learn_profiles(docs), LEAST_SCORE)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (white space aside) the document with the smallest id stays, of rows with that id the first by
    file and row; rows without an id come last. Null counts as empty, and empty texts are one group."""
    return exact_dedup.drop_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays, whatever ids repeat or lack. Null and
    empty texts are linked with nothing and stay."""
    return ngram_join.drop_near_copies(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item, edited or not, go. Null and empty texts hold none and stay; so do all documents
    where the benchmark is empty or has no words."""
    return decontamination.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left, and where they lie in sequences. Null counts as empty: a piece of the end id
    alone. Repeated rows are pieces of their own; no documents give no pieces."""
    return packing.pack(docs, tokenizer_path(), END_ID, CAPACITY)


STAGES = [("language ID", language_stage), ("exact dedup", exact_dedup_stage),
          ("n-gram Jaccard join", near_dedup_stage), ("benchmark decontamination", decontamination_stage),
          ("best-fit packing", packing_stage)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
