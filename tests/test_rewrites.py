"""Stored tables changed in some partitions only, and snapshots compared by digests."""

from __future__ import annotations

import glob
import random
import re

import pytest
from pyspark.sql import functions as F

from lakesales.operators import changes as U
from lakesales.operators.ranked import page_at, store_ranked
from lakesales.sources import sinks
from table_rows import rows



def ts():
    return F.lit("2024-06-01").cast("timestamp")


def files(path):
    return {f.removeprefix(f"{path}/") for f in glob.glob(f"{path}/*/*.parquet")}


@pytest.fixture
def stored(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(100).select("id", (F.col("id") * 2).alias("v"), F.lit(None).cast("timestamp").alias("actualizado"),
                                 F.when(F.col("id") < 90, F.col("id") % 4).alias("p"))
    sinks.write_table(df, path, partition_by=["p"])
    return path


def test_only_partitions_with_patched_keys_are_written(spark, stored):
    before = files(stored)
    patches = spark.createDataFrame([(1, 7), (5, 7), (95, 7), (1000, 7)], "id bigint, v bigint")
    done = U.patch_table(spark, stored, ["p"], patches, "id", ts())
    assert rows(done) == [(1,), (None,)]
    after = files(stored)
    assert {f.split("/")[0] for f in before ^ after} == {"p=1", "p=__HIVE_DEFAULT_PARTITION__"}
    got = spark.read.parquet(stored)
    assert rows(got.select("id", "v"), "id") == [(i, 7 if i in (1, 5, 95) else 2 * i) for i in range(100)]
    assert got.where("actualizado is not null").count() == 3
    assert U.patch_table(spark, stored, ["p"], patches.where("id = 1000"), "id", ts()).count() == 0
    assert files(stored) == after


def test_a_patch_cannot_move_a_row(spark, stored):
    with pytest.raises(ValueError):
        U.patch_table(spark, stored, ["p"], spark.createDataFrame([(1, 2)], "id bigint, p bigint"), "id", ts())


def test_a_rewrite_that_was_ended_is_finished_by_the_next(spark, stored):
    patches = spark.createDataFrame([(1, 7)], "id bigint, v bigint")
    # ended after the new rows lie beside the table, before any old file is gone
    spark.read.parquet(stored).where("p = 1").withColumn("v", F.lit(9).cast("bigint")).write.partitionBy("p").parquet(f"{stored}__rewritten")
    U.patch_table(spark, stored, ["p"], patches, "id", ts())
    got = dict(rows(spark.read.parquet(stored).where("p = 1").select("id", "v")))
    assert got.pop(1) == 7 and set(got.values()) == {9} and len(got) == 22
    assert spark.read.parquet(stored).count() == 100 and not glob.glob(f"{stored}__rewritten")


def test_upserts_write_buckets_of_incoming_members_only(spark, tmp_path):
    path = str(tmp_path / "dim")
    dim = spark.range(1, 201).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("nat"), F.lit("a").alias("x"),
                                     F.lit("2020-01-01").cast("timestamp").alias("FechaCreacion"),
                                     F.lit("2020-01-01").cast("timestamp").alias("FechaActualizacion"))
    sinks.write_table(U.dim_buckets(dim, ["nat"], 32), path, partition_by=["cubeta"])
    before = files(path)
    incoming = spark.createDataFrame([("n5", "b"), ("n6", "a"), ("new1", "c"), ("new2", "c")], "nat string, x string")
    done = {r[0] for r in U.upsert_table(spark, path, incoming, ["nat"], "k", ts(), 32).collect()}
    assert {int(f.split("/")[0].split("=")[1]) for f in before ^ files(path)} <= done and len(done) <= 4
    got = spark.read.parquet(path)
    assert got.count() == 202 and rows(got.where("x <> 'a'").select("nat", "x", (F.col("k") > 200).alias("n"))) == [
        ("n5", "b", False), ("new1", "c", True), ("new2", "c", True)]
    assert rows(got.where("k > 200").select("k")) == [(201,), (202,)]
    assert got.where("FechaActualizacion > '2021-01-01'").count() == 3


@pytest.mark.parametrize("buckets", [1, 8, 4096])
def test_snapshots_by_brute_force(spark, buckets):
    rng = random.Random(buckets)

    def value():
        return (rng.choice([None, 0, 1]), rng.choice([None, "", "a"]), rng.choice([None, [], [None, "a"], ["a", None]]),
                rng.choice([None, {"k": None}, {}, {"k": 1}]))

    a = {i: value() for i in range(300)}
    b = {i: a[i] if i in a and rng.random() < 0.9 else value() for i in range(20, 320)}
    schema = "id int, x int, s string, l array<string>, m map<string,int>"
    left, right = (spark.createDataFrame([(i, *v) for i, v in t.items()], schema) for t in (a, b))
    # a map cannot be compared as such
    left, right = (df.withColumn("m", F.to_json(F.struct("m"), {"ignoreNullFields": "false"})) for df in (left, right))
    want = sorted((i, "deleted" if i not in b else "inserted" if i not in a else "unchanged" if a[i] == b[i] else "modified")
                  for i in a.keys() | b.keys())
    assert rows(U.compare_snapshots(left, right, "id", buckets), "id") == want


def test_values_that_change_places_are_seen(spark):
    a = spark.createDataFrame([(1, 5, None), (2, None, None)], "id int, x int, y int")
    b = spark.createDataFrame([(1, None, 5), (2, None, None)], "id int, x int, y int")
    assert rows(U.compare_snapshots(a, b, "id"), "id") == [(1, "modified"), (2, "unchanged")]
    nobody = spark.createDataFrame([(None, 1, 1)], "id int, x int, y int")
    assert rows(U.compare_snapshots(nobody, nobody, "id")) == [(None, "deleted"), (None, "inserted")]


def test_only_buckets_that_differ_are_compared_in_full(spark):
    a = spark.range(20_000).select("id", (F.col("id") * 3).alias("v"))
    b = a.withColumn("v", F.when(F.col("id").isin(17, 4711), 0).otherwise(F.col("v")))
    changed = U.changed_buckets(a, b, "id", 1000)
    assert changed.count() == 2
    held = a.join(changed, U._bucket("id", 1000) == F.col("_bucket"), "left_semi").count()
    assert held < 100
    out = U.compare_snapshots(a, b, "id", 1000)
    assert rows(out.groupBy("estado").count()) == [("modified", 2), ("unchanged", 19_998)]


def test_pages_by_rank_read_their_ranges_only(spark, tmp_path):
    path = str(tmp_path / "list")
    values = [(i, random.Random(i).choice([None, 1, 2, 3])) for i in range(1000)]
    df = spark.createDataFrame(values, "id int, v int").repartition(5)
    store_ranked(df, path, [F.col("v").desc_nulls_last(), F.asc("id")], 90)
    want = sorted(values, key=lambda r: (-(r[1] or -9), r[0]))
    for page, limit in [(1, 20), (7, 20), (50, 20), (10, 100), (51, 20)]:
        got = page_at(spark, path, page, limit)
        assert [(r["id"], r["v"]) for r in got.collect()] == want[(page - 1) * limit:page * limit]
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^\]]*_range", plan) or page == 51
    row = page_at(spark, path, 7, 20).first()
    assert (row["puesto"], row["total"], row["pages"]) == (121, 1000, 50)
    store_ranked(df.limit(0), path, [F.asc("id")])
    assert page_at(spark, path, 1, 20).collect() == []
