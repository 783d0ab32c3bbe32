"""Readers of large files against simple ones, with splits so small that records lie over several of them."""

from __future__ import annotations

import csv
import json
import random

import pytest
from pyspark.sql import functions as F

from lakesales.schemas import MSSQL_LOADER
from lakesales.sources import readers
from lakesales.sources.csv_records import read_mapped
from lakesales.sources.json_array import read_array
from lakesales.streaming.ingest import ingest_files
from table_rows import rows


@pytest.fixture
def split_bytes(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")

    def set_to(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield set_to
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    spark.conf.unset("spark.sql.files.openCostInBytes")


TEXTS = ["", "}", "{", "]", "[", "\\", '"', '\\"', "a}b{c", "},{", '"},{"', "\\}", "é ☃ }", "\n}\t", "x" * 300, "\\\\\"}"]


def value(rng, depth=0):
    kind = rng.randrange(5 if depth < 3 else 3)
    if kind == 0:
        return rng.choice(TEXTS)
    if kind == 1:
        return rng.randrange(1000)
    if kind == 2:
        return rng.choice([None, True, 1.5])
    if kind == 3:
        return [value(rng, depth + 1) for _ in range(rng.randrange(3))]
    return {rng.choice(["a", "b}", '"', "c{"]): value(rng, depth + 1) for _ in range(rng.randrange(3))}


@pytest.mark.parametrize("size", [1 << 20, 2000, 97, 40])
def test_arrays_are_read_alike_in_any_splits(spark, tmp_path, split_bytes, size):
    rng = random.Random(1)
    files = []
    for k, (indent, separators) in enumerate([(None, (",", ":")), (2, None), (None, None)]):
        records = [{"k": k, "i": i, "v": value(rng)} for i in range(60)]
        text = json.dumps(records, indent=indent, separators=separators, ensure_ascii=k == 0)
        (tmp_path / f"f{k}.json").write_text(("﻿" if k == 1 else "") + text + ("\n" if k == 2 else ""), "utf-8")
        files += records
    (tmp_path / "empty.json").write_text("[]")
    (tmp_path / "blank.json").write_text(" [ \n ] \n")
    split_bytes(size)
    df = read_array(spark, str(tmp_path))
    got = [json.loads(r["texto"]) for r in df.collect()]
    assert sorted(got, key=lambda r: (r["k"], r["i"])) == files


def test_splits_are_many_and_none_is_larger(spark, tmp_path, split_bytes):
    records = [{"anio": 2024, "mes": 1 + i % 12, "ventas": [{"item": f"P{i}", "cantidad": 1, "precio": 2}]} for i in range(2000)]
    (tmp_path / "a.json").write_text(json.dumps(records))
    size = (tmp_path / "a.json").stat().st_size
    split_bytes(size // 16 + 1)
    scan = spark.read.text(str(tmp_path), lineSep="}")
    assert scan.rdd.getNumPartitions() >= 16
    got = readers.read_agg_sales(spark, str(tmp_path), json_lines=False)
    assert rows(got.selectExpr("mes", "ventas[0].item")) == sorted(((1 + i % 12, f"P{i}") for i in range(2000)), key=repr)


@pytest.mark.parametrize("text,good,bad", [
    ('[{"anio": 1, "mes": 2}, {"anio": 2, "mes": 3', [(1, 2)], 1),
    ('[{"anio": 1, "mes": 2}, 7, {"anio": 2, "mes": 3}]', [(1, 2)], 1),
    ('[{"anio": 1, "mes": 2}, 7]', [(1, 2)], 1),
    ('[{"anio": "x", "mes": 2}]', [], 1),
    ('[{"anio": 1, "mes": 2}, {"anio": 1, "mes": 3}', [(1, 2)], 1),
    ("", [], 0)])
def test_what_is_no_record_is_kept_as_text(spark, tmp_path, split_bytes, text, good, bad):
    (tmp_path / "a.json").write_text(text)
    for size in (1 << 20, 10):
        split_bytes(size)
        df = readers.read_agg_sales(spark, str(tmp_path), json_lines=False, corrupt=True)
        whole, broken = readers.split_corrupt(df)
        assert rows(whole.select("anio", "mes")) == good and broken.count() == bad


# --- CSV -------------------------------------------------------------------------------------------------


FIELDS = ["a", "", "x y", 'say "hi"', "1,5", "two\nlines", '"', '""', 'end"', "\n", ',"', '",', "\n\n\n", '"\n"', "é"]


def write_csv(path, table, terminator="\n", stray=False):
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f, lineterminator=terminator).writerows(table)
        if stray:  # a quote inside a bare field is a character like any other
            f.write(f'{len(table)},5" pipe,b"c""{terminator}{terminator}{len(table) + 1},z,"y"{terminator}')


@pytest.mark.parametrize("size", [1 << 20, 700, 31])
def test_csv_records_are_read_alike_in_any_splits(spark, tmp_path, split_bytes, size):
    rng = random.Random(2)
    want = []
    for k, terminator in enumerate(["\n", "\r\n"]):
        table = [["k", "x", "y"]] + [[f"{k}-{i}", rng.choice(FIELDS), rng.choice(FIELDS)] for i in range(120)]
        write_csv(tmp_path / f"f{k}.csv", table, terminator)
        want += [(i, *r) for i, r in enumerate(table[1:], 1)]
    split_bytes(size)
    df = readers.read_loader_csv(spark, str(tmp_path), multiline=True)
    got = sorted((r["_row"], r["k"], r["x"] or "", r["y"] or "") for r in df.collect())
    assert got == sorted(want)


def test_bare_quotes_and_blank_lines(spark, tmp_path, split_bytes):
    write_csv(tmp_path / "a.csv", [["k", "x", "y"], ["1", "q", 'w"']], stray=True)
    for size in (1 << 20, 9):
        split_bytes(size)
        df = readers.read_loader_csv(spark, str(tmp_path), multiline=True)
        assert rows(df.select("_row", "k", "x", "y")) == [(1, "1", "q", 'w"'), (2, "2", '5" pipe', 'b"c""'), (3, "3", "z", "y")]


def test_files_with_headers_of_their_own(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿Fecha (ISO),"Qty"\n2024-01-01,"1\n"\n')
    (tmp_path / "b.csv").write_text("qty,extra,FECHA\n2,x,2024-01-02\n3\n")
    (tmp_path / "c.csv").write_text("foo,bar\n1,2\n")
    (tmp_path / "d.csv").write_text("Qty,Qty\n1,2\n")
    (tmp_path / "e.csv").write_text("Qty,\n1,2\n")
    (tmp_path / "f.csv").write_text("\n\n")
    got, judged = read_mapped(spark, [str(tmp_path / f"{c}.csv") for c in "abcdef"], ["Fecha", "Qty"], ["fecha", "qty", "Fecha (ISO)"])
    assert rows(got.select("_row", "Fecha", "Qty")) == [
        (1, "2024-01-01", "1\n"), (1, "2024-01-02", "2"), (2, None, "3")]
    assert rows(judged.selectExpr("right(_file, 5)", "motivo")) == [
        ("a.csv", None), ("b.csv", None), ("c.csv", "no known column"), ("d.csv", "column names repeat or are empty"),
        ("e.csv", "column names repeat or are empty")]


def jobs_of(spark, base, **bound):
    query = ingest_files(spark, f"{base}/in", f"{base}/out", f"{base}/cp", ["Qty", "Fecha"], lambda raw: raw.withColumns({
        "errors": F.array().cast("array<struct<message:string>>"), "_cliente": F.lit(1), "SKU_Oficial": F.lit("s"),
        **{c: F.lit(None) for c in ("_fecha", "_canal", "_moneda", "_cantidad", "_precio", "_descuento")},
        **{c: F.lit(None).cast("string") for c in MSSQL_LOADER if c not in raw.columns}}), **bound)
    query.awaitTermination()
    assert query.exception() is None
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(str(query.runId))), query


def test_the_number_of_jobs_does_not_grow_with_the_files(spark, tmp_path):
    counts = []
    for n in (40, 120):
        base = tmp_path / str(n)
        (base / "in").mkdir(parents=True)
        for i in range(n):
            (base / "in" / f"{i}.csv").write_text(f"Qty,Fecha\n{i},2024-01-01\n" if i % 2 else f"fecha,qty\n2024-01-01,{i}\n")
        jobs, _ = jobs_of(spark, base)
        counts.append(jobs)
        assert spark.read.parquet(f"{base}/out/accepted").count() == n
    assert counts[0] == counts[1]


def test_batches_are_bounded_by_bytes(spark, tmp_path, split_bytes):
    """One large file among small ones: a batch of its own, read in many splits."""
    (tmp_path / "in").mkdir()
    for i in range(20):
        (tmp_path / "in" / f"s{i}.csv").write_text(f"Qty\n{i}\n")
    (tmp_path / "in" / "large.csv").write_text("Qty\n" + "".join(f"{i}\n" for i in range(5000)))
    split_bytes(4000)
    _, query = jobs_of(spark, tmp_path, bytes_per_batch=60)
    batches = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert len(batches) > 2 and sum(batches) == 21
    assert spark.read.parquet(f"{tmp_path}/out/accepted").count() == 5020


def test_lines_and_pieces_of_large_files_are_not_shuffled(spark, tmp_path, monkeypatch):
    from lakesales.sources import csv_records, json_array, splits

    plans, write = [], csv_records.write_table

    def spy(df, *args, **kwargs):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, *args, **kwargs)

    for module in (csv_records, json_array, splits):
        monkeypatch.setattr(module, "write_table", spy, raising=False)
    (tmp_path / "a.csv").write_text('a,b\n1,"x\ny"\n2,z\n')
    (tmp_path / "a.json").write_text('[{"a": "}"}, {"a": 2}]')
    assert rows(csv_records.csv_records(spark, str(tmp_path / "a.csv")).select("_n", "texto")) == [
        (1, "a,b"), (2, '1,"x\ny"'), (3, "2,z")]
    assert rows(read_array(spark, str(tmp_path / "a.json")).select("texto")) == [('{"a": "}"}',), ('{"a": 2}',)]
    reads = [p for p in plans if "FileScan text" in p]
    assert len(reads) >= 4 and not any("hashpartitioning" in p for p in reads)
