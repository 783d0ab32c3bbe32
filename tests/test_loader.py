from __future__ import annotations

import csv

import pytest
from pyspark.sql import functions as F

from table_rows import rows
from lakesales.operators.aggregates import error_summary
from lakesales.plans import loader as L
from lakesales.schemas import MSSQL_LOADER
from lakesales.sources import sinks
from lakesales.sources.readers import read_loader_csv
from lakesales.streaming.ingest import ingest_files

GOOD = ["ana@x.co", "Ana", "SKU-1", "", "2025-04-10", "WEB", "USD", "2", "1,200.50", "10", '{"a": "x, y"}']
# position of the wrong field, its text, the rule that finds it
MISTAKES = [(0, "who@x.co", "reference"), (2, "SKU-9", "reference"), (7, "0", "range"), (8, "-1", "range"), (9, "101", "range"),
            (5, "FAX", "one_of"), (6, "EUR", "one_of"), (4, "2025-13-40", "format"), (10, '{"a":', "json"), (0, "", "required")]


def hundred_rows():
    data = [list(GOOD) for _ in range(100)]
    for n, (field, value, _) in enumerate(MISTAKES):
        data[n * 10 + 3][field] = value
    return data


@pytest.fixture(scope="module")
def lookups(spark):
    return (spark.createDataFrame([("Ana@x.co", 7), ("ana@x.co", 9)], "email string, ClienteID int"),
            spark.createDataFrame([("MySQL", "ALT-1", "SKU-1")], "FuenteOrigen string, CodigoFuente string, SKU_Oficial string"),
            spark.createDataFrame([("SKU-1",)], "SKU_Oficial string"))


def write(path, header, data, blank_at=50):
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(header)
        for n, row in enumerate(data):
            if n == blank_at:
                f.write("\n")
            out.writerow(row)


@pytest.fixture(scope="module")
def checked(spark, lookups, tmp_path_factory):
    file = tmp_path_factory.mktemp("up") / "up.csv"
    write(file, MSSQL_LOADER, hundred_rows())
    return L.check_rows(read_loader_csv(spark, str(file)), "mssql", *lookups).cache()


def test_hundred_rows_ten_bad(checked):
    report = L.dry_run(checked)
    assert rows(report.select("row", "rule"), "row") == [(n * 10 + 4, m[2]) for n, m in enumerate(MISTAKES)]
    good = L.accepted_rows(checked, "skip_bad")
    first = good.orderBy("_row").first()
    assert good.count() == 90 and (first.ClienteID, first.SKU_Oficial, str(first.PrecioUnit)) == (7, "SKU-1", "1200.50")
    assert L.accepted_rows(checked, "all_or_nothing").count() == 0
    done = L.summary(checked, chunk_rows=25).orderBy("chunk").collect()
    assert [(r.inserted + r.rejected) for r in done] == [25] * 4 and sum(r.rejected for r in done) == 10
    top = error_summary(report).orderBy("row").collect()
    assert len(top) == 10 and top[0].errores == 10 and top[0].mas == 0 and top[0].message == "Cliente not found"


def test_failed_rows_can_be_repaired_and_loaded(spark, checked, lookups, tmp_path):
    sinks.write_rejects(L.failed_rows(checked, "mssql"), str(tmp_path / "failed"))
    back = read_loader_csv(spark, str(tmp_path / "failed"))
    assert back.count() == 10 and rows(back.where("DescuentoPct = '101'").select("error")) == [
        ("DescuentoPct must be >= 0 and <= 100",)]
    repaired = L.check_rows(back.drop("_row", "_file").withColumns(
        {c: F.lit(v) for c, v in zip(MSSQL_LOADER, GOOD)}).withColumns({"_row": F.lit(1), "_file": F.lit("f")}), "mssql", *lookups)
    assert L.accepted_rows(repaired, "all_or_nothing").count() == 10


def test_other_headers(spark, lookups, tmp_path):
    file = tmp_path / "up.csv"
    names = ["cliente_email", "Nombre", "sku", "codigo alt", "FECHA(ISO)", "canal", "moneda", "cuantos", "PrecioUnit(USD)",
             "descuento_pct", "metadata json"]
    order = list(reversed(range(11)))
    write(file, [names[i] for i in order], [[row[i] for i in order] for row in hundred_rows()])
    raw = read_loader_csv(spark, str(file))
    assert L.check_rows(raw, "mssql", *lookups, mapping={"cuantos": "Qty"}).where(F.size("errors") == 0).count() == 90
    unmapped = L.dry_run(L.check_rows(raw, "mssql", *lookups))
    assert unmapped.where("field = 'Qty' and rule = 'required'").count() == 100


def test_mysql_layout(spark, lookups, tmp_path):
    file = tmp_path / "up.csv"
    header = ["cliente_email", "producto_codigo_alt", "fecha", "canal", "moneda", "total", "precio_unit", "cantidad", "metadata"]
    good = ["ana@x.co", "alt-1", "2025-04-10 13:20:00", "sucursal 3", "CRC", "84,500", "12,000", "2", ""]
    bad = [[*good[:5], "mil", *good[6:]], [*good[:7], "1.5", ""], [good[0], "ALT-9", *good[2:]]]
    write(file, header, [good, *bad])
    checked = L.check_rows(read_loader_csv(spark, str(file)), "mysql", *lookups)
    first = L.accepted_rows(checked, "skip_bad").collect()
    assert [(r._row, str(r.PrecioUnit), r.Canal, r.Moneda) for r in first] == [(1, "12000.00", "SUCURSAL 3", "CRC")]
    assert rows(L.dry_run(checked).select("row", "field", "rule")) == [
        (2, "total", "format"), (3, "cantidad", "format"), (4, "producto_codigo_alt", "reference")]


def test_ingest_resumes(spark, lookups, tmp_path):
    inbox, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    inbox.mkdir()
    data = hundred_rows()
    write(inbox / "a.csv", MSSQL_LOADER, data[:60])

    def run():
        ingest_files(spark, str(inbox), out, checkpoint, MSSQL_LOADER, lambda raw: L.check_rows(raw, "mssql", *lookups),
                     files_per_batch=1).awaitTermination()

    run()
    assert spark.read.parquet(f"{out}/accepted").count() == 54
    write(inbox / "b.csv", MSSQL_LOADER, data[60:])
    run()
    run()  # nothing new
    accepted, rejected = spark.read.parquet(f"{out}/accepted"), spark.read.parquet(f"{out}/rejected")
    assert (accepted.count(), rejected.count()) == (90, 10)
    assert accepted.select("batch_id").distinct().count() == 2
    assert spark.read.parquet(f"{out}/log").agg(F.sum("inserted"), F.sum("rejected")).first() == (90, 10)
    assert accepted.groupBy("_file").agg(F.max("_row").alias("m")).agg(F.max("m")).first()[0] == 60
