"""What the loader moves, stores and compiles."""

import contextlib
import io
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakesales import session
from lakesales.operators import validation as V
from lakesales.plans import loader as L
from lakesales.schemas import MSSQL_LOADER, MYSQL_LOADER
from lakesales.sources import csv_records, readers, splits
from lakesales.streaming import ingest
from table_rows import rows

GOOD = dict(zip(MSSQL_LOADER, ["ana@x.co", "Ana", "SKU-1", "", "2025-04-10", "WEB", "USD", "2", "1,200.50", "10", '{"a": "x, y"}']))


@pytest.fixture(scope="module")
def lookups(spark):
    return (spark.createDataFrame([(7, "ANA@x.co")], "ClienteID int, email string"),
            spark.createDataFrame([("MySQL", "ALT-1", "SKU-1")], "FuenteOrigen string, CodigoFuente string, SKU_Oficial string"),
            spark.createDataFrame([("SKU-1",)], "SKU_Oficial string"))


@pytest.fixture
def planned(spark):
    """Plans as for large tables, told at once."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)

    def plan(df, mode="simple"):
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            df.explain(mode=mode)
        return text.getvalue()

    yield plan
    for k, v in old.items():
        spark.conf.set(k, v)


def stored_rows(spark, path, names):
    spark.createDataFrame([("f", 1, *[GOOD.get(n, "1") for n in names])], ["_file", "_row", *names]).write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_errors_move_no_texts_that_only_rules_read(spark, lookups, planned, tmp_path):
    raw = stored_rows(spark, tmp_path / "r", MSSQL_LOADER)
    plan = planned(L.dry_run(L.check_rows(raw, "mssql", *lookups)))
    moved = [re.search(r"Project \[(.*)\]", below).group(1) for line, below in zip(plan.splitlines(), plan.splitlines()[1:])
             if "Exchange hashpartitioning" in line and "Project [" in below and "_own" in below]
    ends = [re.sub(r".* AS ", "", c).strip() for row in moved for c in re.split(r", (?=[A-Za-z_]+#)", row)]
    assert moved and not [c for c in ends if re.match(r"(MetadataJSON|Fecha|PrecioUnit|Qty|_fecha|_precio|_common)", c)]


@pytest.mark.parametrize("kind", ["mssql", "mysql"])
def test_checks_are_short_enough_for_the_compiler(spark, lookups, planned, tmp_path, kind):
    raw = stored_rows(spark, tmp_path / "r", {"mssql": MSSQL_LOADER, "mysql": MYSQL_LOADER}[kind])
    sizes = re.findall(r"maxMethodCodeSize:(\d+)", planned(L.dry_run(L.check_rows(raw, kind, *lookups)), "codegen"))
    assert sizes and max(map(int, sizes)) < 8000  # bytes of a method that the JVM compiles


def test_rows_stay_where_they_are_when_numbered(spark, planned, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,x\n\n2,y\n")
    (tmp_path / "b.csv").write_text("a,b\n3,z\n")
    df = readers.read_loader_csv(spark, str(tmp_path))
    assert "BroadcastHashJoin" in planned(df) and rows(df.select("a", "_row"), "a") == [("1", 1), ("2", 2), ("3", 1)]


def test_many_rules_keep_their_order(spark):
    rules = [V.Rule(f"f{i}", "r", str(i), F.col("id") != i % 2) for i in range(130)]
    got = V.with_errors(spark.range(2), rules).orderBy("id").collect()
    assert [[e.message for e in r.errors] for r in got] == [[str(i) for i in range(n, 130, 2)] for n in (0, 1)]
    assert V.with_errors(spark.range(1), []).first().errors == [] and got[0].asDict().keys() == {"id", "errors"}
    with pytest.raises(ValueError):
        V.broken_rules(rules)


def test_checked_rows_are_stored_once(spark, lookups, tmp_path, monkeypatch):
    raw = stored_rows(spark, tmp_path / "r", MSSQL_LOADER)
    names = []
    monkeypatch.setattr(L, "scratch_path", lambda s, name: names.append(name) or session.scratch_path(s, name))
    done = L.run_import(L.check_rows(raw, "mssql", *lookups), "mssql", "skip_bad", str(tmp_path / "out"))
    assert names == ["checked"] and done["checked"].count() == done["accepted"].count() == 1
    assert L.accepted_rows(done["checked"].select(*L.TARGET, "errors"), "all_or_nothing").first().ClienteID == 7


def test_records_are_stored_once(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text('a,b\n1,"x\n2"\n')
    names = []
    for module in (csv_records, splits):
        monkeypatch.setattr(module, "scratch_path", lambda s, name: names.append(name) or session.scratch_path(s, name))
    got, _ = csv_records.read_mapped(spark, [str(tmp_path / "a.csv")], ["b", "a"], ["a"])
    assert rows(got.select("_row", "a", "b")) == [(1, "1", "x\n2")]
    assert sorted(names) == ["begins", "effects", "ends", "headers", "places", "records", "rows"]


def test_a_batch_leaves_no_tables_behind(spark, lookups, tmp_path, monkeypatch):
    made = []
    monkeypatch.setattr(ingest, "scratch_path", lambda s, name: made.append(session.scratch_path(s, name)) or made[-1])
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("ClienteEmail,Qty\nana@x.co,0\n")
    ingest.ingest_files(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"), MSSQL_LOADER,
                        lambda raw: L.check_rows(raw, "mssql", *lookups)).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out" / "rejected")).count() == 1
    assert [p.rsplit("/", 1)[1] for p in made] == ["files", "checked"]
    assert not [p for p in made if Path(p.removeprefix("file://")).exists()]
    kept = session.scratch_path(spark, "kept")  # outside of a batch nothing goes
    spark.range(1).write.parquet(kept)
    with session.passing_scratch(spark):
        spark.range(1).write.parquet(session.scratch_path(spark, "gone"))
    assert spark.read.parquet(kept).count() == 1
