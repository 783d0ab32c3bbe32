from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from table_rows import rows
from lakesales.operators import aggregates as A
from lakesales.operators import changes as U
from lakesales.operators import filters as Q
from lakesales.operators import joins as J
from lakesales.operators import keys as K
from lakesales.operators import validation as V
from lakesales.functions import nested as N
from lakesales.schemas import GRAPH_ORDER


# --- as-of ------------------------------------------------------------------------------------
def brute(left, right, strict):
    out = []
    for i, k, t in left:
        fit = [(rt, v) for rk, rt, v in right if rk == k and k is not None and t is not None and rt is not None
               and (rt < t if strict else rt <= t)]
        last = max((rt for rt, _ in fit), default=None)
        ties = [v for rt, v in fit if rt == last]
        # of equal times the greatest wins, NULL counts least
        out.append((i, k, max(ties, key=lambda v: (v is not None, v or 0)) if ties else None, bool(fit)))
    return sorted(out, key=repr)


KEY = st.sampled_from(["a", "b", "c", None])
TIME = st.one_of(st.none(), st.integers(0, 12))


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(KEY, TIME), max_size=25), st.lists(st.tuples(KEY, TIME, st.one_of(st.none(), st.integers(0, 9))), max_size=25),
       st.booleans(), st.sampled_from([1, 2, 7]))
def test_asof_matches_brute_force(spark, left, right, strict, slices):
    left = [(i, k, t) for i, (k, t) in enumerate(left)]
    lf = spark.createDataFrame(left, "i int, k string, t int")
    rf = spark.createDataFrame(right, "k string, rt int, v int")
    got = J.asof_backward(lf, rf, "t", "rt", ["v"], by=["k"], strict=strict, slices=slices, found="hit")
    assert rows(got.select("i", "k", "v", "hit")) == brute(left, right, strict)


def test_asof_without_key_and_null_value(spark):
    day = dt.date(2024, 1, 1)
    left = spark.createDataFrame([(day + dt.timedelta(n),) for n in range(6)], "d date")
    right = spark.createDataFrame([(day, 1.0), (day + dt.timedelta(2), None), (day + dt.timedelta(4), 3.0)], "f date, r double")
    for slices in (1, 3, 10):
        got = J.asof_backward(left, right, "d", "f", ["r"], slices=slices).orderBy("d")
        assert [r.r for r in got.collect()] == [None, 1.0, 1.0, None, None, 3.0]


def test_asof_with_hot_key_of_copies(spark):
    """Two thirds of the rows share one key, half of those one time."""
    base = dt.datetime(2024, 1, 1)
    left = [(0, base + dt.timedelta(seconds=5))] * 300 + [(0, base + dt.timedelta(seconds=n)) for n in range(300)] + [
        (n % 50 + 1, base + dt.timedelta(seconds=n)) for n in range(300)]
    lf = spark.createDataFrame(left, "k int, t timestamp_ntz")
    rf = lf.select("k", F.col("t").alias("rt"), F.col("t").alias("v"))
    got = J.asof_backward(lf, rf, "t", "rt", ["v"], by=["k"], slices=8)
    times = {}
    for k, t in left:
        times.setdefault(k, set()).add(t)
    want = sorted((k, t, max((x for x in times[k] if x < t), default=None)) for k, t in left if True)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)


# --- keys and groups --------------------------------------------------------------------------
def test_assign_keys_dense_and_repeatable(spark):
    df = spark.range(5000).select(F.concat(F.lit("c"), "id").alias("code"))
    a = {r.code: r.k for r in K.assign_keys(df, ["code"], "k", start=10).collect()}
    b = {r.code: r.k for r in K.assign_keys(df.repartition(7), ["code"], "k", start=10).collect()}
    assert a == b and sorted(a.values()) == list(range(10, 5010))


def test_keys_do_not_depend_on_the_number_of_buckets(spark):
    df = spark.range(500).select(F.concat(F.lit("c"), "id").alias("code"))
    got = [{r.code: r.k for r in K.assign_keys(df, ["code"], "k", chars=n).collect()} for n in (1, 3, 5)]
    assert got[0] == got[1] == got[2]


def test_repeated_patches_need_an_order(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    patches = spark.createDataFrame([(1, "x", 1), (1, "y", 2)], "id int, v string, n int")
    assert rows(U.apply_patches(base, patches, "id", F.current_timestamp(), order="n")) == [(1, "y"), (2, "b")]
    with pytest.raises(Exception, match="several rows for one key"):
        U.apply_patches(base, patches, "id", F.current_timestamp()).collect()


def test_numbers_within_a_key_have_no_gaps(spark):
    """One key and one exact copy hold most of the rows; a NULL key is a group too."""
    data = [("hot", 1)] * 400 + [("hot", n) for n in range(200)] + [("cold", n) for n in range(50)] + [(None, 7)] * 150
    df = spark.createDataFrame(data, "k string, v int").repartition(5)
    got = K.number_within(df, ["k"], [F.col("v")], "n").collect()
    for k in ("hot", "cold", None):
        own = sorted((r.n, r.v) for r in got if r.k == k)
        assert [n for n, _ in own] == list(range(1, len(own) + 1))
        assert [v for _, v in own] == sorted(v for x, v in data if x == k)


@pytest.mark.parametrize("bound", [3, 100, 10_000])
def test_documents_of_any_bound_hold_the_same_lines(spark, bound):
    df = spark.range(1000).select(F.when(F.col("id") % 10 < 7, 1).otherwise(F.col("id") % 30 * 100).alias("o"), "id")
    nested = K.nest_items(df, ["o"], F.struct("id"), max_items=bound)
    parts = {}
    for r in nested.collect():
        parts.setdefault(r.o, []).append((r.parte, r.primera, len(r["items"])))
    for own in parts.values():
        own.sort()
        assert [p for p, _, _ in own] == list(range(len(own))) and all(n == bound for _, _, n in own[:-1])
        assert all(first == p * bound + 1 for p, first, _ in own)
    lines = N.explode_items(nested)
    want = {}
    for r in df.orderBy("id").collect():
        want.setdefault(r.o, []).append(r.id)
    assert sorted(tuple(r) for r in lines.select("o", "linea", "id").collect()) == sorted(
        (o, i, v) for o, ids in want.items() for i, v in enumerate(ids, 1))


def test_edges_of_an_order_in_parts(spark):
    df = spark.createDataFrame([(("c", "n", None), ("o", "d", "w", "m", None), [(("p", "x", "y"), 1, None)])] * 2, GRAPH_ORDER)
    got = sorted(r.type for r in N.graph_edges(df).collect())
    assert got == ["CONTIENE", "CONTIENE", "REALIZADA_POR"]


def test_amounts_are_rounded_once(spark):
    from lakesales.functions import money

    df = spark.range(1).select(
        F.lit("1.005").cast("decimal(18,3)").alias("p"), F.lit(2.5).alias("half"), F.lit(3).alias("q"),
        F.lit("33.333").cast("decimal(9,3)").alias("d"), F.lit("0.01").cast("decimal(18,2)").alias("cent"),
        F.lit("50.10").cast("decimal(9,2)").alias("more"))
    got = df.select(money.from_cents(money.net_cents("p", "q", "d")), money.net_cents("p", "half", "d"),
                    money.cents_to_usd(money.net_cents("cent", F.lit(1), "more"), F.lit("USD"), F.lit(None))).first()
    assert [None if x is None else str(x) for x in got] == ["2.01", None, "0.00"]


# --- joins ------------------------------------------------------------------------------------
def test_lookup_does_not_double_rows(spark):
    fact = spark.createDataFrame([("C1",), ("c1 ",)], "code string")
    dim = spark.createDataFrame([("C1", 7), ("c1 ", 3)], "c string, k int")
    assert rows(J.star_lookup(fact, dim, F.col("code"), "c", ["k"])) == [("C1", 3), ("c1 ", 3)]
    assert rows(V.code_conflicts(dim, "c")) == [("C1", 2)]


def test_page_after_parts_equal_values_and_ends_with_nulls(spark):
    df = spark.createDataFrame([(i, i // 4 if i < 10 else None) for i in range(14)], "id int, v int")
    seen, last, tie = [], None, None
    while True:
        page = Q.page_after(df, "v", last, 3, "id", tie).collect()
        if not page:
            break
        seen += [r.id for r in page]
        last, tie = page[-1].v, page[-1].id
    assert seen == list(range(14))


def test_star_lookup_ignores_case_and_end_blanks(spark):
    fact = spark.createDataFrame([("a1 ",), ("A1",), ("á1",), (None,)], "code string")
    dim = spark.createDataFrame([("a1", 1), ("Á1", 2)], "c string, k int")
    got = J.star_lookup(fact, dim, F.col("code"), "c", ["k"])
    assert rows(got) == sorted([("a1 ", 1), ("A1", 1), ("á1", 2), (None, None)], key=repr)


def test_resolve_sku_priority(spark):
    dim = spark.createDataFrame([("S1",), ("S2",), ("S3",)], "SKU_Oficial string")
    bridge = spark.createDataFrame([("MySQL", "A2", "S2"), ("MongoDB", "M3", "S3"), ("MySQL", "A3", "S3")],
                                   "FuenteOrigen string, CodigoFuente string, SKU_Oficial string")
    df = spark.createDataFrame([(1, "s1 ", "A2", "M3"), (2, "S9", "A2", "M3"), (3, "", "A9", "m3"), (4, None, None, None),
                                (5, None, "a3", None)], "i int, sku string, codigo_alt string, codigo_mongo string")
    got = J.resolve_sku(df, bridge, dim).select("i", "SKU_Oficial", "resolved_by")
    assert rows(got, "i") == [(1, "S1", "SKU"), (2, "S2", "codigo_alt"), (3, "S3", "codigo_mongo"), (4, None, None),
                              (5, "S3", "codigo_alt")]
    override = spark.createDataFrame([("S9", "S1")], "codigo string, SKU_Oficial string")
    assert rows(J.resolve_sku(df, bridge, dim, override).select("i", "SKU_Oficial", "resolved_by"), "i")[1] == (2, "S1", "override")


def test_match_by_name(spark):
    dim = spark.createDataFrame([("S1", "Tomate  grande", "Alimentos"), ("S2", "Pan", "Alimentos"), ("S3", "pan", "alimentos")],
                                "SKU_Oficial string, Nombre string, Categoria string")
    df = spark.createDataFrame([("TOMATE grande", "alimentos "), ("Pan", "Alimentos"), ("Pan", "Otros"), (None, "x")],
                               "nombre string, categoria string")
    got = J.match_by_name(df, dim)
    assert rows(got) == sorted([("TOMATE grande", "alimentos ", "S1", None), ("Pan", "Alimentos", None, "ambiguous"),
                                ("Pan", "Otros", None, "no match"), (None, "x", None, "no match")], key=repr)


def test_orphans_exempt_null(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    assert rows(J.orphans(df, df.where("k = 1"), "k", "k")) == [(2,)]


# --- filters ----------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(i, f"Item {i}", "A.B" if i % 2 else "axb") for i in range(1, 24)], "id int, name string, cat string")


def test_search_regex_and_literal(items):
    assert Q.search(items, "a.b", ["name", "cat"]).count() == 23
    assert Q.search(items, "a.b", ["name", "cat"], literal=True).count() == 12
    assert Q.search(items, "ITEM 2[0-3]", ["name"]).count() == 4


def test_paging(items):
    page = Q.paginate(items, 3, 10, "id").collect()
    assert [r.id for r in page] == [21, 22, 23] and (page[0].total, page[0].pages) == (23, 3)
    assert tuple(Q.page_summary(items.limit(0), 1, 10).first()) == (0, 1, 10, 0)
    assert Q.paginate(items, 9, 10, "id").count() == 0
    for page, limit in ((0, 10), (1, 0), (1, 101)):
        with pytest.raises(ValueError):
            Q.paginate(items, page, limit, "id")
    assert [r.id for r in Q.page_after(items, "id", 21, 10).collect()] == [22, 23]
    assert [r.id for r in Q.list_view(items, "id", "axb", ["cat"], "name,desc", 1, 2).collect()] == [8, 6]


def test_date_range_end_is_midnight(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 31),), (dt.datetime(2024, 1, 31, 10),)], "t timestamp_ntz")
    assert Q.filter_date_range(df, "t", "2024-01-01", "2024-01-31").count() == 2
    with pytest.raises(TypeError):
        Q.filter_date_range(df.select(F.col("t").cast("string")), "t", "2024-01-01", "2024-01-31")


def test_map_headers(spark):
    df = spark.createDataFrame([("e", "s", "x", 1)], "`cliente email` string, `Sku` string, `PrecioUnit(USD)` string, _row int")
    got = Q.map_headers(df, ["ClienteEmail", "SKU", "PrecioUnit", "Qty"])
    assert got.columns == ["_row", "ClienteEmail", "SKU", "PrecioUnit", "Qty"]
    assert tuple(got.first()) == (1, "e", "s", "x", None)
    assert Q.map_headers(df, ["SKU", "Qty"], {"cliente email": "Qty"}).first().Qty == "e"
    with pytest.raises(ValueError):
        Q.map_headers(df, ["SKU"], {"Sku": "nope"})


def test_to_response(spark):
    from lakesales.schemas import DOCUMENTS

    prod = spark.createDataFrame([("1", None, "MN-1", "n", "c", None, None, None), ("2", "X", None, "n", "c", ("s", None), None, None)],
                                 DOCUMENTS["productos"])
    got = Q.to_response(prod, "productos").orderBy("id").collect()
    assert (got[0].codigo_mongo, got[0].equivalencias, got[1].codigo_mongo, got[1].equivalencias.sku) == ("MN-1", None, "X", "s")
    cli = spark.createDataFrame([("1", "n", None, "Otro", "CR", None, None, None)], DOCUMENTS["clientes"])
    first = Q.to_response(cli, "clientes").first()
    assert first.preferencias == [] and first.creado is not None and first.email is None
    with pytest.raises(ValueError):
        Q.to_response(cli, "otros")


# --- aggregates -------------------------------------------------------------------------------
def test_order_stats(spark):
    df = spark.createDataFrame([(D("10.00"),), (D("20.01"),), (None,)], "total decimal(18,2)")
    assert tuple(A.order_stats(df).first()) == (3, D("30.01"), D("15.01"), D("10.00"), D("20.01"))
    assert tuple(A.order_stats(df.limit(0)).first()) == (0, D("0.00"), D("0.00"), D("0.00"), D("0.00"))
    assert A.order_stats(df.where("total is null")).first().avg_order_value is None


def test_error_summary(spark):
    rejects = spark.createDataFrame([(i, "f", "r", "m") for i in range(14, 0, -1)], "row int, field string, rule string, message string")
    got = A.error_summary(rejects).orderBy("row").collect()
    assert [r.row for r in got] == list(range(1, 11)) and (got[0].errores, got[0].mas) == (14, 4)


def test_target_attainment(spark):
    fact = spark.createDataFrame([(1, 1, 20240105, D("10")), (1, 1, 20240120, D("20")), (2, 1, 20240201, D("5"))],
                                 "ClienteID int, ProductoID int, TiempoID int, TotalVentaUSD decimal(18,2)")
    goal = spark.createDataFrame([(1, 1, 2024, 1, D("60")), (3, 1, 2024, 1, D("7")), (2, 1, 2024, 2, D("0"))],
                                 "ClienteID int, ProductoID int, Anio int, Mes int, MetaUSD decimal(18,2)")
    got = A.target_attainment(fact, goal)
    assert rows(got, "ClienteID") == [(1, 1, 2024, 1, D("30.00"), D("60.00"), D("0.5000")),
                                      (2, 1, 2024, 2, D("5.00"), D("0.00"), None), (3, 1, 2024, 1, D("0.00"), D("7.00"), D("0.0000"))]


def test_basket_rules_count_against_all_orders(spark):
    lines = [(o, i) for o in range(10) for i in (["a", "b"] if o < 4 else ["c"] if o < 6 else [f"rare{o}"])] + [(0, "a")]
    sets, rules = A.basket_rules(spark.createDataFrame(lines, "o int, i string"), "o", "i", 0.2, 0.5)
    got = {tuple(sorted(r["items"])): (r.freq, round(r.support, 6)) for r in sets.collect()}
    assert got == {("a",): (4, 0.4), ("b",): (4, 0.4), ("c",): (2, 0.2), ("a", "b"): (4, 0.4)}
    rule = {tuple(r.antecedent): r for r in rules.collect()}[("a",)]
    assert (rule.confidence, round(rule.support, 6), round(rule.lift, 6)) == (1.0, 0.4, 2.5)
    empty, none = A.basket_rules(spark.createDataFrame(lines, "o int, i string"), "o", "i", 0.9)
    assert empty.count() == 0 and none.count() == 0


# --- validation -------------------------------------------------------------------------------
def test_validate_splits_rows(spark):
    df = spark.createDataFrame([(1, "WEB", 5, "a@b.co"), (2, "FAX", 0, "x"), (3, None, None, None), (4, "APP", 101, "a@b.co")],
                               "id int, canal string, n int, mail string")
    rules = [V.required("canal"), V.one_of("canal", ["WEB", "APP"]), V.in_range("n", above=0, high=100), V.email_format("mail"),
             V.max_length("mail", 6, 1)]
    good, rejects = V.validate(df, rules, "id")
    assert [r.id for r in good.collect()] == [1]
    assert rows(rejects.select("row", "field", "rule")) == sorted([
        (2, "canal", "one_of"), (2, "n", "range"), (2, "mail", "email"), (3, "canal", "required"), (4, "n", "range")], key=repr)


def test_import_gate(spark):
    flagged = V.with_errors(spark.range(5), [V.in_range("id", low=1)])
    assert V.import_gate(flagged, "skip_bad").count() == 4
    assert V.import_gate(flagged, "all_or_nothing").count() == 0
    assert V.import_gate(flagged.where("id > 0"), "all_or_nothing").count() == 4
    with pytest.raises(ValueError):
        V.import_gate(flagged, "other")


def test_duplicates_exempt_null(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "k string")
    assert rows(V.duplicates(df, ["k"])) == [("a", 2)]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-5, 15), max_size=40))
def test_accepted_and_rejected_make_the_input(spark, numbers):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(numbers)], "i int, n int")
    good, rejects = V.validate(df, [V.in_range("n", low=0, high=10), V.in_range("n", high=12)], "i")
    assert good.count() + rejects.select("row").distinct().count() == len(numbers)


def test_document_rules(spark):
    item = "array<struct<producto_id:string,cantidad:int,precio_unit:int,descuento_pct:int>>"
    df = spark.createDataFrame([
        (1, "c", "f", "CRC", 5, [("p", 1, 5, None)]), (2, "c", "f", "CRC", 5, []), (3, "c", None, "CRC", 5, [("p", 0, -1, 101)]),
        (4, "c", "f", "CRC", 5, [(None, 1, 5, 0)]), (5, "c", "f", "CRC", 5, None)],
        f"id int, cliente_id string, fecha string, moneda string, total int, items {item}")
    _, rejects = V.validate(df, V.order_document_rules(), "id")
    assert rows(rejects.select("row", "rule")) == sorted([
        (2, "items"), (3, "required"), (3, "item_quantity"), (3, "item_price"), (3, "item_discount"), (4, "item_required"), (5, "items")], key=repr)


def test_document_total_mismatch(spark):
    item = "array<struct<producto_id:string,cantidad:int,precio_unit:int,descuento_pct:int>>"
    df = spark.createDataFrame([("a", D("10.00"), [("p", 2, 5, 0)]), ("b", D("11.00"), [("p", 2, 5, 0)]), ("c", None, [])],
                               f"_id string, total decimal(18,2), items {item}")
    assert rows(V.document_total_mismatch(df)) == sorted([("b", D("11.00"), D("10.00")), ("c", None, D("0.00"))], key=repr)


# --- changes ----------------------------------------------------------------------------------
NOW, OLD = dt.datetime(2025, 1, 1), dt.datetime(2024, 1, 1)
ORDER = ("id int, canal string, items array<struct<producto_id:string,cantidad:int,precio_unit:decimal(18,2),descuento_pct:decimal(5,2)>>, "
         "total decimal(18,2), creado timestamp_ntz, actualizado timestamp_ntz")


def run_ts():
    return F.lit(NOW).cast("timestamp_ntz")


@pytest.fixture(scope="module")
def stored(spark):
    one = [("p", 1, D("5.00"), None)]
    return spark.createDataFrame([(1, "WEB", one, D("5"), OLD, OLD), (2, "APP", one, D("5"), OLD, OLD), (3, "APP", one, D("5"), OLD, OLD)], ORDER)


def test_patch(spark, stored):
    two = [("p", 2, D("5.00"), D("50"))]
    patches = spark.createDataFrame([(1, None, two, NOW, ["items"]), (2, None, None, NOW, ["canal"]), (9, "X", None, NOW, ["canal"])],
                                    "id int, canal string, items array<struct<producto_id:string,cantidad:int,precio_unit:decimal(18,2),"
                                    "descuento_pct:decimal(5,2)>>, creado timestamp_ntz, supplied array<string>")
    got = {r.id: r for r in U.apply_patches(stored, patches, "id", run_ts()).collect()}
    assert (got[1].canal, got[1].total, got[1].creado, got[1].actualizado) == ("WEB", D("5.00"), OLD, NOW)
    assert got[1]["items"][0].cantidad == 2 and got[2].canal is None and got[2].total == D("5.00")
    assert got[3].actualizado == OLD and set(got) == {1, 2, 3}
    assert rows(U.change_report(stored, patches, "id")) == [(1, "modified"), (2, "modified"), (9, "not found")]
    again = U.apply_patches(stored, patches, "id", run_ts())
    twice = U.apply_patches(again, patches, "id", run_ts())
    assert rows(again) == rows(twice)
    assert rows(U.change_report(again, patches, "id"))[:2] == [(1, "unchanged"), (2, "unchanged")]


def test_insert_and_delete(spark, stored):
    new = spark.createDataFrame([(4, "WEB", [("q", 3, D("1.10"), D("0"))])], "id int, canal string, items array<struct<producto_id:string,"
                                "cantidad:int,precio_unit:decimal(18,2),descuento_pct:decimal(5,2)>>")
    full = U.apply_inserts(stored, new, run_ts())
    added = full.where("id = 4").first()
    assert (added.total, added.creado, added.actualizado) == (D("3.30"), NOW, NOW)
    left, report = U.apply_deletes(full, spark.createDataFrame([(1,), (7,), (1,)], "id int"), "id")
    assert sorted(r.id for r in left.collect()) == [2, 3, 4]
    assert rows(report) == [(1, True), (7, False)]


def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (1, "c", 2), (2, None, 1)], "id int, v string, seq int")
    assert rows(U.latest_per_key(df, "id", "seq").select("id", "v"), "id") == [(1, "b"), (2, None)]


def test_upsert_keeps_keys(spark):
    dim = spark.createDataFrame([(1, "a", "Ana", OLD, OLD), (2, "b", "Bea", OLD, OLD)],
                                "K bigint, nat string, name string, FechaCreacion timestamp_ntz, FechaActualizacion timestamp_ntz")
    incoming = spark.createDataFrame([("b", "Beatriz"), ("a", "Ana"), ("c", "Cai"), ("d", "Dov")], "nat string, name string")
    got = {r.nat: r for r in U.upsert_dim(dim, incoming, ["nat"], "K", run_ts()).collect()}
    assert (got["a"].K, got["a"].FechaActualizacion, got["b"].K, got["b"].name, got["b"].FechaActualizacion) == (1, OLD, 2, "Beatriz", NOW)
    assert sorted((got["c"].K, got["d"].K)) == [3, 4] and got["c"].FechaCreacion == NOW


def test_compare_snapshots(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "y", 1), (3, "z", 1)], "id int, v string, n int")
    b = spark.createDataFrame([(1, "x", None), (2, "y", 2), (4, "w", 1)], "id int, v string, n int")
    assert rows(U.compare_snapshots(a, b, "id"), "id") == [(1, "unchanged"), (2, "modified"), (3, "deleted"), (4, "inserted")]


# --- constraints ------------------------------------------------------------------------------
def test_table_constraints(spark):
    from lakesales.plans.constraints import TABLES, check_table

    orders = spark.createDataFrame([("o1", "c1", "2024", "WEB", "USD", 1), ("o2", "c9", "2024", "TIENDA", "USDX", None),
                                    ("o2", None, "2024", "APP", "CRC", 1)],
                                   "orden_id string, cliente_id string, fecha string, canal string, moneda string, total int")
    clients = spark.createDataFrame([("c1",)], "cliente_id string")
    got = check_table(orders, "Supabase", "orden", {"cliente": clients}).select("row", "field", "rule")
    assert rows(got) == sorted([
        ("o2", "canal", "one_of"), ("o2", "moneda", "length"), ("o2", "total", "required"), ("o2", "cliente_id", "required"),
        ("o2", "orden_id", "unique"), ("o2", "cliente_id", "reference")], key=repr)
    form = spark.createDataFrame([(1, "", "x", None, "XX"), (2, "Ana", "a@b.co", "F", "CR")],
                                 "_row int, nombre string, email string, genero string, pais string")
    assert rows(check_table(form, "form", "cliente").select("row", "field", "rule")) == sorted([
        ("1", "nombre", "length"), ("1", "email", "email"), ("1", "genero", "required"), ("1", "pais", "one_of")], key=repr)
    assert all(t.key for t in TABLES.values())


def test_form_to_store(spark):
    df = spark.createDataFrame([("n", "c", "x", 1)], "nombre string, categoria string, codigo string, otro int")
    assert Q.form_to_store(df, "SQL Server", "producto").columns == ["Nombre", "Categoria", "SKU"]
    assert Q.form_to_store(df, "MySQL", "producto").columns == ["nombre", "categoria", "codigo_alt"]


def test_broken_rules_are_compiled_and_lines_not_sorted_for_their_codes(spark):
    from pyspark.sql import functions as F

    from lakesales.operators.joins import resolve_sku
    from lakesales.operators.validation import in_range, required, with_errors

    df = spark.createDataFrame([(1, "a"), (2, None), (None, None)], "n int, sku string").repartition(2)
    flagged = with_errors(df, [in_range("n", high=1), required("sku")])
    assert "lambdafunction" not in flagged._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r["n"] or 0, [e["rule"] for e in r["errors"]]) for r in flagged.collect()) == [
        (0, ["required"]), (1, []), (2, ["range", "required"])]
    codes = df.select("sku", F.lit(None).cast("string").alias("codigo_alt"), F.lit(None).cast("string").alias("codigo_mongo"))
    dim = spark.createDataFrame([("A",)], "SKU_Oficial string")
    bridge = spark.createDataFrame([], "FuenteOrigen string, CodigoFuente string, SKU_Oficial string")
    found = resolve_sku(codes, bridge, dim)
    assert "rightHint=(strategy=shuffle_hash)" in found._jdf.queryExecution().optimizedPlan().toString()
    assert [r["SKU_Oficial"] for r in found.where("sku is not null").collect()] == ["A"]
