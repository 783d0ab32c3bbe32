from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from table_rows import rows
from lakesales.functions import conform, dates, money, nested, text


def values(spark, items, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr("v")).collect()]


@pytest.mark.parametrize("locale,cases", [
    (None, {"1200.50": "1200.50", "1,200.50": "1200.50", "84,500": "84500.00", "12,000": "12000.00",
            "1.200,50": "1200.50", "1200,5": "1200.50", "1.200.300": "1200300.00", "₡ 12,000": "12000.00",
            "USD 5": "5.00", "-3.25": "-3.25", "1,234,567.89": "1234567.89", "0.0100": "0.01", "0.005": None,
            "abc": None, "": None, "1,2,3": None, "1.2.3": None, "12abc": None, "1e3": None, "1.2,3.4": None}),
    ("es", {"1.200,50": "1200.50", "84.500": "84500.00", "1200,50": "1200.50", "1,200.50": "1200.50"}),
])
def test_parse_money(spark, locale, cases):
    got = values(spark, list(cases), lambda c: money.parse_money(c, locale))
    assert got == [None if v is None else D(v) for v in cases.values()]


def test_parse_money_null_and_locale(spark):
    assert values(spark, [None], money.parse_money) == [None]
    with pytest.raises(ValueError):
        money.parse_money("v", "xx")


@settings(max_examples=5, deadline=None)
@given(st.lists(st.decimals(min_value=0, max_value=10**9, places=2), min_size=1, max_size=50))
def test_money_round_trip(spark, amounts):
    got = values(spark, amounts, lambda c: money.parse_money(money.format_money(c)), "decimal(18,2)")
    assert got == [a.quantize(D("0.01")) for a in amounts]


def test_parse_date_text(spark):
    cases = {"2025-04-10": dt.datetime(2025, 4, 10), "2025-04-10 13:20:00": dt.datetime(2025, 4, 10, 13, 20),
             "2025-04-10T13:20:00Z": dt.datetime(2025, 4, 10, 13, 20), " 2025-04-10 ": dt.datetime(2025, 4, 10),
             "2025-04-10T13:20:00-06:00": dt.datetime(2025, 4, 10, 19, 20),
             "2025-13-40": None, "2025-02-30": None, "10/04/2025": None, "2025": None, "": None, None: None}
    got = values(spark, list(cases), lambda c: F.date_format(dates.parse_date_text(c), "yyyy-MM-dd HH:mm:ss"))
    assert got == [None if v is None else v.strftime("%Y-%m-%d %H:%M:%S") for v in cases.values()]


def test_dates_do_not_depend_on_the_session_zone(spark):
    import datetime

    old = spark.conf.get("spark.sql.session.timeZone")
    items = ["2025-04-10T23:30:00Z", "2025-04-10 23:30:00", "2025-04-10T23:30:00.5+02:30", "2025-04-10Z"]
    try:
        for zone in ("UTC", "America/Costa_Rica", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            at = datetime.datetime(2025, 4, 10, 23, 30)
            assert values(spark, items, dates.parse_date_text) == [at, at, at - datetime.timedelta(hours=2.5, seconds=-0.5), None]
            local = values(spark, items[:2], lambda c: dates.parse_date_text(c, "America/Costa_Rica"))
            assert local == [at - datetime.timedelta(hours=6), at]
            instant = spark.sql("select timestamp_micros(1744327800500000) as t")
            assert instant.select(dates.utc_text("t")).first()[0] == "2025-04-10T23:30:00.5Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_add_years_keeps_time_and_null(spark):
    got = values(spark, [dt.datetime(2020, 2, 29, 13, 5), None],
                 lambda c: dates.add_years(c, 4), "timestamp_ntz")
    assert got == [dt.datetime(2024, 2, 29, 13, 5), None]


def test_month_start(spark):
    df = spark.createDataFrame([(2024, 2), (2024, 13), (None, 1)], "y int, m int")
    assert [r[0] for r in df.select(dates.month_start("y", "m")).collect()] == [dt.date(2024, 2, 1), None, None]


def test_business_day(spark):
    days = [dt.date(2024, 1, 5), dt.date(2024, 1, 6), dt.date(2024, 1, 7), dt.date(2024, 1, 8)]
    assert values(spark, days, dates.is_business_day, "date") == [True, False, False, True]


def test_conforming(spark):
    assert values(spark, ["M", "masculino ", "F", "Femenino", "X", "Otro", "", None], conform.unify_gender) == [
        "Masculino", "Masculino", "Femenino", "Femenino"] + ["No Especificado"] * 4
    assert values(spark, [" web ", "PARTNER", "", None], conform.canonical_channel) == ["WEB", "PARTNER", None, None]
    assert values(spark, ["COL", "crc", "usd "], conform.canonical_currency) == ["CRC", "CRC", "USD"]


def test_ids_and_keys(spark):
    good = "6423f2a1" * 3
    assert values(spark, [good, good[:23], good + "0", "z" * 24, None], text.is_object_id) == [
        True, False, False, False, False]
    assert values(spark, ["ab ", "á", " a"], text.norm_key) == ["AB", "Á", " A"]
    assert text.file_extension("s3://x/a.b/Lines.CSV") == "csv"
    assert values(spark, ["a@b.co", "a b@c.d", "a@b", None], text.is_email) == [True, False, False, None]


def test_to_usd(spark):
    df = spark.createDataFrame([(D("1000.00"), "CRC", D("500")), (D("1000.00"), "USD", None),
                                (D("1000.00"), "CRC", None), (D("1"), "CRC", D("0")), (D("1"), "EUR", D("500")),
                                (D("2.675"), "USD", None)], "a decimal(18,4), c string, r decimal(18,6)")
    got = [r[0] for r in df.select(money.to_usd("a", "c", "r")).collect()]
    assert got == [D("2.00"), D("1000.00"), None, None, None, D("2.68")]


ITEM = "array<struct<producto_id:string,cantidad:int,precio_unit:decimal(18,2),descuento_pct:decimal(5,2)>>"


def test_order_amounts(spark):
    items = [("a", 2, D("10.00"), D("10")), ("b", 1, D("5.55"), None), ("c", 3, D("1.00"), D("0")),
             ("d", 1, D("9.99"), D("100"))]
    df = spark.createDataFrame([(items,), ([],), (None,)], f"items {ITEM}")
    got = df.select(nested.order_total("items"), nested.order_amounts("items"), nested.item_count("items")).collect()
    assert got[0][0] == D("26.55")
    assert tuple(got[0][1]) == (D("38.54"), D("11.99"), D("26.55"))
    assert [r[0] for r in got[1:]] == [D("0.00"), D("0.00")] and [r[2] for r in got] == [4, 0, 0]


def test_total_rounds_once_half_up(spark):
    items = [("a", 1, D("0.05"), D("10")), ("b", 1, D("0.05"), D("10"))]  # 0.045 + 0.045
    df = spark.createDataFrame([(items,), (items[:1],)], f"items {ITEM}")
    assert [r[0] for r in df.select(nested.order_total("items")).collect()] == [D("0.09"), D("0.05")]


def test_explode_items_drops_or_keeps_empty(spark):
    df = spark.createDataFrame([("o1", [("a", 1, D("1"), None)]), ("o2", [])], f"id string, items {ITEM}")
    assert [r.id for r in nested.explode_items(df).collect()] == ["o1"]
    assert sorted(r.id for r in nested.explode_items(df, keep_empty=True).collect()) == ["o1", "o2"]


def test_preferences(spark):
    prefs = {"canal": '["WEB","TIENDA"]', "idioma": "es", "vacio": "[]", "n": "5", "texto": "[no json"}
    df = spark.createDataFrame([(prefs,), (None,)], "p map<string,string>")
    got = df.select(nested.prefs_to_pairs("p")).collect()
    assert {r["categoria"]: r["texto"] for r in got[0][0]} == {
        "canal": "WEB,TIENDA", "idioma": "es", "vacio": "", "n": "5", "texto": "[no json"}
    assert got[1][0] is None


def test_duplicate_category_last_wins(spark):
    pairs = [("a", "1,2"), ("b", ""), ("a", "3")]
    df = spark.createDataFrame([(pairs,), ([],)], "p array<struct<categoria:string,texto:string>>")
    got = [r[0] for r in df.select(nested.pairs_to_prefs("p")).collect()]
    assert got == [{"a": ["3"], "b": [""]}, {}]


WORD = st.text(st.characters(codec="ascii", exclude_characters=',[]"\\', categories=["L", "N"]), min_size=1, max_size=6)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.dictionaries(WORD, st.lists(WORD, min_size=1, max_size=3), max_size=4), min_size=1, max_size=10))
def test_preferences_round_trip(spark, maps):
    df = spark.createDataFrame([(i, m) for i, m in enumerate(maps)], "i int, m map<string,array<string>>")
    raw = F.transform_values("m", lambda k, v: F.to_json(v))
    got = df.orderBy("i").select(nested.pairs_to_prefs(nested.prefs_to_pairs(raw))).collect()
    assert [r[0] for r in got] == maps


def test_json_is_valid(spark):
    cases = {'{"a": 1}': True, "[1, 2]": True, '"x"': True, "5": True, "null": True, '{"a":': False,
             '{"a": 1}x': False, "1,2": False, "1],[2": False, "abc": False, " ": None, None: None}
    assert values(spark, list(cases), nested.json_is_valid) == list(cases.values())


def test_agg_sales_rows(spark):
    from lakesales.plans.erp_warehouse import split_agg_sales
    from lakesales.schemas import AGG_SALES

    data = [(2024, 1, [("a", D("2"), D("3.5")), ("b", D("1"), None)]), (2024, 2, []), (2024, 13, [("c", D("1"), D("1"))])]
    df = spark.createDataFrame(data, AGG_SALES)
    good, bad = split_agg_sales(df)
    assert rows(good.select("item", F.col("TotalUSD").cast("double"))) == [("a", 7.0), ("b", None)]
    assert [r["item"] for r in bad.collect()] == ["c"]
