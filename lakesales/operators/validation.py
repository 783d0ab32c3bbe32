"""Constraints as data-quality rules with reject reasons."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesales.functions.dates import parse_date_text
from lakesales.functions.money import from_cents, net_cents, sum_of_all
from lakesales.functions.nested import order_total
from lakesales.functions.text import is_email, is_object_id, norm_key


@dataclass(frozen=True)
class Rule:
    """``ok`` NULL passes, as in a CHECK constraint."""

    field: str
    rule: str
    message: str
    ok: Column


def required(field: str, non_blank: bool = False) -> Rule:
    ok = F.col(field).isNotNull()
    if non_blank:
        ok = ok & (F.trim(F.col(field).cast("string")) != "")
    return Rule(field, "required", f"{field} is required", ok)


def one_of(field: str, values: Sequence[str]) -> Rule:
    return Rule(field, "one_of", f"{field} must be one of {', '.join(values)}",
                F.col(field).isin(list(values)))


def in_range(field: str, low=None, high=None, above=None, value: Column | None = None) -> Rule:
    """Bounds of the field, or of ``value`` that was read from it."""
    c = F.col(field) if value is None else value
    ok, words = F.lit(True), []
    if above is not None:
        ok, words = ok & (c > above), [*words, f"> {above}"]
    if low is not None:
        ok, words = ok & (c >= low), [*words, f">= {low}"]
    if high is not None:
        ok, words = ok & (c <= high), [*words, f"<= {high}"]
    return Rule(field, "range", f"{field} must be {' and '.join(words)}", ok)


def max_length(field: str, high: int, low: int = 0) -> Rule:
    return Rule(field, "length", f"{field} must have {low} to {high} characters",
                F.length(field).between(low, high))


def email_format(field: str) -> Rule:
    return Rule(field, "email", f"{field} is no e-mail address", is_email(field))


def has_items(field: str = "items", at_least: int = 1) -> Rule:
    return Rule(field, "items", f"{field} needs at least {at_least} line",
                F.coalesce(F.size(field) >= at_least, F.lit(False)))


def every_item(field: str, rule: str, message: str, check) -> Rule:
    return Rule(field, rule, message, F.forall(field, check))


def parsed(field: str, raw: str, what: str) -> Rule:
    """The text in ``raw`` is blank or gave a value in ``field``."""
    blank = F.coalesce(F.trim(F.col(raw)) == "", F.lit(True))
    return Rule(raw, "format", f"{raw} is no valid {what}", blank | F.col(field).isNotNull())


# what must hold for each item of a stored order: rule, message, check
ITEM_RULES = [
    ("item_required", "items need producto_id, cantidad and precio_unit",
     lambda i: i("producto_id").isNotNull() & i("cantidad").isNotNull() & i("precio_unit").isNotNull()),
    ("item_quantity", "cantidad must be a whole number >= 1",
     lambda i: F.coalesce((i("cantidad") >= 1) & (i("cantidad") == F.floor(i("cantidad"))), F.lit(True))),
    ("item_price", "precio_unit must be >= 0", lambda i: F.coalesce(i("precio_unit") >= 0, F.lit(True))),
    ("item_discount", "descuento_pct must be in 0..100",
     lambda i: F.coalesce(i("descuento_pct").between(0, 100), F.lit(True))),
]


def _order_fields() -> list[Rule]:
    return [required("cliente_id"), required("fecha"), required("moneda"), required("total")]


def order_type_rules() -> list[Rule]:
    """What a schema cannot say: the id is an object id and the date a date. Numbers and lists of another type fail
    on reading and are in the second part of ``readers.split_corrupt``."""
    return [Rule("_id", "object_id", "_id is no object id", is_object_id("_id")),
            Rule("fecha", "date", "fecha is no date", F.col("fecha").isNull() | parse_date_text("fecha").isNotNull())]


def order_document_rules() -> list[Rule]:
    """Required fields and item shape of stored orders that hold all their items."""
    def on_item(check):
        return lambda i: check(lambda field: i[field])

    return [*_order_fields(), has_items(), *[
        every_item("items", rule, message, on_item(check)) for rule, message, check in ITEM_RULES]]


def validate_orders(orders: DataFrame, lines: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Orders and their item rows against the rules of stored orders: good orders, reject lines.

    ``lines`` has the key and the item fields. Each rule is judged once an order, over all its items, in an
    aggregate that combines before the shuffle; an order stored in several parts is one order.
    """
    checks = lines.groupBy(key).agg(F.count("*").alias("_items"), *[
        F.bool_and(check(F.col)).alias(f"_{rule}") for rule, _, check in ITEM_RULES])
    both = orders.join(checks, key, "left")
    rules = [*_order_fields(), Rule("items", "items", "items needs at least 1 line",
                                    F.coalesce("_items", F.lit(0)) >= 1)]
    rules += [Rule("items", rule, message, F.coalesce(F.col(f"_{rule}"), F.lit(True)))
              for rule, message, _ in ITEM_RULES]
    flagged = with_errors(both, rules)
    good = flagged.where(F.size("errors") == 0).select(*orders.columns)
    return good, explode_errors(flagged, key)


#: Rules that one whole number holds, a bit each.
WORD = 62


def broken_rules(rules: Sequence[Rule], among: Sequence[Rule] | None = None) -> Column:
    """The broken ones of at most ``WORD`` rules as a whole number, one bit each.

    With ``among`` a rule's bit is its place there, so rules that are judged at different times add up.
    """
    if len(among or rules) > WORD:
        raise ValueError(f"more than {WORD} rules")
    place = {id(r): i for i, r in enumerate(among or rules)}
    bits = F.lit(0).cast("bigint")
    for r in rules:
        bits = bits.bitwiseOR(F.when(~r.ok, F.lit(1 << place[id(r)]).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    return bits


def errors_of(bits: Column, rules: Sequence[Rule]) -> Column:
    """The array of the rules that ``broken_rules`` found broken.

    Four bits at a time name one of sixteen constant arrays: a choice for each rule makes code too long for the JVM to
    compile, and a function with a lambda would be interpreted.
    """
    none = F.array().cast("array<struct<field:string,rule:string,message:string>>")
    entries = [F.struct(F.lit(r.field).alias("field"), F.lit(r.rule).alias("rule"), F.lit(r.message).alias("message"))
               for r in rules]
    parts = []
    for low in range(0, len(entries), 4):
        some = entries[low:low + 4]
        sets = [[e for i, e in enumerate(some) if n >> i & 1] for n in range(1 << len(some))]
        which = F.shiftright(bits, low).bitwiseAND(F.lit(15).cast("bigint")).cast("int")
        parts.append(F.get(F.array(*[F.array(*s) if s else none for s in sets]), which))
    return F.when(bits != 0, F.concat(*parts)).otherwise(none) if parts else none


def with_errors(df: DataFrame, rules: Sequence[Rule], errors: str = "errors") -> DataFrame:
    """Adds the array of broken rules, each rule evaluated once in one pass over the row.

    The rules give bits and the bits give the messages, in two steps: the code of one for both is too long for the
    JVM to compile.
    """
    words = [rules[i:i + WORD] for i in range(0, len(rules), WORD)] or [rules]
    names = [f"_{errors}_bits{i}" for i in range(len(words))]
    found = df.withColumns({n: broken_rules(word) for n, word in zip(names, words)})
    parts = [errors_of(F.col(n), word) for n, word in zip(names, words)]
    return found.withColumn(errors, F.concat(*parts) if len(parts) > 1 else parts[0]).drop(*names)


def explode_errors(flagged: DataFrame, row: str, errors: str = "errors") -> DataFrame:
    """One line per broken rule: row, field, rule, message."""
    return (flagged.where(F.size(errors) > 0)
            .select(F.col(row).alias("row"), F.explode(errors).alias("_e"))
            .select("row", "_e.field", "_e.rule", "_e.message"))


def validate(df: DataFrame, rules: Sequence[Rule], row: str) -> tuple[DataFrame, DataFrame]:
    """Rows that keep every rule, and the reject lines of the others."""
    flagged = with_errors(df, rules)
    return flagged.where(F.size("errors") == 0).drop("errors"), explode_errors(flagged, row)


def import_gate(flagged: DataFrame, policy: str) -> DataFrame:
    """Rows to write: none if any row is bad (``all_or_nothing``), or the good ones (``skip_bad``)."""
    good = flagged.where(F.size("errors") == 0).drop("errors")
    if policy == "skip_bad":
        return good
    if policy != "all_or_nothing":
        raise ValueError(f"unknown import policy: {policy}")
    bad = flagged.where(F.size("errors") > 0).agg(F.count("*").alias("n")).scalar()
    return good.where(bad == 0)


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once; a key with a NULL part is exempt."""
    set_keys = df.dropna(subset=keys) if keys else df
    return set_keys.groupBy(*keys).agg(F.count("*").alias("veces")).where("veces > 1")


def code_conflicts(df: DataFrame, code: str, by: list[str] | None = None) -> DataFrame:
    """Codes that stand for more than one different row, case and end blanks aside: code and the number of rows."""
    rest = [c for c in df.columns if c not in (by or [])]
    different = df.select(*[F.col(b) for b in by or []], norm_key(code).alias("_code"),
                          F.struct(*rest).alias("_r")).where("_code is not null").distinct()
    counted = different.groupBy(*(by or []), F.col("_code").alias("codigo")).agg(F.count("*").alias("miembros"))
    return counted.where("miembros > 1")


def total_mismatch(headers: DataFrame, lines: DataFrame, key: str, total: str, price: str,
                   qty: str, discount: str | None = None, tolerance: str = "0.00") -> DataFrame:
    """Headers whose stored total differs from the total of their lines (0 without lines).

    A header with a line whose amount cannot be told is listed with no total of its lines.
    """
    sums = lines.groupBy(key).agg(sum_of_all(net_cents(price, qty, discount)).alias("_c"), F.lit(True).alias("_lines"))
    stored = F.col(total).cast("decimal(18,2)")
    both = headers.select(key, stored.alias("total_guardado")).join(sums, key, "left")
    computed = F.when(F.col("_lines"), from_cents(F.col("_c"))).otherwise(F.lit(0).cast("decimal(18,2)"))
    out = both.select(key, "total_guardado", computed.alias("total_lineas"))
    gap = F.abs(F.col("total_guardado") - F.col("total_lineas"))
    return out.where((gap > F.lit(tolerance).cast("decimal(18,2)")) | F.col("total_lineas").isNull())


def document_total_mismatch(orders: DataFrame) -> DataFrame:
    computed = order_total("items")
    return (orders.select("_id", F.col("total").alias("total_guardado"),
                          computed.alias("total_lineas"))
            .where(~F.col("total_guardado").eqNullSafe(F.col("total_lineas"))))
