"""Money text, discounts and currency conversion, all in decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakesales._cols import C, as_col
from lakesales.schemas import CRC, USD

LOCALES = ["en", "es"]
_SYMBOLS = "₡$€ \t\r\n\u00a0"
# decimals beyond the wanted ones may only be zeros
_PLAIN = r"^-?\d+(\.\d{1,%d}0*)?$"
_GROUPED = r"^-?\d{1,3}(,\d{3})+(\.\d{1,%d}0*)?$"
_MONEY_STEPS = [
    # a comma behind dots is the decimal mark, noted as #
    (r"^(-?\d*\.[\d.]*),(\d*)$", "$1#$2"),
    # marks before the decimal mark go
    (r"\.(?=.*#)|,(?=.*\.)", ""),
    # commas between groups of three go, as do two or more such dots
    (r"(^-?\d{1,3}|(?!^)\G\d{3}),(?=(?:\d{3},)*\d{3}$)|(^-?\d{1,3}(?=(?:\.\d{3}){2,}$)|(?!^)\G\d{3})\.(?=(?:\d{3}\.)*\d{3}$)", "$1$2"),
]


def _bare(text: Column) -> Column:
    """Without currency signs, currency codes and blanks."""
    text = F.upper(F.translate(text, _SYMBOLS, ""))
    for code in (USD, CRC):
        text = F.replace(text, F.lit(code), F.lit(""))
    return text


def parse_strict(c: C, locale: str, scale: int = 2) -> Column:
    """Text to decimal as one locale writes it, NULL else: thousands marks set off groups of three or are left out,
    and only the locale's own decimal mark is one."""
    if locale not in LOCALES:
        raise ValueError(f"unknown locale: {locale}")
    text = _bare(as_col(c))
    text = F.translate(text, ",.", ".,") if locale == "es" else text
    fits = text.rlike(_PLAIN % scale) | text.rlike(_GROUPED % scale)
    return F.when(fits, F.translate(text, ",", "").try_cast(f"decimal({16 + scale},{scale})"))


def amount_side(c: C, scale: int = 2) -> Column:
    """What a text says about its locale: ``en`` or ``es`` when it is an amount in that one only, ``same`` when both
    read the same amount, ``either`` when they read different ones, NULL when neither reads any."""
    return side_of(*[parse_strict(c, locale, scale) for locale in LOCALES])


def side_of(en: Column, es: Column) -> Column:
    """``amount_side`` of an English and a Spanish reading."""
    return (F.when(en == es, "same").when(en.isNotNull() & es.isNotNull(), "either")
            .when(en.isNotNull(), "en").when(es.isNotNull(), "es"))


def parse_money(c: C, locale: str | None = None, scale: int = 2) -> Column:
    """Text to decimal(16+scale,scale), NULL when it is no amount or has more decimals: nothing is rounded.

    With both marks present the right-most is the decimal mark. A lone comma that sets off
    groups of three is a thousands mark, else a decimal mark. One dot is a decimal mark and
    several set off thousands. ``locale="es"`` swaps the roles of comma and dot.
    """
    raw = as_col(c)
    if locale == "es":
        raw = F.translate(raw, ",.", ".,")
    elif locale not in (None, "en"):
        raise ValueError(f"unknown locale: {locale}")
    text = _bare(raw)
    for pattern, replacement in _MONEY_STEPS:
        text = F.regexp_replace(text, pattern, replacement)
    kind, plain = f"decimal({16 + scale},{scale})", _PLAIN % scale
    number = F.regexp_extract(F.translate(text, ",#", ".."), plain, 0)
    # most amounts are plain or neatly grouped and skip the long way
    return (F.when(raw.rlike(plain), raw).when(raw.rlike(_GROUPED % scale), F.translate(raw, ",", ""))
            .otherwise(number)).try_cast(kind)


def format_money(c: C) -> Column:
    """Amount as text with thousands commas."""
    return F.format_number(as_col(c), 2)


def exact(c: C, precision: int, scale: int) -> Column:
    """The number as decimal(precision,scale) where that holds all of it, else NULL: nothing is rounded."""
    wide = as_col(c).try_cast("decimal(38,18)")
    narrow = wide.try_cast(f"decimal({precision},{scale})")
    return F.when(wide == narrow, narrow)


def exact_text(c: C, precision: int, scale: int) -> Column:
    """``exact`` for text: NULL too where it has an exponent or digits that no wide decimal holds."""
    text = as_col(c)
    return F.when(~text.rlike(r"[eE]|\.\d{18}\d*[1-9]"), exact(text, precision, scale))


def whole(c: C) -> Column:
    """The value where it is a whole number of at most ten digits, else NULL."""
    return exact(c, 10, 0)


def sum_of_all(c: Column) -> Column:
    """Sum that is NULL when a row has no value, so that an unreadable amount is never left out of a total."""
    return F.when(F.count(c) == F.count(F.lit(1)), F.sum(c))


def net_cents(price: C, qty: C, discount_pct: C | None = None) -> Column:
    """price x qty x (100 - discount), exact; NULL or zero discount takes nothing off.

    The value is one hundred times the amount so that no division is needed. Prices have six decimals at most and
    discounts four; longer ones, a discount that is no number and a quantity that is no whole number are refused,
    the value is then NULL.
    """
    pct = F.lit(0) if discount_pct is None else F.when(as_col(discount_pct).isNull(), F.lit(0)).otherwise(
        exact(discount_pct, 7, 4))
    factor = (F.lit(100) - pct.cast("decimal(7,4)")).try_cast("decimal(7,4)")
    return (exact(price, 17, 6) * factor * whole(qty)).cast("decimal(36,10)")


def from_cents(c: C, scale: int = 2) -> Column:
    """Undo the factor of one hundred and round half up, in one step."""
    rounded = F.round(as_col(c), scale - 2).cast(f"decimal({24 + scale},{scale - 2})")
    return (rounded * F.lit("0.01").cast("decimal(2,2)")).cast(f"decimal(18,{scale})")


def cents_to_usd(cents: C, currency: C, crc_per_usd: C) -> Column:
    """Unrounded ``net_cents`` to USD; the only rounding is the one to whole cents."""
    cents = as_col(cents)
    rate = as_col(crc_per_usd).cast("decimal(18,6)")
    converted = cents.cast("decimal(28,10)") / F.when(rate > 0, rate)
    return (F.when(as_col(currency) == USD, from_cents(cents))
            .when(as_col(currency) == CRC, from_cents(converted)))


def to_usd(amount: C, currency: C, crc_per_usd: C, scale: int = 2) -> Column:
    """USD amounts pass, CRC amounts are divided by the day's rate; NULL without a rate."""
    amount = as_col(amount)
    rate = as_col(crc_per_usd).cast("decimal(18,6)")
    converted = (amount.cast("decimal(24,6)") / F.when(rate > 0, rate)).cast("decimal(38,14)")
    return (F.when(as_col(currency) == USD, F.round(amount, scale).cast(f"decimal(18,{scale})"))
            .when(as_col(currency) == CRC, F.round(converted, scale).cast(f"decimal(18,{scale})")))
