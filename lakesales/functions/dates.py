"""Calendar columns and date text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakesales._cols import C, as_col
from lakesales.schemas import MONTHS_ES, WEEKDAYS_ES

# fixed values: YYYY-MM-DD, YYYY-MM-DD HH:MM:SS and ISO-8601 with optional zone
_DAY, _CLOCK = r"^\d{4}-\d{2}-\d{2}", r"[ T]\d{2}:\d{2}:\d{2}(\.\d{1,6})?"
_DATE_OR_TIME = f"{_DAY}({_CLOCK})?$"
_TIME_ZONED = _DAY + _CLOCK + r"(Z|[+-]\d{2}:\d{2})$"


def date_key(c: C) -> Column:
    """yyyymmdd as an integer."""
    c = as_col(c)
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def is_business_day(c: C) -> Column:
    return ~F.dayofweek(as_col(c)).isin(1, 7)


def quarter_name(c: C) -> Column:
    return F.concat(F.lit("Q"), F.quarter(as_col(c)).cast("string"))


def month_name(c: C) -> Column:
    return F.date_format(as_col(c), "MMMM")


def _pick(names: list[str], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), position)


def month_name_es(c: C) -> Column:
    return _pick(MONTHS_ES, F.month(as_col(c)))


def weekday_name_es(c: C) -> Column:
    return _pick(WEEKDAYS_ES, F.dayofweek(as_col(c)))


def add_years(c: C, years: int) -> Column:
    """Adds whole years and keeps the time of day; NULL stays NULL."""
    return as_col(c) + F.expr(f"INTERVAL '{int(years)}' YEAR")


def month_start(year: C, month: C) -> Column:
    """First day of the month, NULL when the parts make no date."""
    stamp = F.try_make_timestamp_ntz(as_col(year), as_col(month), F.lit(1),
                                     F.lit(0), F.lit(0), F.lit(0))
    return stamp.cast("date")


def parse_date_text(c: C, zone: str = "UTC") -> Column:
    """Text to a timestamp without zone, in business time; NULL for other layouts or no such date.

    Text that names a zone is converted to ``zone``, text without one is taken as it stands. The
    result does not depend on the session time zone.
    """
    return parse_trimmed_date(F.trim(as_col(c)), zone)


def parse_trimmed_date(c: C, zone: str = "UTC") -> Column:
    """``parse_date_text`` of a column without blanks at the ends: it is looked at often and shortens the plan."""
    c = as_col(c)
    kind = "timestamp_ntz"
    minutes = F.substring(c, -5, 2).try_cast("int") * 60 + F.substring(c, -2, 2).try_cast("int")
    sign = F.when(F.substring(c, -6, 1) == "-", 1).otherwise(-1)

    def local(utc: Column) -> Column:
        return utc if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)

    utc = c.endswith("Z")
    return (F.when(c.rlike(_DATE_OR_TIME), c.try_cast(kind))
            .when(c.rlike(_TIME_ZONED), local(
                F.substring(c, F.lit(1), F.length(c) - F.when(utc, 1).otherwise(6)).try_cast(kind)
                + F.make_dt_interval(mins=F.when(utc, 0).otherwise(sign * minutes)))))


def utc_text(c: C) -> Column:
    """An instant as ISO text in UTC, whatever the session time zone."""
    seconds = (F.unix_micros(as_col(c)) / 1000000).cast("decimal(18,6)")
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    stamp = (epoch + F.make_dt_interval(secs=seconds)).cast("string")
    return F.concat(F.replace(stamp, F.lit(" "), F.lit("T")), F.lit("Z"))
