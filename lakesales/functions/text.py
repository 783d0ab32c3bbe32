"""Text keys and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakesales._cols import C, as_col

# fixed values: accepted identifier and e-mail patterns
OBJECT_ID = r"^[0-9a-fA-F]{24}$"
UUID = r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"
EMAIL = r"^[^\s@]+@[^\s@]+\.[^\s@]+$"


def norm_key(c: C) -> Column:
    """Key equality of a case-insensitive, accent-sensitive collation that ignores end blanks.

    A plain string key keeps hash joins and hash aggregation, which collated columns lose.
    """
    return F.upper(F.rtrim(as_col(c)))


def blank_to_null(c: C) -> Column:
    return F.nullif(F.trim(as_col(c)), F.lit(""))


def code_key(c: C) -> Column:
    """``blank_to_null`` for the key of a join: Spark gives ``nullif`` a column of its own, which a shuffle would move."""
    c = F.trim(as_col(c))
    return F.when(c != "", c)


def is_object_id(c: C) -> Column:
    return F.coalesce(as_col(c).rlike(OBJECT_ID), F.lit(False))


def is_uuid(c: C) -> Column:
    return F.coalesce(as_col(c).rlike(UUID), F.lit(False))


def is_email(c: C) -> Column:
    return as_col(c).rlike(EMAIL)


def file_extension(path: str) -> str:
    return path.rstrip("/").rsplit(".", 1)[-1].lower()
