from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

C = Column | str


def as_col(c: C) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_list(c) -> list:
    return [c] if isinstance(c, (str, Column)) else list(c)
