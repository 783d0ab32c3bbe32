"""Unified codes for gender, channel and currency."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakesales._cols import C, as_col
from lakesales.functions.text import blank_to_null


def unify_gender(c: C) -> Column:
    """M/F/X and full words to the three unified values."""
    code = F.upper(F.trim(as_col(c)))
    return (F.when(code.isin("M", "MASCULINO"), "Masculino")
            .when(code.isin("F", "FEMENINO"), "Femenino")
            .otherwise("No Especificado"))


def canonical_channel(c: C) -> Column:
    """Trimmed, upper-case channel code; unknown codes are kept as new members."""
    return F.upper(blank_to_null(c))


def canonical_currency(c: C) -> Column:
    """ISO code; the ERP's own code for colones becomes CRC."""
    code = F.upper(blank_to_null(c))
    return F.when(code == "COL", "CRC").otherwise(code)
