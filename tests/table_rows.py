"""Rows of a DataFrame in an order that tests can compare."""

from __future__ import annotations


def rows(df, *order):
    """Rows as tuples in a fixed order."""
    if order:
        df = df.orderBy(*order)
        return [tuple(r) for r in df.collect()]
    return sorted((tuple(r) for r in df.collect()), key=repr)
