"""All registered queries and their SQL."""

from __future__ import annotations

from lakesales.checks import erp, orders, paths, quality, unified

_MODULES = (erp, orders, unified, quality, paths)
QUERIES = {name: fn for m in _MODULES for name, fn in m.QUERIES.items()}
SQL = {name: text for m in _MODULES for name, text in m.SQL.items()}
