"""Metadata filter DSL -> one Spark ``Column``.

Keys are logical operators (``$and``, ``$or``, ``$not``), comparison
operators (``$eq``, ``$ne``, ``$in``, ``$nin``, ``$gt``, ``$gte``, ``$lt``,
``$lte``) or field names. A dict is an implicit ``$and``; a field given a
scalar means ``$eq``, a list means ``$in``; logical operators take a dict or
a list of dicts. The compiled column is an ordinary predicate, so Catalyst
pushes it into the Parquet scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

LOGICAL = ("$and", "$or", "$not")
COMPARISON = {
    "$eq": lambda c, v: c == F.lit(v),
    "$ne": lambda c, v: c != F.lit(v),
    "$in": lambda c, v: c.isin(list(v)),
    "$nin": lambda c, v: ~c.isin(list(v)),
    "$gt": lambda c, v: c > F.lit(v),
    "$gte": lambda c, v: c >= F.lit(v),
    "$lt": lambda c, v: c < F.lit(v),
    "$lte": lambda c, v: c <= F.lit(v),
}


def _all(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, cols) if cols else F.lit(True)


def _any(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, cols) if cols else F.lit(False)


def _field(name: str, cond, column_of) -> Column:
    col = column_of(name)
    if isinstance(cond, dict):
        parts = []
        for op, value in cond.items():
            if op not in COMPARISON:
                raise ValueError(f"unknown comparison operator {op!r} for field {name!r}")
            parts.append(COMPARISON[op](col, value))
        return _all(parts)
    if isinstance(cond, (list, tuple)):
        return col.isin(list(cond))
    return col == F.lit(cond)


def _node(key: str, value, column_of) -> Column:
    if key in LOGICAL:
        items = value if isinstance(value, (list, tuple)) else [value]
        cols = [compile_filter(v, column_of) for v in items]
        if key == "$and":
            return _all(cols)
        if key == "$or":
            # a single dict under $or means: any of its entries
            if not isinstance(value, (list, tuple)):
                return _any([_node(k, v, column_of) for k, v in value.items()])
            return _any(cols)
        return ~_all(cols)
    if key.startswith("$"):
        raise ValueError(f"unknown operator {key!r}")
    return _field(key, value, column_of)


def compile_filter(filters: dict | None, column_of=F.col) -> Column:
    """Compile a filter dict to a boolean Column (True when ``filters`` is empty)."""
    if not filters:
        return F.lit(True)
    if not isinstance(filters, dict):
        raise ValueError("filters must be a dict")
    return _all([_node(k, v, column_of) for k, v in filters.items()])
