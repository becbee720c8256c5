"""Literal collections as single parsed SQL expressions.

Building ``isin`` over 50 values or a 92-entry ``create_map`` from Python costs one
JVM round trip per literal (hundreds of milliseconds per query on the driver);
parsing one SQL literal costs one. The resulting Column is the same constant.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F


def sq(v) -> str:
    """A Spark SQL string literal (backslash escapes are on by default)."""
    if v is None:
        return "CAST(NULL AS STRING)"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


@lru_cache(maxsize=None)
def _array_sql(values: tuple) -> str:
    return "array(" + ", ".join(sq(v) for v in values) + ")"


def array_lit(values) -> Column:
    return F.expr(_array_sql(tuple(values)))


def in_list(c: Column, values) -> Column:
    """``c IN values`` for a long literal list, NULL-propagating like ``isin``."""
    return F.array_contains(array_lit(values), c)


def map_lit(pairs: dict) -> Column:
    return F.expr("map(" + ", ".join(f"{sq(k)}, {sq(v)}" for k, v in pairs.items()) + ")")


def pick(values, key: Column) -> Column:
    """``values[key % len(values)]`` over a literal array."""
    return F.element_at(array_lit(values), (key % len(values)).cast("int") + 1)


def bound(c: Column, fn) -> Column:
    """``fn(c)`` with ``c`` evaluated once for each row, however often ``fn`` uses it. A Column is a tree: in the branches of
    a CASE every use of an argument would be evaluated anew."""
    return F.get(F.transform(F.array(c), fn), 0)
