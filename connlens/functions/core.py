"""Scalar column expressions used across operators.

All of these are built-in Spark expressions (JVM side, inside whole-stage codegen);
none of them is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: str | Column, den: str | Column) -> Column:
    """num / den with the ``zero_division = 0`` rule (null or zero denominator -> 0.0)."""
    return F.coalesce(F.try_divide(col(num).cast("double"), col(den).cast("double")), F.lit(0.0))


def r6(c: str | Column) -> Column:
    """Round to 6 decimals and fold -0.0 into 0.0 (the report precision).

    Rounding to 9 decimals first removes last-bit differences between summation
    orders, so a value that is mathematically a tie rounds the same everywhere."""
    return F.round(F.round(col(c).cast("double"), 9), 6) + F.lit(0.0)


def md5_hex(key: str | Column, seed: int = 42) -> Column:
    """md5('seed|key'): a reproducible per-row hash shared with the SQL oracle."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), col(key).cast("string")))


def md5_uniform(key: str | Column, seed: int = 42) -> Column:
    """Uniform [0, 1) derived from the first 32 bits of ``md5_hex`` (same in DuckDB)."""
    h = md5_hex(key, seed)
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def isin_fixed(c: str | Column, values: Iterable) -> Column:
    """Membership in a fixed, small literal list (compiled into the projection)."""
    return col(c).isin(list(values))


def literal_map(mapping: dict) -> Column:
    """A fixed literal map column built from a small python dict."""
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)
