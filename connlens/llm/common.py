"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hot keys joined by broadcast: those with more than 1/MAX_HOT of all rows, hence fewer than MAX_HOT.
MAX_HOT = 2000


def packed(df: DataFrame) -> DataFrame:
    """The rows as one struct column ``__row``, so that no input column can clash with an operator's own."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"))


def field(name: str) -> Column:
    return F.col("__row").getField(name)


def lookup_skew_safe(rows: DataFrame, key: str, lookup: DataFrame, values: list[str], weight: str,
                     spread: Column, keep: str = "left") -> DataFrame:
    """Left-join (or, with ``keep="inner"``, inner-join) ``rows`` to ``lookup`` on the string or long column ``key``.

    ``lookup`` is a written table with one row per key; its ``weight`` column holds the number of rows of each
    key.  Keys with more than 1/MAX_HOT of the total weight are fewer than MAX_HOT by counting: they are
    broadcast.  The other rows are shuffled on the key; the rows already matched travel with the unique value
    ``spread`` in place of their key (it must match no key), so no task gets a hot key's rows.
    """
    total = lookup.agg(F.sum(weight)).first()[0] or 0
    named = [F.col(v).alias(f"__{v}") for v in values]
    hot = lookup.where(F.col(weight) * MAX_HOT > total).select(F.col(key), F.lit(True).alias("__hot"), *named)
    cold = lookup.where(F.col(weight) * MAX_HOT <= total).select(F.col(key).alias("__key"), F.lit(True).alias("__cold"), *[F.col(v).alias(f"__cold_{v}") for v in values])
    first = rows.join(F.broadcast(hot), key, "left")
    out = first.withColumn("__key", F.when(F.col("__hot"), spread).otherwise(F.col(key))).join(cold, "__key", "left")
    if keep == "inner":
        out = out.where(F.col("__hot") | F.col("__cold"))
    chosen = [F.when(F.col("__hot"), F.col(f"__{v}")).otherwise(F.col(f"__cold_{v}")).alias(v) for v in values]
    return out.select(*[F.col(c) for c in rows.columns], *chosen)
