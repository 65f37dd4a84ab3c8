"""Shard placement by a permutation-filled lookup table.

Each shard has its own preference order of the slots of a prime-sized table, (offset + j * skip) mod size,
from a hash of its name.  The shards take turns; in its turn a shard claims the first free slot in its order
(``weight`` slots for a weighted shard).  When the table is full, every shard owns nearly the same number of
slots, and adding or removing a shard moves few of the others' slots.  A row's slot is a hash of its key; the
table, of fixed size whatever the data, is broadcast, so placing a row is one lookup and nothing is shuffled.

Defined results: a null key is placed as the empty string; equal keys always go to one shard; an empty
table gives an empty result; the names of other input columns do not matter.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from connlens.llm.common import field, packed

TABLE_SIZE = 65537
SHARDS = [f"shard-{i:03d}" for i in range(64)]


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def fill_table(shards: list[str], size: int = TABLE_SIZE, weights: list[int] | None = None) -> list[int]:
    """The owner (index into ``shards``) of each of the ``size`` slots; ``size`` is prime and above len(shards)."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be given and distinct")
    if size < len(shards) or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError("the table size must be a prime of at least the number of shards")
    weights = weights or [1] * len(shards)
    place = [_number(f"{s}:offset") % size for s in shards]
    skip = [_number(f"{s}:skip") % (size - 1) + 1 for s in shards]
    owner, free = [-1] * size, size
    while free:
        for i, w in enumerate(weights):
            for _ in range(min(w, free)):
                while owner[place[i]] >= 0:
                    place[i] = (place[i] + skip[i]) % size
                owner[place[i]] = i
                free -= 1
    return owner


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(size)).cast("int")


def assign(df: DataFrame, key_col: str, shards: list[str] = SHARDS, size: int = TABLE_SIZE,
           weights: list[int] | None = None) -> DataFrame:
    """Packed rows with __slot and __shard (the shard's index)."""
    filled = json.dumps(fill_table(shards, size, weights))
    owners = df.sparkSession.range(1).select(F.posexplode(F.from_json(F.lit(filled), "array<int>")).alias("__slot", "__shard"))
    rows = packed(df).withColumn("__slot", slot_of(field(key_col), size))
    return rows.join(F.broadcast(owners), "__slot")


def place(df: DataFrame, key_col: str = "doc_id", shards: list[str] = SHARDS, size: int = TABLE_SIZE,
          weights: list[int] | None = None) -> DataFrame:
    """One row per input row: key, slot, shard."""
    out = assign(df, key_col, shards, size, weights)
    return out.select(field(key_col).alias(key_col), F.col("__slot").alias("slot"), F.col("__shard").alias("shard"))


def write_shards(df: DataFrame, path: str, key_col: str = "doc_id", shards: list[str] = SHARDS, size: int = TABLE_SIZE) -> None:
    """Write the rows, all columns, as one Parquet folder per shard.  No shuffle: each task appends its own file
    to the shards it meets, so a hot shard is many files, not one task."""
    out = assign(df, key_col, shards, size).select(F.col("__shard").alias("shard"), F.col("__row").alias("row"))
    out.write.partitionBy("shard").parquet(path)


def placement_sql(table: str, key_col: str, shards: list[str] = SHARDS, size: int = TABLE_SIZE) -> str:
    filled = json.dumps(fill_table(shards, size))
    return f"""
WITH t AS (SELECT from_json('{filled}', '["INTEGER"]') AS owners),
k AS (SELECT {key_col}, (('0x' || substr(md5(coalesce(CAST({key_col} AS VARCHAR), '')), 1, 15))::BIGINT % {size})::INTEGER AS slot FROM {table})
SELECT k.{key_col}, k.slot, t.owners[k.slot + 1] AS shard FROM k, t
"""
