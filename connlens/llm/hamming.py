"""Exact top-k search over binary codes by incremental multi-index hashing.

A code is cut into m segments of about log2(n) bits, and an index keeps, for every segment, the codes by their
value there.  A query looks up the values at distance 0 from its own in the first segment, the second, ..., then
those at distance 1, and so on, and computes the full Hamming distance of every code it meets.  When radius r is
done in s segments and r - 1 in the others, any code not met is at a distance of m * r + s at least; the search
ends as soon as the k-th distance so far lies below that.  So the result is exact.

The codes are dealt into blocks; each (block, query chunk) is one task of bounded size that searches its block
alone, and the blocks' k best are merged.  Of rows with one and the same code only the k smallest ids can be in a
result, so a hot code costs k rows a block; equal query codes are searched once.

Defined results: distances tie by id, null ids last; a row finds itself too; rows with a null vector (or code) are
neither found nor searched for; a null or NaN component is bit 0; shorter codes are padded with zero bits; a table
of fewer than k rows gives all of them; an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from math import comb, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from connlens.llm.common import lookup_skew_safe
from connlens.session import materialize, ship_package

K = 10
BLOCK_ROWS, CHUNK_ROWS = 1 << 18, 1 << 15


def sign_codes(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and code (binary): bit i is set where component i is above 0, eight to a byte, the first the highest."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = []
            for vector in batch.column(1):
                x = None if not vector.is_valid else vector.values.fill_null(0).to_numpy(zero_copy_only=False)
                codes.append(None if x is None else np.packbits(x > 0).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes, pa.binary())], ["id", "code"])

    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("vector"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, code binary").where("code is not null")


@lru_cache(256)
def flips(bits: int, radius: int) -> np.ndarray:
    """All numbers of ``bits`` bits of which ``radius`` are set."""
    return np.array([sum(1 << b for b in c) for c in combinations(range(bits), radius)], np.int64)


class MultiIndex:
    def __init__(self, codes: np.ndarray, segments: int | None = None):
        """``codes``: one row of bytes a code."""
        self.codes = codes
        bits = codes.shape[1] * 8
        count = segments or max(1, round(bits / max(1.0, log2(max(2, len(codes))))))
        count = min(bits, max(count, -(-bits // 32)))
        self.cuts = np.linspace(0, bits, count + 1).astype(int)
        self.values, self.starts, self.orders = [], [], []
        for s in range(count):
            value = self._segment(codes, s)
            order = np.argsort(value, kind="stable")
            distinct, start = np.unique(value[order], return_index=True)
            self.values.append(distinct)
            self.starts.append(np.append(start, len(order)))
            self.orders.append(order)

    def _segment(self, codes: np.ndarray, s: int) -> np.ndarray:
        bits = np.unpackbits(codes, axis=1)[:, self.cuts[s]:self.cuts[s + 1]].astype(np.int64)
        return bits @ (1 << np.arange(bits.shape[1], dtype=np.int64)[::-1])

    def _at(self, s: int, value: int, radius: int) -> np.ndarray:
        """The codes whose segment ``s`` is at distance ``radius`` from ``value``."""
        width, distinct = int(self.cuts[s + 1] - self.cuts[s]), self.values[s]
        if comb(width, radius) < len(distinct):
            wanted = value ^ flips(width, radius)
            at = np.searchsorted(distinct, wanted)
            at = at[(at < len(distinct)) & (distinct[np.minimum(at, len(distinct) - 1)] == wanted)]
        else:
            at = np.flatnonzero(np.bitwise_count(distinct ^ value) == radius)
        start, order = self.starts[s], self.orders[s]
        return np.concatenate([order[start[i]:start[i + 1]] for i in at.tolist()]) if len(at) else at

    def search(self, query: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(codes' numbers, distances) of the k best by distance and ``ids``, and how many codes were met."""
        count = len(self.cuts) - 1
        own = [int(self._segment(query[None], s)[0]) for s in range(count)]
        met = np.zeros(len(self.codes), bool)
        found, distance = np.zeros(0, np.int64), np.zeros(0, np.int64)
        k = min(k, len(self.codes))
        for step in range(int(np.diff(self.cuts).max() + 1) * count):
            radius, s = divmod(step, count)
            new = self._at(s, own[s], radius)
            new = np.unique(new[~met[new]])
            met[new] = True
            if len(new):
                far = np.bitwise_count(self.codes[new] ^ query).sum(1, dtype=np.int64)
                found, distance = np.concatenate((found, new)), np.concatenate((distance, far))
                best = np.lexsort((ids[found], distance))[:k]
                found, distance = found[best], distance[best]
            if len(found) == k and (k == 0 or distance[-1] <= step):
                break
        return found, distance, int(met.sum())


def search(index: DataFrame, queries: DataFrame, k: int = K, block_rows: int = BLOCK_ROWS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``index`` and ``queries`` have id (long) and code (binary): query_id, rank (from 1), neighbor_id, distance."""
    spark = index.sparkSession
    ship_package(spark)
    first = Window.partitionBy("code").orderBy(F.col("id").asc_nulls_last())
    kept = materialize(index.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k).drop("n"), "codes")
    asked = materialize(queries.groupBy("code").agg(F.count("*").alias("n")), "query-codes")
    blocks = max(spark.sparkContext.defaultParallelism, -(-kept.count() // block_rows))
    pieces = max(1, -(-asked.count() // chunk_rows))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = kept.withColumn("block", F.pmod(F.xxhash64("id", "code"), F.lit(blocks))).withColumn("piece", every(pieces))
    right = asked.select("code", every(blocks).alias("block"), F.pmod(F.xxhash64("code"), F.lit(pieces)).alias("piece"))

    def run(table: pa.Table, wanted: pa.Table) -> pa.Table:
        raw, questions = table["code"].to_pylist(), wanted["code"].to_pylist()
        size = max(map(len, [*raw, *questions]), default=0)
        as_bytes = lambda x: np.frombuffer(b"".join([c.ljust(size, b"\0") for c in x]), np.uint8).reshape(len(x), size)
        code, ids, distance = [], [], []
        if raw and questions and size:
            rows = table["id"]
            order = rows.fill_null(np.iinfo(np.int64).max).to_numpy()
            own, own_ids = MultiIndex(as_bytes(raw)), rows.to_pylist()
            for question, bits in zip(questions, as_bytes(questions)):
                found, far, _ = own.search(bits, order, k)
                code += [question] * len(found)
                ids += [own_ids[i] for i in found]
                distance += far.tolist()
        return pa.table({"code": pa.array(code, pa.binary()), "neighbor_id": pa.array(ids, pa.int64()), "distance": pa.array(distance, pa.int32())})

    tasks = min(10_000, 3 * blocks * pieces)  # a set number, else these small partitions are merged into one task
    left, right = (side.repartition(tasks, "block", "piece") for side in (left, right))
    local = left.groupBy("block", "piece").cogroup(right.groupBy("block", "piece")).applyInArrow(run, "code binary, neighbor_id long, distance int")
    best = Window.partitionBy("code").orderBy("distance", F.col("neighbor_id").asc_nulls_last())
    top = local.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    listed = top.groupBy("code").agg(F.array_sort(F.collect_list(F.struct("rank", "neighbor_id", "distance"))).alias("top"))
    listed = materialize(listed.join(asked, "code").select(F.hex("code").alias("key"), "top", "n"), "nearest")
    answered = lookup_skew_safe(queries.select(F.col("id").alias("query_id"), F.hex("code").alias("key")), "key", listed, ["top"], "n",
                                F.concat_ws(":", F.lit("hot"), F.monotonically_increasing_id()), keep="inner")
    return answered.select("query_id", F.explode("top").alias("t")).select("query_id", "t.rank", "t.neighbor_id", "t.distance")


SEARCH_SQL = f"""
WITH c AS (SELECT vec_id, array_to_string(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), '')::BIT AS code
           FROM embeddings WHERE embedding IS NOT NULL),
p AS (SELECT q.vec_id AS query_id, b.vec_id AS neighbor_id, bit_count(xor(q.code, b.code))::INTEGER AS distance
      FROM c q, c b WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id)::INTEGER AS rank, neighbor_id, distance
FROM p QUALIFY rank <= {K}
"""
