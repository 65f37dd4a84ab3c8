"""Connected components by alternating stars, every table in the shared folder.

A graph of at most ``ONE_TASK`` edges is solved by a union-find in a single task, whose memory that bounds; the
result is the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from connlens.llm.common import lookup_skew_safe
from connlens.session import materialize


ONE_TASK = 250_000


def _union_find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    top: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := top.setdefault(x, x)) != x:
            top[x] = top[up]
            x = up
        return x

    for batch in batches:
        for a, b in zip(*(c.to_pylist() for c in batch.columns)):
            low, high = sorted((root(a), root(b)))
            top[high] = low
    if top:
        yield pa.RecordBatch.from_arrays([pa.array(list(top), pa.int64()), pa.array([root(x) for x in list(top)], pa.int64())], ["node", "root"])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (u, v), u > v.  Each node's neighbours (the larger ones for a large star, the
    smaller ones and itself for a small star) are linked to the least node of its neighbourhood."""
    if large:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select("u", "v")
    least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n")), "star")
    spread = F.concat_ws(":", F.lit("hot"), "u", "v")
    keyed = both.withColumn("k", F.col("u").cast("string"))
    named = least.select(F.col("u").cast("string").alias("k"), "m", "n")
    joined = lookup_skew_safe(keyed, "k", named, ["m"], "n", spread)
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node in ``links`` (columns a, b; longs): root is the component's least node.
    Repeats large and small stars until neither changes the edges; then each node points at its root."""
    links = materialize(links.select("a", "b").where("a <> b"), "links")
    if links.count() <= ONE_TASK:
        return links.coalesce(1).mapInArrow(_union_find, "node long, root long")
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "edges")
    mark = None
    while True:
        edges = materialize(_star(_star(edges, True), False), "edges")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
