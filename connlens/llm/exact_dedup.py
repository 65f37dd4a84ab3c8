"""Exact deduplication by skew-safe combining, in DataFrame operations only.

Texts are equal when their normalised forms (each run of ASCII white space is one space, null is empty)
are equal.  The combining has three stages, and each groups by digest *and* full normalised text, so two
texts that share a digest are never taken for one another:

1. every map task folds its own rows (Spark's partial aggregate): a hot text leaves one row per task;
2. the task winners meet in salted groups (digest, text, salt), so a hot text is merged by many tasks;
3. the salt winners, at most ``salts`` per text, meet globally.

Defined results: a null text counts as empty; a null id loses to any other id, and a group of null ids only
has a null ``keep_id``.  Rows that repeat both id and text share one verdict in ``verdicts`` (their copies
cannot be told apart there); ``kept_rows`` returns exactly one row per distinct text.  An empty table gives
an empty result; further input columns, whatever their names, are carried (``kept_rows``) or ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from connlens.llm.common import field, lookup_skew_safe, packed
from connlens.session import materialize

SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def sha256_hex(norm: Column) -> Column:
    return F.sha2(norm, 256)


def _keyed(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    rows = packed(docs).select("__row", field(id_col).alias("__id"), normalised(field(text_col)).alias("__norm"))
    return rows.withColumn("__digest", digest(F.col("__norm")))


def winners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 32,
            digest: Callable[[Column], Column] = sha256_hex) -> DataFrame:
    """One row per distinct normalised text: __digest, __keep, __size, and __content, the text itself where
    another text has the same digest (else null).  Written to the shared folder."""
    rows = _keyed(docs, id_col, text_col, digest).select("__id", "__digest", "__norm")
    local = rows.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    salted = local.groupBy("__digest", "__norm", "__salt").agg(F.min("__id").alias("__id"), F.count("*").alias("__n"))
    merged = (salted.repartition("__digest").groupBy("__digest", "__norm")
              .agg(F.min("__id").alias("__keep"), F.sum("__n").alias("__size")))
    shared = F.count("*").over(Window.partitionBy("__digest")) > 1
    out = merged.select("__digest", "__keep", "__size", F.when(shared, F.col("__norm")).alias("__content"))
    return materialize(out, "exact-winners")


def _annotated(rows: DataFrame, won: DataFrame) -> DataFrame:
    """Rows with __keep and __size of their text.  Digests with one text, in practice all, join on the digest;
    if any has several, their rows are joined on digest and full text."""
    spread = F.concat_ws(":", F.lit("hot"), F.monotonically_increasing_id())
    single, several = won.where(F.col("__content").isNull()), won.where(F.col("__content").isNotNull())
    narrow = rows.drop("__norm")
    if several.isEmpty():
        return lookup_skew_safe(narrow, "__digest", single, ["__keep", "__size"], "__size", spread)
    plain = lookup_skew_safe(narrow, "__digest", single, ["__keep", "__size"], "__size", spread, keep="inner")
    full = rows.join(several.withColumnRenamed("__content", "__norm"), ["__digest", "__norm"])
    return plain.unionByName(full.select(*plain.columns))


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 32,
             digest: Callable[[Column], Column] = sha256_hex) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    won = winners(docs, id_col, text_col, salts, digest)
    rows = _keyed(docs, id_col, text_col, digest).withColumn("__sha", F.col("__digest") if digest is sha256_hex else sha256_hex(F.col("__norm")))
    out = _annotated(rows.drop("__row"), won)
    return out.select(F.col("__id").alias(id_col), F.col("__keep").alias("keep_id"), F.col("__size").alias("group_size"),
                      F.col("__id").eqNullSafe(F.col("__keep")).alias("kept"), F.col("__sha").alias("text_sha256"))


def kept_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 32,
              digest: Callable[[Column], Column] = sha256_hex) -> DataFrame:
    """The input rows that stay, all their columns unchanged, one per distinct normalised text."""
    won = winners(docs, id_col, text_col, salts, digest)
    rows = _keyed(docs, id_col, text_col, digest)
    several = not won.where(F.col("__content").isNotNull()).isEmpty()
    kept = _annotated(rows, won).where(F.col("__id").eqNullSafe(F.col("__keep")))
    one = ["__digest", "__text"] if several else ["__digest"]
    if several:
        kept = kept.withColumn("__text", normalised(field(text_col)))
    return kept.dropDuplicates(one).select("__row.*")


VERDICT_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(n.t) AS text_sha256
FROM n JOIN g ON n.t = g.t
"""
