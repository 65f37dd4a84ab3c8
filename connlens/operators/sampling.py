"""Seeded splitting and re-balancing.

Randomness is an md5 of (seed, row key), so the same rows are chosen on every run,
on any cluster size and in the SQL oracle.  "The first q rows of a stratum in md5
order" is a filter ``md5 <= cut-off``: the cut-off comes from histogram passes that
shuffle no rows (``first_in_hash_order``).  Only k-fold ids need the rank itself;
they use the distributed ``row_rank`` (bucketed prefix counts), never a window that
puts a whole stratum in one task.  Per-class quotas are a table with one row per
class.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from connlens import config
from connlens.functions.core import md5_hex, md5_uniform
from connlens.operators.ordered import first_in_hash_order, row_rank


def row_key(cols: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.col(c).cast("string") for c in cols])


def _class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))


def stratified_split(df: DataFrame, key: Column, label: str, train_ratio: float = config.TRAIN_RATIO,
                     seed: int = config.RANDOM_STATE) -> DataFrame:
    """Add ``split`` = 'train' / 'val': inside each label stratum the first
    round(ratio * n_c) rows in md5(seed|key) order go to train."""
    h = df.withColumn("_h", md5_hex(key, seed))
    def quota(sizes):  # one row per class
        return sizes.select(label, F.floor(F.col("n_c") * train_ratio + 0.5).alias("_q"))

    out = first_in_hash_order(h, "_h", [label], quota)
    return out.withColumn("split", F.when(F.col("_in"), "train").otherwise("val")).drop("_h", "_in")


def largest_remainder_quotas(counts: DataFrame, label: str, size: int) -> DataFrame:
    """Per-class quota summing to ``size`` (proportional, largest remainder, ties by
    label).  ``counts`` has one row per class, so the window over it is bounded."""
    tot = F.sum("n_c").over(Window.partitionBy())
    ex = counts.withColumn("_exact", F.least(F.lit(size), tot) * F.col("n_c") / tot)
    ex = ex.withColumn("_fl", F.floor("_exact")).withColumn("_rem", F.col("_exact") - F.col("_fl"))
    short = F.least(F.lit(size), tot) - F.sum("_fl").over(Window.partitionBy())
    r = F.row_number().over(Window.orderBy(F.col("_rem").desc(), F.col(label)))
    return ex.withColumn("_quota", F.col("_fl") + F.when(r <= short, 1).otherwise(0)).select(label, "n_c", "_quota")


def stratified_subsample(df: DataFrame, key: Column, label: str, size: int = config.SUBSAMPLE_SIZE,
                         seed: int = config.RANDOM_STATE) -> DataFrame:
    """Exactly ``size`` rows (or all rows if fewer), label-proportional."""
    h = df.withColumn("_h", md5_hex(key, seed))
    def quota(sizes):
        return largest_remainder_quotas(sizes, label, size)

    return first_in_hash_order(h, "_h", [label], quota, "_quota").where("_in").drop("_h", "_in")


def uniform_subsample(df: DataFrame, key: Column, size: int, seed: int = config.RANDOM_STATE) -> DataFrame:
    """Exactly ``size`` rows uniformly without replacement (first ``size`` in md5 order)."""
    h = df.withColumn("_h", md5_hex(key, seed))
    q = df.sparkSession.createDataFrame([(int(size),)], "_q long")
    return first_in_hash_order(h, "_h", [], q).where("_in").drop("_h", "_in")


def random_oversample(df: DataFrame, key: Column, label: str, targets: dict,
                      seed: int = config.RANDOM_STATE) -> DataFrame:
    """Grow each listed class to max(n_c, target) by replicating its rows: every row
    gets floor(m / n_c) extra copies and the first (m mod n_c) rows in md5 order one
    more (m = missing rows).  Adds ``replica`` (0 = original)."""
    spark = df.sparkSession
    tgt = spark.createDataFrame([(k, int(v)) for k, v in targets.items()], f"{label} int, _target long")
    h = df.withColumn("_h", md5_hex(key, seed))
    plan = (_class_counts(df, label).join(F.broadcast(tgt), label, "left")
            .select(label, "n_c", F.greatest(F.col("n_c"), F.coalesce("_target", "n_c")).alias("_goal")))
    plan = plan.withColumn("_m", F.col("_goal") - F.col("n_c")).withColumn("_rem", F.col("_m") % F.col("n_c"))
    ranked = first_in_hash_order(h, "_h", [label], plan, "_rem")  # the first (m mod n_c) rows get one more copy
    per = plan.withColumnRenamed(label, "_label")
    j = ranked.join(F.broadcast(per), F.col(label).eqNullSafe(F.col("_label"))).drop("_label")  # one row per class
    copies = (F.floor(F.col("_m") / F.col("n_c")) + F.when(F.col("_in"), 1).otherwise(0)).cast("int")
    # each row fans out into 1 + copies rows; copies is bounded by target / n_c
    out = j.withColumn("replica", F.explode(F.sequence(F.lit(0), copies)))
    return out.drop("_h", "_in", "n_c", "_goal", "_m", "_rem")


def kfold_assign(df: DataFrame, key: Column, label: str, folds: int = 5, seed: int = config.RANDOM_STATE) -> DataFrame:
    """Stratified fold id = (rank in stratum - 1) mod folds."""
    return kfold_of_hash(df.withColumn("_h", md5_hex(key, seed)), "_h", [label], folds)


def kfold_of_hash(df: DataFrame, hash_col: str, strata: list[str], folds: int = 5) -> DataFrame:
    """The same from a column of the md5 (hex or its bytes), which is left out."""
    return row_rank(df, hash_col, strata, "_rk").withColumn("fold", ((F.col("_rk") - 1) % folds).cast("int")).drop(hash_col, "_rk")


def uniform(key: Column, seed: int) -> Column:
    return md5_uniform(key, seed)
