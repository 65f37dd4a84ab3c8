"""Join operators.

Only tables whose size is fixed by construction (the 40-name taxonomy, the 22-name
seen list, per-class statistics with one row per class) are broadcast explicitly;
everything that grows with the data is joined without a hint so Spark chooses from
its size estimate and AQE can re-plan (sort-merge, skew split) at runtime.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from connlens import config


def mapping_table(spark: SparkSession, mapping: dict, key: str = "key", value: str = "value",
                  value_type: str = "int") -> DataFrame:
    return spark.createDataFrame([(k, v) for k, v in mapping.items()], f"{key} string, {value} {value_type}")


def join_lookup_broadcast(df: DataFrame, map_df: DataFrame, on_expr, key: str, value: str,
                          out: str, default=None) -> DataFrame:
    """Left join a small mapping table (broadcast) and fill misses with ``default``."""
    j = df.join(F.broadcast(map_df.withColumnRenamed(key, "_mk")), on_expr(F.col("_mk")), "left")
    v = F.col(value) if default is None else F.coalesce(F.col(value), F.lit(default))
    return j.select(*df.columns, v.alias(out))


def seen_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(a,) for a in config.SEEN_ATTACKS], "attack string")


def semi_seen(df: DataFrame, class_col: str = "class") -> DataFrame:
    """Rows whose normalised attack name is in the seen set (left semi join)."""
    seen = F.broadcast(seen_table(df.sparkSession))
    return df.join(seen, F.lower(F.trim(F.col(class_col))) == seen["attack"], "left_semi")


def anti_novel(df: DataFrame, class_col: str = "class") -> DataFrame:
    """Attack rows (not normal) whose name is NOT in the seen set (left anti join)."""
    seen = F.broadcast(seen_table(df.sparkSession))
    attacks = df.where(F.lower(F.trim(F.col(class_col))) != "normal")
    return attacks.join(seen, F.lower(F.trim(F.col(class_col))) == seen["attack"], "left_anti")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, weight) with the balanced rule n / (k * n_c)."""
    g = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    n = g.agg(F.sum("n_c")).scalar()
    k = g.agg(F.count(F.lit(1))).scalar()
    return g.select(label, (n / (k * F.col("n_c"))).alias("weight"))


def join_class_weight(df: DataFrame, label: str, weight_col: str = "weight") -> DataFrame:
    """Attach the balanced class weight; one row per class, so broadcast is bounded
    by the number of classes."""
    w = class_weights(df, label).withColumnRenamed("weight", weight_col)
    w = w.withColumnRenamed(label, "_label")
    return df.join(F.broadcast(w), F.col(label).eqNullSafe(F.col("_label"))).drop("_label")


def manifest_diff(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Positional compare of two (pos, name) feature lists: one audit row with status
    DEVIATION_DETECTED (names differ at a position both lists have), else INCOMPATIBLE
    (one list is longer), else COMPATIBLE."""
    j = expected.alias("e").join(actual.alias("a"), F.col("e.pos") == F.col("a.pos"), "full_outer")
    pos = F.coalesce(F.col("e.pos"), F.col("a.pos"))
    mism = F.col("e.pos").isNotNull() & F.col("a.pos").isNotNull() & ~F.col("e.name").eqNullSafe(F.col("a.name"))
    agg = j.agg(
        F.count(F.col("e.pos")).alias("expected_count"), F.count(F.col("a.pos")).alias("actual_count"),
        F.min(F.when(mism, pos)).alias("first_mismatch_pos"),
        F.min_by(F.col("e.name"), F.when(mism, pos)).alias("expected_name"),
        F.min_by(F.col("a.name"), F.when(mism, pos)).alias("actual_name"))
    status = (F.when(F.col("first_mismatch_pos").isNotNull(), "DEVIATION_DETECTED")
              .when(F.col("expected_count") != F.col("actual_count"), "INCOMPATIBLE").otherwise("COMPATIBLE"))
    return agg.select(F.col("expected_count").cast("long"), F.col("actual_count").cast("long"),
                      status.alias("status"), "first_mismatch_pos", "expected_name", "actual_name")


def names_table(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(names)), "pos int, name string")
