"""Report operators over metric-record tables (one row per model x task x split).

Record tables are small by construction (models x tasks x configurations), so the
windows here are bounded; the heavy lifting happens where the records are computed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from connlens.functions.core import r6

LEADERBOARD_ORDER = ["recall", "f1", "roc_auc", "accuracy"]


def leaderboard(records: DataFrame, partition: Sequence[str] = (), order: Sequence[str] = LEADERBOARD_ORDER,
                name: str = "model_name", rank_col: str = "rank") -> DataFrame:
    """Rank 1..n by the metric hierarchy (all descending), model name breaks ties."""
    w = Window.partitionBy(*partition).orderBy(*[F.col(c).desc() for c in order], F.col(name).asc())
    return records.withColumn(rank_col, F.row_number().over(w).cast("int"))


def holdout_gap(val: DataFrame, holdout: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Holdout rows left-joined to their validation row; a missing validation value
    counts as 0.0; gap = val - test."""
    v = val.select(*keys, *[F.col(m).alias(f"val_{m}") for m in metrics])
    h = holdout.select(*keys, *[F.col(m).alias(f"test_{m}") for m in metrics],
                       *[c for c in holdout.columns if c not in keys and c not in metrics])
    j = h.join(v, list(keys), "left")
    out = [F.coalesce(F.col(f"val_{m}"), F.lit(0.0)).alias(f"val_{m}") for m in metrics]
    gaps = [r6(F.coalesce(F.col(f"val_{m}"), F.lit(0.0)) - F.col(f"test_{m}")).alias(f"{m}_gap") for m in metrics]
    rest = [c for c in j.columns if c not in {f"val_{m}" for m in metrics}]
    return j.select(*rest, *out, *gaps)


def best_by(records: DataFrame, metric, how: str = "max", name: str = "model_name") -> DataFrame:
    """The single record with the min/max of ``metric`` (name breaks ties)."""
    m = F.col(metric) if isinstance(metric, str) else metric
    key = m.desc() if how == "max" else m.asc()
    ties = [F.col(name).asc()] + ([F.col("target_type").asc()] if "target_type" in records.columns else [])
    w = Window.orderBy(key, *ties)
    return records.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def selection_matrix(records: DataFrame, novel_min: float = 0.75, u2r_min: float = 0.5) -> DataFrame:
    """Deployability status per record; every record of the fastest model (by name)
    becomes the low-latency alternative."""
    fastest = best_by(records, "fit_time", "min").select("model_name").agg(F.first("model_name")).scalar()
    status = (F.when(F.col("model_name") == fastest, "Low-Latency Alternative")
              .when((F.col("novel_recall") > novel_min) | (F.col("u2r_recall") > u2r_min), "Production Candidate")
              .otherwise("Rejected (Overfitting)"))
    return records.withColumn("status", status)


def threshold_delta(sweep: DataFrame, optimal: DataFrame, default: float = 0.50,
                    metrics: Sequence[str] = ("novel_attack_recall", "fpr", "precision", "f1_score")) -> DataFrame:
    """Default-threshold row vs the chosen operating point, with change columns
    (one conditional aggregate over the sweep; the optimum is a scalar subquery)."""
    opt = optimal.agg(F.first("threshold")).scalar()
    pick = lambda t, m: F.max(F.when(F.col("threshold") == t, F.col(m)))
    one = sweep.agg(*[pick(F.lit(default), m).alias(f"default_{m}") for m in metrics],
                    *[pick(opt, m).alias(f"optimal_{m}") for m in metrics], F.max(F.when(F.col("threshold") == opt,
                                                                                     F.col("threshold"))).alias("optimal_threshold"))
    return one.select(F.lit(default).alias("default_threshold"), "optimal_threshold",
                      *[F.col(f"default_{m}") for m in metrics], *[F.col(f"optimal_{m}") for m in metrics],
                      *[r6(F.col(f"optimal_{m}") - F.col(f"default_{m}")).alias(f"change_{m}") for m in metrics])


def champion_per_model(results: DataFrame, model: str, order: Sequence) -> DataFrame:
    w = Window.partitionBy(model).orderBy(*order)
    return results.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
