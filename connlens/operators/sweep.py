"""Threshold sweeps and operating-point selection.

A sweep over k thresholds is computed in ONE pass over the scored table: every
threshold contributes a handful of conditional sums to a single global aggregate
(partial aggregation per task, one tiny final merge), and the 1-row result is
unpivoted into k rows.  No row is replicated per threshold and nothing is joined,
so the cost is one scan whatever the table size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from connlens.functions.core import col, r6, safe_div


def _cnt(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


def threshold_sweep(df: DataFrame, label: str = "target_label", score: str = "score",
                    segment: str = "segment", thresholds: Sequence[float] = ()) -> DataFrame:
    """Per threshold tau (predict attack iff score >= tau): precision, recall, seen/novel
    recall, F1, FPR, accuracy and number of predicted attacks (zero_division = 0)."""
    y = col(label) == 1
    seg = col(segment)
    aggs = [F.count(F.lit(1)).alias("n"), _cnt(y).alias("n_pos"),
            _cnt(seg == "normal").alias("n_normal"), _cnt(seg == "seen").alias("n_seen"),
            _cnt(seg == "novel").alias("n_novel")]
    for i, t in enumerate(thresholds):
        p = col(score) >= F.lit(float(t))
        aggs += [_cnt(p & y).alias(f"tp{i}"), _cnt(p & ~y).alias(f"fp{i}"),
                 _cnt(p & (seg == "normal")).alias(f"fpn{i}"),
                 _cnt(p & (seg == "seen")).alias(f"ps{i}"), _cnt(p & (seg == "novel")).alias(f"pn{i}")]
    one = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(float(t)).alias("threshold"), F.col(f"tp{i}").alias("tp"),
                 F.col(f"fp{i}").alias("fp"), F.col(f"fpn{i}").alias("fpn"),
                 F.col(f"ps{i}").alias("ps"), F.col(f"pn{i}").alias("pn"))
        for i, t in enumerate(thresholds)])).alias("r")
    long = one.select("n", "n_pos", "n_normal", "n_seen", "n_novel", rows)
    tp, fp = F.col("r.tp"), F.col("r.fp")
    fn = F.col("n_pos") - tp
    tn = F.col("n") - F.col("n_pos") - fp
    return long.select(
        F.col("r.threshold").alias("threshold"),
        r6(safe_div(tp, tp + fp)).alias("precision"),
        r6(safe_div(tp, F.col("n_pos"))).alias("recall"),
        r6(safe_div(F.col("r.pn"), F.col("n_novel"))).alias("novel_attack_recall"),
        r6(safe_div(F.col("r.ps"), F.col("n_seen"))).alias("seen_attack_recall"),
        r6(safe_div(2 * tp, 2 * tp + fp + fn)).alias("f1_score"),
        r6(safe_div(F.col("r.fpn"), F.col("n_normal"))).alias("fpr"),
        r6(safe_div(tp + tn, F.col("n"))).alias("accuracy"),
        (tp + fp).cast("long").alias("n_predicted_attack"),
    )


def operating_point(sweep: DataFrame, recall_col: str = "novel_attack_recall", fpr_col: str = "fpr",
                    min_recall: float = 0.80, max_fpr: float = 0.06) -> DataFrame:
    """Best row among those meeting both targets (max recall, then min FPR); if none
    meets them, the row with the best recall.  Threshold breaks remaining ties.
    ``meets_target`` says which branch was taken."""
    meets = (F.col(recall_col) >= min_recall) & (F.col(fpr_col) <= max_fpr)
    w = Window.orderBy(meets.desc(), F.col(recall_col).desc(),
                       F.when(meets, F.col(fpr_col)).asc_nulls_last(), F.col("threshold").asc())
    # the sweep has one row per threshold (a fixed, small grid), so an unpartitioned
    # window over it is bounded
    return (sweep.withColumn("meets_target", meets)
            .withColumn("_rn", F.row_number().over(w))
            .where("_rn = 1").drop("_rn"))
