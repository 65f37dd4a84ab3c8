"""Two-stage decision rule: anomaly filter -> classifier router -> override threshold.

Everything is one ``CASE`` expression over columns already on the row (stage-1
anomaly flag and score, stage-2 prediction and probabilities); a sweep over k
override thresholds is one conditional aggregate, so each row is scored once.
NULL threshold = always override (never NaN: Spark orders NaN above all numbers).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from connlens.functions.core import col, r6, safe_div
from connlens.operators.labels import family_name


def decide(s1_anomaly: str | Column, s2_pred: str | Column, d1: str | Column, t_strict: float | None) -> Column:
    """S1 normal -> 0; S2 attack -> S2; else override (3) when t is None or d1 < t, else 0."""
    override = F.lit(True) if t_strict is None else (col(d1) < F.lit(float(t_strict)))
    return (F.when(~col(s1_anomaly), F.lit(0))
            .when(col(s2_pred) != 0, col(s2_pred))
            .when(override, F.lit(3))
            .otherwise(F.lit(0))).cast("int")


def serve(s1_anomaly: str | Column, s2_pred: str | Column, d1: str | Column, probs: str | Column,
          t_strict: float | None) -> Column:
    """Response struct (is_attack, attack_family, confidence, stage1_score)."""
    p = col(probs)
    pred = decide(s1_anomaly, s2_pred, d1, t_strict)
    known = col(s1_anomaly) & (col(s2_pred) != 0)
    overridden = col(s1_anomaly) & (col(s2_pred) == 0) & (pred == 3)
    conf = (F.when(known, F.element_at(p, col(s2_pred).cast("int") + 1))
            .when(overridden, F.lit(1.0))
            .otherwise(F.element_at(p, 1)))
    return F.struct((pred != 0).alias("is_attack"), family_name(pred).alias("attack_family"),
                    conf.cast("double").alias("confidence"), col(d1).cast("double").alias("stage1_score"))


def _cnt(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


def hybrid_sweep(df: DataFrame, t_values: Sequence[float | None], s1: str = "s1_anomaly", s2: str = "s2_pred",
                 d1: str = "d1", y: str = "y", y_multi: str = "y_multi", segment: str = "segment") -> DataFrame:
    """Metrics of the hybrid rule for every override threshold, one pass over ``df``."""
    yy, seg, ym = col(y) == 1, col(segment), col(y_multi)
    aggs = [F.count(F.lit(1)).alias("n"), _cnt(yy).alias("n_pos"), _cnt(seg == "normal").alias("n_normal"),
            _cnt(seg == "seen").alias("n_seen"), _cnt(seg == "novel").alias("n_novel"),
            _cnt(ym == 4).alias("n_u2r"), _cnt(ym == 3).alias("n_r2l")]
    for i, t in enumerate(t_values):
        p = decide(s1, s2, d1, t)
        a = p != 0
        aggs += [_cnt(a & yy).alias(f"tp{i}"), _cnt(a & ~yy).alias(f"fp{i}"), _cnt(a & (seg == "normal")).alias(f"fpn{i}"),
                 _cnt(a & (seg == "seen")).alias(f"ds{i}"), _cnt(a & (seg == "novel")).alias(f"dn{i}"),
                 _cnt((p == 4) & (ym == 4)).alias(f"u{i}"), _cnt((p == 3) & (ym == 3)).alias(f"r{i}")]
    one = df.agg(*aggs)
    rows = F.explode(F.array(*[F.struct(
        F.lit(None if t is None else float(t)).cast("double").alias("t_strict"),
        *[F.col(f"{k}{i}").alias(k) for k in ("tp", "fp", "fpn", "ds", "dn", "u", "r")])
        for i, t in enumerate(t_values)])).alias("x")
    long = one.select("n", "n_pos", "n_normal", "n_seen", "n_novel", "n_u2r", "n_r2l", rows)
    tp, fp = F.col("x.tp"), F.col("x.fp")
    fn = F.col("n_pos") - tp
    return long.select(
        F.col("x.t_strict").alias("t_strict"),
        r6(safe_div(tp, tp + fp)).alias("precision"), r6(safe_div(tp, F.col("n_pos"))).alias("recall"),
        r6(safe_div(2 * tp, 2 * tp + fp + fn)).alias("f1_score"),
        r6(safe_div(tp + (F.col("n") - F.col("n_pos") - fp), F.col("n"))).alias("accuracy"),
        r6(safe_div(F.col("x.fpn"), F.col("n_normal"))).alias("fpr"),
        r6(safe_div(F.col("x.ds"), F.col("n_seen"))).alias("seen_recall"),
        r6(safe_div(F.col("x.dn"), F.col("n_novel"))).alias("novel_recall"),
        r6(safe_div(F.col("x.u"), F.col("n_u2r"))).alias("u2r_recall"),
        r6(safe_div(F.col("x.r"), F.col("n_r2l"))).alias("r2l_recall"))


def best_operating_point(sweep: DataFrame) -> DataFrame:
    """Best F1, then lowest FPR; the always-override (NULL) row first on ties.
    The sweep has one row per threshold (fixed grid), so the window is bounded."""
    w = Window.orderBy(F.col("f1_score").desc(), F.col("fpr").asc(), F.col("t_strict").asc_nulls_first())
    return sweep.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def prediction_counts(df: DataFrame, t_values: Sequence[float | None], s1: str = "s1_anomaly",
                      s2: str = "s2_pred", d1: str = "d1") -> DataFrame:
    """(t_strict, pred, n): every threshold applied to every row, counted in one pass."""
    aggs = []
    for i, t in enumerate(t_values):
        p = decide(s1, s2, d1, t)
        aggs += [_cnt(p == c).alias(f"c{i}_{c}") for c in range(5)]
    one = df.agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(None if t is None else float(t)).cast("double").alias("t_strict"),
                                        F.lit(c).alias("pred"), F.col(f"c{i}_{c}").alias("n"))
                               for i, t in enumerate(t_values) for c in range(5)])).alias("x")
    return one.select(rows).select("x.t_strict", "x.pred", "x.n").where("n > 0")
