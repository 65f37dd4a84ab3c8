"""Classification metrics and score curves.

Counting metrics are conditional sums in one aggregate.  Curves (ROC, PR, AUC, AP)
first collapse the table to distinct scores (one row per score with positive and
negative counts -- ties handled exactly, hot scores become one row) and then use the
distributed ``prefix_sums``; no window ever holds the whole table in one task.
Every ratio follows ``zero_division = 0``; AUC of a single-class input is 0.5.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from connlens.functions.core import col, r6, safe_div
from connlens.session import materialize
from connlens.operators.ordered import prefix_sums


def _cnt(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


# ---------------------------------------------------------------------------
# counting metrics
# ---------------------------------------------------------------------------

def confusion_matrix(df: DataFrame, y: str, yhat: str, labels: Sequence[int]) -> DataFrame:
    """(y_true, y_pred, n) over the full labels x labels grid, zero-filled."""
    counts = df.groupBy(F.col(y).cast("int").alias("y_true"), F.col(yhat).cast("int").alias("y_pred")).agg(
        F.count(F.lit(1)).alias("n"))
    spark = df.sparkSession
    grid = spark.createDataFrame([(a, b) for a in labels for b in labels], "y_true int, y_pred int")
    return grid.join(counts, ["y_true", "y_pred"], "left").select(
        "y_true", "y_pred", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def binary_counts(df: DataFrame, y: str, yhat: str) -> DataFrame:
    yy, pp = col(y) == 1, col(yhat) == 1
    return df.agg(F.count(F.lit(1)).alias("n"), _cnt(yy & pp).alias("tp"), _cnt(~yy & pp).alias("fp"),
                  _cnt(yy & ~pp).alias("fn"), _cnt(~yy & ~pp).alias("tn"))


def binary_from_counts(c: DataFrame) -> DataFrame:
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return c.select(r6(safe_div(tp + tn, F.col("n"))).alias("accuracy"),
                    r6(safe_div(tp, tp + fp)).alias("precision"),
                    r6(safe_div(tp, tp + fn)).alias("recall"),
                    r6(safe_div(2 * tp, 2 * tp + fp + fn)).alias("f1"),
                    r6(safe_div(fp, fp + tn)).alias("fpr"))


def binary_metrics(df: DataFrame, y: str, yhat: str, score: str | None = None) -> DataFrame:
    """accuracy, precision, recall, f1, fpr (+ roc_auc when a score is given)."""
    out = binary_from_counts(binary_counts(df, y, yhat))
    if score is not None:
        auc = roc_auc(df, y, score).scalar()
        out = out.withColumn("roc_auc", r6(auc))
    return out


def per_class(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """(cls, tp, fp, fn, support, precision, recall, f1) for every label present in
    y_true or y_pred (keyed by class id, so classes absent from truth are aligned)."""
    t = df.select(F.col(y).cast("int").alias("_t"), F.col(yhat).cast("int").alias("_p"))
    truth = t.groupBy(F.col("_t").alias("cls")).agg(F.count(F.lit(1)).alias("support"),
                                                    _cnt(F.col("_t") == F.col("_p")).alias("tp"))
    pred = t.groupBy(F.col("_p").alias("cls")).agg(F.count(F.lit(1)).alias("n_pred"))
    j = truth.join(pred, "cls", "full_outer").select(
        "cls", F.coalesce("support", F.lit(0)).alias("support"), F.coalesce("tp", F.lit(0)).alias("tp"),
        F.coalesce("n_pred", F.lit(0)).alias("n_pred"))
    tp = F.col("tp")
    fp, fn = F.col("n_pred") - tp, F.col("support") - tp
    return j.select("cls", tp.cast("long").alias("tp"), fp.cast("long").alias("fp"), fn.cast("long").alias("fn"),
                    F.col("support").cast("long").alias("support"),
                    safe_div(tp, tp + fp).alias("precision"), safe_div(tp, tp + fn).alias("recall"),
                    safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"))


def multiclass_metrics(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """accuracy and unweighted macro precision / recall / F1 over y_true U y_pred, plus
    the per-class recall/F1 map."""
    pc = per_class(df, y, yhat)
    agg = pc.agg(F.sum("tp").alias("tp"), F.sum("support").alias("n"),
                 F.avg("precision").alias("p"), F.avg("recall").alias("r"), F.avg("f1").alias("f"),
                 F.map_from_entries(F.collect_list(F.struct(F.col("cls").cast("string"),
                                                            F.struct(r6("recall").alias("recall"),
                                                                     r6("f1").alias("f1"))))).alias("m"))
    return agg.select(r6(safe_div("tp", "n")).alias("accuracy"), r6("p").alias("precision_macro"),
                      r6("r").alias("recall_macro"), r6("f").alias("f1_macro"), F.col("m").alias("class_specific"))


def fpr(df: DataFrame, y: str, yhat: str) -> Column:
    """FP / (FP + TN) after collapsing to attack (!= 0) vs normal (multiclass safe)."""
    return safe_div(F.count_if((col(y) == 0) & (col(yhat) != 0)), F.count_if(col(y) == 0))


def segment_recall(df: DataFrame, segment: str, yhat: str, positive: Column | None = None) -> DataFrame:
    """(segment, n, detected, recall): share of rows predicted as an attack."""
    det = positive if positive is not None else (col(yhat) != 0)
    return df.groupBy(segment).agg(F.count(F.lit(1)).cast("long").alias("n"), _cnt(det).alias("detected")).select(
        segment, "n", "detected", r6(safe_div("detected", "n")).alias("recall"))


def score_stats(df: DataFrame, score: str, where: Column | None = None) -> DataFrame:
    d = df if where is None else df.where(where)
    return d.agg(F.count(score).cast("long").alias("count"), r6(F.min(score)).alias("min"),
                 r6(F.max(score)).alias("max"), r6(F.avg(score)).alias("mean"))


# ---------------------------------------------------------------------------
# curves
# ---------------------------------------------------------------------------

def score_counts(df: DataFrame, y: str | Column, score: str | Column) -> DataFrame:
    """(score, pos, neg) -- one row per distinct score."""
    yy = col(y).cast("int") == 1
    return df.groupBy(col(score).cast("double").alias("score")).agg(_cnt(yy).alias("pos"), _cnt(~yy).alias("neg"))


def cumulative_desc(df: DataFrame, y: str | Column, score: str | Column) -> tuple[DataFrame, Column, Column]:
    """(score, pos, neg, cum_pos, cum_neg) with cum_* = counts at score >= this score, and
    the totals of positives and negatives (doubles: their product passes 2**31 soon).  The input is read once: its score histogram
    (one row per distinct score) is written, and everything else comes from that."""
    sc = materialize(score_counts(df, y, score), "score-counts")
    total = sc.agg(F.coalesce(F.sum("pos"), F.lit(0)), F.coalesce(F.sum("neg"), F.lit(0))).first()
    return prefix_sums(sc, -F.col("score"), ["pos", "neg"]), F.lit(float(total[0])), F.lit(float(total[1]))


def roc_points(df: DataFrame, y: str | Column, score: str | Column) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score (no intermediate point dropped)."""
    c, P, N = cumulative_desc(df, y, score)
    return c.select(F.col("score").alias("threshold"), r6(safe_div("cum_neg", N)).alias("fpr"),
                    r6(safe_div("cum_pos", P)).alias("tpr"))


def roc_auc(df: DataFrame, y: str | Column, score: str | Column) -> DataFrame:
    """Exact tie-aware ROC AUC (trapezoid over distinct scores); 0.5 if one class."""
    c, P, N = cumulative_desc(df, y, score)
    area = F.sum(F.col("neg") * (F.col("cum_pos") - F.col("pos") + F.col("pos") / 2.0))
    return c.agg(F.when((P > 0) & (N > 0), F.try_divide(area, P * N)).otherwise(F.lit(0.5)).alias("roc_auc"))


def pr_points(df: DataFrame, y: str | Column, score: str | Column) -> DataFrame:
    """(threshold, precision, recall) at every distinct score plus the terminal
    (precision 1, recall 0) point with a null threshold."""
    c, P, _ = cumulative_desc(df, y, score)
    pts = c.select(F.col("score").alias("threshold"),
                   r6(safe_div("cum_pos", F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
                   r6(safe_div("cum_pos", P)).alias("recall"))
    end = df.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"),
                                          F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


def average_precision(df: DataFrame, y: str | Column, score: str | Column) -> DataFrame:
    """AP = sum_n (R_n - R_{n-1}) P_n over thresholds (step rule, not trapezoid)."""
    c, P, _ = cumulative_desc(df, y, score)
    term = F.try_divide(F.col("pos"), P) * (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg")))
    return c.agg(F.when(P > 0, F.sum(term)).otherwise(F.lit(0.0)).alias("average_precision"))


def roc_auc_ovr(df: DataFrame, y: str, probs: str, classes: Sequence[int]) -> DataFrame:
    """Macro one-vs-rest AUC: one row per (class, is_class, p_class), all classes'
    AUCs in one grouped pass, mean.  The exploded table has len(classes) rows per input
    row before the partial aggregate."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("cls"), (F.col(y) == c).cast("int").alias("yy"),
                 F.element_at(probs, c + 1).cast("double").alias("pp")) for c in classes])).alias("e")).select("e.*")
    return roc_auc_by(long, ["cls"], "yy", "pp").agg(r6(F.avg("roc_auc")).alias("roc_auc_macro"))


def roc_auc_by(df: DataFrame, keys: Sequence[str], y: str, score: str) -> DataFrame:
    """Exact AUC per group (few groups: the offsets table is #groups x #buckets)."""
    yy = col(y).cast("int") == 1
    sc = df.groupBy(*keys, col(score).cast("double").alias("score")).agg(_cnt(yy).alias("pos"), _cnt(~yy).alias("neg"))
    c = prefix_sums(materialize(sc, "score-counts"), -F.col("score"), ["pos", "neg"], keys)
    g = c.groupBy(*keys).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"),
                             F.sum(F.col("neg") * (F.col("cum_pos") - F.col("pos") + F.col("pos") / 2.0)).alias("A"))
    return g.select(*keys, F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("A") / (F.col("P").cast("double") * F.col("N")))
                    .otherwise(F.lit(0.5)).alias("roc_auc"))


def macro_by(df: DataFrame, keys: Sequence[str], y: str, yhat: str) -> DataFrame:
    """Macro precision / recall / F1 per group over labels in y_true U y_pred."""
    # every row counts once under its true class and once under its predicted class:
    # one grouped pass (partial aggregation per task) instead of two aggregates + a join
    t = df.select(*keys, F.col(y).cast("int").alias("_t"), F.col(yhat).cast("int").alias("_p"))
    roles = F.explode(F.array(F.struct(F.lit(True).alias("is_truth"), F.col("_t").alias("cls")),
                              F.struct(F.lit(False).alias("is_truth"), F.col("_p").alias("cls")))).alias("r")
    e = t.select(*keys, "_t", "_p", roles).select(*keys, "_t", "_p", "r.is_truth", "r.cls")
    j = e.groupBy(*keys, "cls").agg(_cnt(F.col("is_truth")).alias("support"),
                                    _cnt(F.col("is_truth") & (F.col("_t") == F.col("_p"))).alias("tp"),
                                    _cnt(~F.col("is_truth")).alias("n_pred"))
    tp = F.col("tp")
    fp = F.col("n_pred") - tp
    fn = F.col("support") - tp
    return j.groupBy(*keys).agg(F.avg(safe_div(tp, tp + fp)).alias("precision_macro"),
                                F.avg(safe_div(tp, tp + fn)).alias("recall_macro"),
                                F.avg(safe_div(2 * tp, 2 * tp + fp + fn)).alias("f1_macro"))
