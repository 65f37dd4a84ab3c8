"""Metric and curve queries over the scored view and a tie-heavy lineitem score."""

from __future__ import annotations

from pyspark.sql import functions as F

from connlens import config
from connlens.functions.core import r6
from connlens.operators import labels as L
from connlens.operators import metrics as M
from connlens.operators.ordered import exact_quantiles
from connlens.plans import sqlfrag as Q
from connlens.plans.registry import register
from connlens.sources.tables import SCORED_CTE, scored_view, table, with_ctes

CLASSES = [0, 1, 2, 3, 4]


def multi_pred(score="score"):
    s = F.col(score)
    return F.when(s < 0.4, 0).when(s < 0.5, 3).when(s < 0.6, 1).otherwise(2)


MULTI_PRED_SQL = "CASE WHEN score < 0.4 THEN 0 WHEN score < 0.5 THEN 3 WHEN score < 0.6 THEN 1 ELSE 2 END"


def evaluated(spark, sf_dir):
    s = scored_view(spark, sf_dir)
    return s.select("row_id", "class", "score", L.binary_label().alias("y"), L.family_label().alias("y_multi"),
                    L.segment().alias("segment"), (F.col("score") >= 0.5).cast("int").alias("pred"),
                    multi_pred().alias("pred_multi"),
                    F.array(1 - F.col("score"), F.col("score"), F.col("score") * F.col("score"), F.sqrt("score"),
                            F.col("score") * (1 - F.col("score"))).alias("probs"))


EVAL_CTE = f"""ev AS (SELECT row_id, class, score, {Q.binary_label()} AS y, {Q.family_label()} AS y_multi,
  {Q.segment()} AS segment, CAST(score >= 0.5 AS INTEGER) AS pred, {MULTI_PRED_SQL} AS pred_multi,
  1 - score AS p0, score AS p1, score * score AS p2, sqrt(score) AS p3, score * (1 - score) AS p4 FROM scored)"""
W = with_ctes(SCORED_CTE, EVAL_CTE)


def tie_input(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select((F.col("l_returnflag") == "R").cast("int").alias("y"), F.col("l_discount").alias("score"))


TIE_CTE = "ev AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS y, l_discount AS score FROM lineitem)"


def _curve_cte(src="ev", y="y", score="score"):
    return f""", h AS (SELECT {score} AS score, sum({y}) AS pos, count(*) - sum({y}) AS neg FROM {src} GROUP BY {score}),
c AS (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS cpos,
             sum(neg) OVER (ORDER BY score DESC) AS cneg FROM h),
tot AS (SELECT sum(pos) AS P, sum(neg) AS N FROM h)"""


def _auc_sql(src="ev", y="y", score="score"):
    return _curve_cte(src, y, score) + f"""
SELECT {Q.r6("CASE WHEN P > 0 AND N > 0 THEN sum(neg * (cpos - pos + pos / 2.0)) / (P * N) ELSE 0.5 END")} AS roc_auc
FROM c, tot GROUP BY P, N"""


@register("confusion_matrix", W + f"""
SELECT g.y_true, g.y_pred, CAST(COALESCE(c.n, 0) AS BIGINT) AS n
FROM (SELECT a.range::INTEGER AS y_true, b.range::INTEGER AS y_pred FROM range(5) a, range(5) b) g
LEFT JOIN (SELECT y_multi AS y_true, pred_multi AS y_pred, count(*) AS n FROM ev GROUP BY 1, 2) c
  ON g.y_true = c.y_true AND g.y_pred = c.y_pred""")
def q_confusion_matrix(spark, sf_dir):
    return M.confusion_matrix(evaluated(spark, sf_dir), "y_multi", "pred_multi", CLASSES)


#: Of a table ev with y, pred and score.
BINARY_SQL = _curve_cte() + f"""
, k AS (SELECT count(*) AS n, sum(CASE WHEN y = 1 AND pred = 1 THEN 1 ELSE 0 END) AS tp,
               sum(CASE WHEN y = 0 AND pred = 1 THEN 1 ELSE 0 END) AS fp,
               sum(CASE WHEN y = 1 AND pred = 0 THEN 1 ELSE 0 END) AS fn,
               sum(CASE WHEN y = 0 AND pred = 0 THEN 1 ELSE 0 END) AS tn FROM ev),
a AS (SELECT CASE WHEN P > 0 AND N > 0 THEN sum(neg * (cpos - pos + pos / 2.0)) / (P * N) ELSE 0.5 END AS auc
      FROM c, tot GROUP BY P, N)
SELECT {Q.r6(Q.sdiv('tp + tn', 'n'))} AS accuracy, {Q.r6(Q.sdiv('tp', 'tp + fp'))} AS precision,
       {Q.r6(Q.sdiv('tp', 'tp + fn'))} AS recall, {Q.r6(Q.sdiv('2 * tp', '2 * tp + fp + fn'))} AS f1,
       {Q.r6(Q.sdiv('fp', 'fp + tn'))} AS fpr, {Q.r6('auc')} AS roc_auc FROM k, a"""


@register("binary_metrics", W + BINARY_SQL)
def q_binary_metrics(spark, sf_dir):
    return M.binary_metrics(evaluated(spark, sf_dir), "y", "pred", "score")


PER_CLASS_SQL = """
, t AS (SELECT y_multi AS cls, count(*) AS support, sum(CASE WHEN y_multi = pred_multi THEN 1 ELSE 0 END) AS tp
        FROM ev GROUP BY 1),
p AS (SELECT pred_multi AS cls, count(*) AS n_pred FROM ev GROUP BY 1),
pc AS (SELECT COALESCE(t.cls, p.cls) AS cls, COALESCE(tp, 0) AS tp, COALESCE(n_pred, 0) - COALESCE(tp, 0) AS fp,
              COALESCE(support, 0) - COALESCE(tp, 0) AS fn, COALESCE(support, 0) AS support
       FROM t FULL OUTER JOIN p ON t.cls = p.cls)"""


@register("per_class_metrics", W + PER_CLASS_SQL + f"""
SELECT CAST(cls AS INTEGER) AS cls, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn,
       CAST(support AS BIGINT) AS support, {Q.r6(Q.sdiv('tp', 'tp + fp'))} AS precision,
       {Q.r6(Q.sdiv('tp', 'tp + fn'))} AS recall, {Q.r6(Q.sdiv('2 * tp', '2 * tp + fp + fn'))} AS f1 FROM pc""")
def q_per_class_metrics(spark, sf_dir):
    pc = M.per_class(evaluated(spark, sf_dir), "y_multi", "pred_multi")
    return pc.select("cls", "tp", "fp", "fn", "support", r6("precision").alias("precision"),
                     r6("recall").alias("recall"), r6("f1").alias("f1"))


@register("multiclass_metrics", W + PER_CLASS_SQL + f"""
SELECT {Q.r6(Q.sdiv('sum(tp)', 'sum(support)'))} AS accuracy,
       {Q.r6(f"avg({Q.sdiv('tp', 'tp + fp')})")} AS precision_macro,
       {Q.r6(f"avg({Q.sdiv('tp', 'tp + fn')})")} AS recall_macro,
       {Q.r6(f"avg({Q.sdiv('2 * tp', '2 * tp + fp + fn')})")} AS f1_macro FROM pc""")
def q_multiclass_metrics(spark, sf_dir):
    return M.multiclass_metrics(evaluated(spark, sf_dir), "y_multi", "pred_multi").drop("class_specific")


@register("roc_auc", W + _auc_sql())
def q_roc_auc(spark, sf_dir):
    return M.roc_auc(evaluated(spark, sf_dir), "y", "score").select(r6("roc_auc").alias("roc_auc"))


@register("roc_auc_ties", with_ctes(TIE_CTE) + _auc_sql())
def q_roc_auc_ties(spark, sf_dir):
    return M.roc_auc(tie_input(spark, sf_dir), "y", "score").select(r6("roc_auc").alias("roc_auc"))


@register("roc_auc_ovr", W + ", long AS (" + " UNION ALL ".join(
    f"SELECT {c} AS cls, CAST(y_multi = {c} AS INTEGER) AS yy, p{c} AS pp FROM ev" for c in CLASSES) + ")"
    + ", per AS (" + " UNION ALL ".join(
        f"SELECT * FROM (WITH ev AS (SELECT yy AS y, pp AS score FROM long WHERE cls = {c})"
        + _auc_sql().replace("SELECT " + Q.r6("CASE WHEN P > 0 AND N > 0 THEN sum(neg * (cpos - pos + pos / 2.0)) / (P * N) ELSE 0.5 END") + " AS roc_auc",
                             "SELECT CASE WHEN P > 0 AND N > 0 THEN sum(neg * (cpos - pos + pos / 2.0)) / (P * N) ELSE 0.5 END AS auc")
        + ")" for c in CLASSES) + f") SELECT {Q.r6('avg(auc)')} AS roc_auc_macro FROM per")
def q_roc_auc_ovr(spark, sf_dir):
    return M.roc_auc_ovr(evaluated(spark, sf_dir), "y_multi", "probs", CLASSES)


@register("roc_curve_points", W + _curve_cte() + f"""
SELECT score AS threshold, {Q.r6(Q.sdiv('cneg', 'N'))} AS fpr, {Q.r6(Q.sdiv('cpos', 'P'))} AS tpr FROM c, tot""")
def q_roc_curve_points(spark, sf_dir):
    return M.roc_points(evaluated(spark, sf_dir), "y", "score")


@register("pr_curve_points", with_ctes(TIE_CTE) + _curve_cte() + f"""
SELECT score AS threshold, {Q.r6(Q.sdiv('cpos', 'cpos + cneg'))} AS precision, {Q.r6(Q.sdiv('cpos', 'P'))} AS recall
FROM c, tot UNION ALL SELECT NULL::DOUBLE, 1.0, 0.0""")
def q_pr_curve_points(spark, sf_dir):
    return M.pr_points(tie_input(spark, sf_dir), "y", "score")


@register("average_precision", with_ctes(TIE_CTE) + _curve_cte() + f"""
SELECT {Q.r6("CASE WHEN max(P) > 0 THEN sum((pos * 1.0 / P) * (cpos * 1.0 / (cpos + cneg))) ELSE 0.0 END")}
       AS average_precision FROM c, tot""")
def q_average_precision(spark, sf_dir):
    return M.average_precision(tie_input(spark, sf_dir), "y", "score").select(
        r6("average_precision").alias("average_precision"))


@register("fpr", W + f"""
SELECT {Q.r6(Q.sdiv("count(*) FILTER (WHERE y_multi = 0 AND pred_multi <> 0)", "count(*) FILTER (WHERE y_multi = 0)"))}
       AS fpr FROM ev""")
def q_fpr(spark, sf_dir):
    e = evaluated(spark, sf_dir)
    return e.agg(r6(M.fpr(e, "y_multi", "pred_multi")).alias("fpr"))


@register("segment_recall", W + f"""
SELECT segment, CAST(count(*) AS BIGINT) AS n, CAST(sum(pred) AS BIGINT) AS detected,
       {Q.r6(Q.sdiv('sum(pred)', 'count(*)'))} AS recall FROM ev GROUP BY segment""")
def q_segment_recall(spark, sf_dir):
    return M.segment_recall(evaluated(spark, sf_dir), "segment", "pred", F.col("pred") == 1)


@register("rare_class_recall", W + f"""
SELECT {Q.r6(Q.sdiv("count(*) FILTER (WHERE y_multi = 4 AND pred_multi = 4)", "count(*) FILTER (WHERE y_multi = 4)"))}
       AS u2r_recall,
       {Q.r6(Q.sdiv("count(*) FILTER (WHERE y_multi = 3 AND pred_multi = 3)", "count(*) FILTER (WHERE y_multi = 3)"))}
       AS r2l_recall FROM ev""")
def q_rare_class_recall(spark, sf_dir):
    e = evaluated(spark, sf_dir)
    rec = lambda c: r6(F.try_divide(F.count_if((F.col("y_multi") == c) & (F.col("pred_multi") == c)).cast("double"),
                                    F.count_if(F.col("y_multi") == c).cast("double")))
    return e.agg(F.coalesce(rec(4), F.lit(0.0)).alias("u2r_recall"), F.coalesce(rec(3), F.lit(0.0)).alias("r2l_recall"))


@register("score_stats", W + f"""
SELECT CAST(count(score) AS BIGINT) AS count, {Q.r6('min(score)')} AS min, {Q.r6('max(score)')} AS max,
       {Q.r6('avg(score)')} AS mean FROM ev WHERE pred = 1""")
def q_score_stats(spark, sf_dir):
    return M.score_stats(evaluated(spark, sf_dir), "score", F.col("pred") == 1)


CONTAM = [c for c in config.IF_CONTAMINATIONS if c != "auto"]


@register("contamination_cutoff", W + " UNION ALL ".join(
    f"SELECT {float(c)!r}::DOUBLE AS contamination, {Q.r6(f'quantile_cont(score, {float(c)!r})')} AS cutoff "
    f"FROM ev WHERE y = 0" for c in CONTAM))
def q_contamination_cutoff(spark, sf_dir):
    train = evaluated(spark, sf_dir).where("y = 0")
    q = exact_quantiles(train, ["score"], [float(c) for c in CONTAM])
    return q.select(F.col("q").alias("contamination"), r6("value").alias("cutoff"))


@register("topk_importance", " UNION ALL ".join(
    f"SELECT {i} AS feature, {Q.r6(f'abs(corr(CAST(embedding[{i + 1}] AS DOUBLE), CAST(label = 5 AS DOUBLE)))')} AS importance FROM embeddings"
    for i in range(64)).join(["SELECT * FROM (", ") ORDER BY importance DESC, feature LIMIT 10"]))
def q_topk_importance(spark, sf_dir):
    """Top 10 of the 64 embedding dimensions by |corr(dim, label = 5)| (one aggregate
    for all dimensions, then a top-10 -- the limit is the feature)."""
    e = table(spark, sf_dir, "embeddings")
    y = (F.col("label") == 5).cast("double")
    one = e.agg(*[F.abs(F.corr(F.element_at("embedding", i + 1).cast("double"), y)).alias(f"c{i}") for i in range(64)])
    long = one.select(F.explode(F.array(*[F.struct(F.lit(i).alias("feature"), r6(F.col(f"c{i}")).alias("importance"))
                                          for i in range(64)])).alias("x")).select("x.*")
    return long.orderBy(F.col("importance").desc(), "feature").limit(10)
