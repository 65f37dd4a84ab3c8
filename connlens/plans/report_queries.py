"""Report queries over the scored view: threshold sweep and operating point."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from connlens import config
from connlens.operators import labels as L
from connlens.operators.sweep import operating_point, threshold_sweep
from connlens.plans import sqlfrag as Q
from connlens.plans.registry import register
from connlens.sources.tables import SCORED_CTE, scored_view, with_ctes


def scored_labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scored_view(spark, sf_dir)
    return s.select("row_id", "class", "score",
                    L.binary_label("class").alias("target_label"),
                    L.family_label("class").alias("multiclass_label"),
                    L.segment("class").alias("segment"))


LABELED_CTE = f"""labeled AS (
  SELECT row_id, class, score, {Q.binary_label()} AS target_label,
         {Q.family_label()} AS multiclass_label, {Q.segment()} AS segment
  FROM scored)"""


def _sweep_sql(th) -> str:
    return f"""sweep AS (
  SELECT t.threshold,
         count(*) AS n, sum(target_label) AS n_pos,
         sum(CASE WHEN segment = 'normal' THEN 1 ELSE 0 END) AS n_normal,
         sum(CASE WHEN segment = 'seen' THEN 1 ELSE 0 END) AS n_seen,
         sum(CASE WHEN segment = 'novel' THEN 1 ELSE 0 END) AS n_novel,
         sum(CASE WHEN score >= t.threshold AND target_label = 1 THEN 1 ELSE 0 END) AS tp,
         sum(CASE WHEN score >= t.threshold AND target_label = 0 THEN 1 ELSE 0 END) AS fp,
         sum(CASE WHEN score >= t.threshold AND segment = 'normal' THEN 1 ELSE 0 END) AS fpn,
         sum(CASE WHEN score >= t.threshold AND segment = 'seen' THEN 1 ELSE 0 END) AS ps,
         sum(CASE WHEN score >= t.threshold AND segment = 'novel' THEN 1 ELSE 0 END) AS pn
  FROM labeled, {Q.values_doubles(th, 'threshold')} t
  GROUP BY t.threshold),
metrics AS (
  SELECT threshold,
         {Q.r6(Q.sdiv('tp', 'tp + fp'))} AS precision,
         {Q.r6(Q.sdiv('tp', 'n_pos'))} AS recall,
         {Q.r6(Q.sdiv('pn', 'n_novel'))} AS novel_attack_recall,
         {Q.r6(Q.sdiv('ps', 'n_seen'))} AS seen_attack_recall,
         {Q.r6(Q.sdiv('2 * tp', '2 * tp + fp + (n_pos - tp)'))} AS f1_score,
         {Q.r6(Q.sdiv('fpn', 'n_normal'))} AS fpr,
         {Q.r6(Q.sdiv('tp + (n - n_pos - fp)', 'n'))} AS accuracy,
         CAST(tp + fp AS BIGINT) AS n_predicted_attack
  FROM sweep)"""


SWEEP_SQL = with_ctes(SCORED_CTE, LABELED_CTE, _sweep_sql(config.THRESHOLDS))


def sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threshold_sweep(scored_labeled(spark, sf_dir), thresholds=config.THRESHOLDS)


@register("report_threshold_sweep", SWEEP_SQL + "SELECT * FROM metrics")
def q_report_threshold_sweep(spark, sf_dir):
    return sweep(spark, sf_dir)


@register("top1_operating_point", SWEEP_SQL + f"""
SELECT *, (novel_attack_recall >= {config.TARGET_NOVEL_RECALL} AND fpr <= {config.TARGET_FPR}) AS meets_target
FROM metrics
ORDER BY (novel_attack_recall >= {config.TARGET_NOVEL_RECALL} AND fpr <= {config.TARGET_FPR}) DESC,
         novel_attack_recall DESC,
         CASE WHEN novel_attack_recall >= {config.TARGET_NOVEL_RECALL} AND fpr <= {config.TARGET_FPR}
              THEN fpr END ASC NULLS LAST,
         threshold ASC
LIMIT 1""")
def q_top1_operating_point(spark, sf_dir):
    return operating_point(sweep(spark, sf_dir), min_recall=config.TARGET_NOVEL_RECALL,
                           max_fpr=config.TARGET_FPR)


# ---------------------------------------------------------------------------
# model-result records derived from the scored view
# ---------------------------------------------------------------------------

from pyspark.sql import functions as F  # noqa: E402

from connlens.functions.core import r6, safe_div  # noqa: E402
from connlens.operators import metrics as M  # noqa: E402
from connlens.operators import reports as R  # noqa: E402
from connlens.operators.sweep import _cnt  # noqa: E402
from connlens.plans import fitted as FIT  # noqa: E402
from connlens.plans.metric_queries import EVAL_CTE  # noqa: E402

def model_eval(spark, sf_dir):
    """Per validation or holdout row and learner fitted to the training rows: its probability, its binary and its
    5-class prediction."""
    from connlens.session import materialize
    rows = materialize(FIT.learner_rows(spark, sf_dir), "learner-rows", spread="row_id")
    return FIT.scored(rows, FIT.fit(rows))


def records(spark, sf_dir):
    """A row per learner, target and split, written once: reports read it several times."""
    from connlens.session import materialize
    # five metric families (binary, 5-class, macro, AUC bounds, AUC sums) read the
    # per-(row, learner) table: written once as a table in the shared checkpoint folder,
    # not recomputed (hashes included) once per family
    me = materialize(model_eval(spark, sf_dir), "model-eval")
    keys = ["model_name", "midx", "split"]
    seg = F.col("segment")

    def det_rate(det, among):
        return safe_div(_cnt(det & among), _cnt(among))

    # binary and 5-class counts share ONE grouped pass over the scored rows
    pb, pm = F.col("pb"), F.col("pm")
    counts = me.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        safe_div(_cnt(F.col("y") == F.col("pb")), F.count(F.lit(1))).alias("accuracy"),
        safe_div(_cnt((F.col("y") == 1) & (F.col("pb") == 1)), _cnt(F.col("pb") == 1)).alias("precision"),
        safe_div(_cnt((F.col("y") == 1) & (F.col("pb") == 1)), _cnt(F.col("y") == 1)).alias("recall"),
        safe_div(2 * _cnt((F.col("y") == 1) & (F.col("pb") == 1)),
                 _cnt(F.col("y") == 1) + _cnt(F.col("pb") == 1)).alias("f1"),
        det_rate(F.col("pb") == 1, F.col("y") == 0).alias("fpr"),
        det_rate(F.col("pb") == 1, seg == "seen").alias("seen_recall"),
        det_rate(F.col("pb") == 1, seg == "novel").alias("novel_recall"),
        det_rate(F.col("pb") == 1, F.col("y_multi") == 4).alias("u2r_recall"),
        det_rate(F.col("pb") == 1, F.col("y_multi") == 3).alias("r2l_recall"),
        safe_div(_cnt(F.col("y_multi") == pm), F.count(F.lit(1))).alias("m_accuracy"),
        det_rate(pm != 0, F.col("y_multi") == 0).alias("m_fpr"),
        det_rate(pm != 0, seg == "seen").alias("m_seen_recall"),
        det_rate(pm != 0, seg == "novel").alias("m_novel_recall"),
        det_rate(pm == 4, F.col("y_multi") == 4).alias("m_u2r_recall"),
        det_rate(pm == 3, F.col("y_multi") == 3).alias("m_r2l_recall"),
    )
    bin_cols = ["accuracy", "precision", "recall", "f1", "fpr", "seen_recall", "novel_recall", "u2r_recall",
                "r2l_recall"]
    b = counts.select(*keys, "n", *bin_cols).withColumn("target_type", F.lit("binary"))
    mc = counts.join(M.macro_by(me, keys, "y_multi", "pm"), keys).select(
        *keys, "n", F.col("m_accuracy").alias("accuracy"), F.col("precision_macro").alias("precision"),
        F.col("recall_macro").alias("recall"), F.col("f1_macro").alias("f1"),
        *[F.col(f"m_{c}").alias(c) for c in ["fpr", "seen_recall", "novel_recall", "u2r_recall", "r2l_recall"]],
    ).withColumn("target_type", F.lit("multiclass"))
    auc = M.roc_auc_by(me, keys, "y", "sm")
    both = b.unionByName(mc).join(auc, keys)
    metric_cols = ["accuracy", "precision", "recall", "f1", "roc_auc", "fpr", "seen_recall", "novel_recall",
                   "u2r_recall", "r2l_recall"]
    out = both.select("model_name", "target_type", "split", *[r6(c).alias(c) for c in metric_cols],
                      r6(F.col("n") * (F.col("midx") + 1) / 100000.0).alias("fit_time"))
    return materialize(out, "model-records")


def _sdiv_cnt(cond, among):
    return Q.sdiv(f"count(*) FILTER (WHERE ({cond}) AND ({among}))", f"count(*) FILTER (WHERE {among})")


ME_CTE = f"""{FIT.ME_SQL},
bin AS (SELECT model_name, midx, split, count(*) AS n,
   {Q.sdiv("count(*) FILTER (WHERE y = pb)", "count(*)")} AS accuracy,
   {Q.sdiv("count(*) FILTER (WHERE y = 1 AND pb = 1)", "count(*) FILTER (WHERE pb = 1)")} AS precision,
   {Q.sdiv("count(*) FILTER (WHERE y = 1 AND pb = 1)", "count(*) FILTER (WHERE y = 1)")} AS recall,
   {Q.sdiv("2 * count(*) FILTER (WHERE y = 1 AND pb = 1)", "count(*) FILTER (WHERE y = 1) + count(*) FILTER (WHERE pb = 1)")} AS f1,
   {_sdiv_cnt("pb = 1", "y = 0")} AS fpr, {_sdiv_cnt("pb = 1", "segment = 'seen'")} AS seen_recall,
   {_sdiv_cnt("pb = 1", "segment = 'novel'")} AS novel_recall, {_sdiv_cnt("pb = 1", "y_multi = 4")} AS u2r_recall,
   {_sdiv_cnt("pb = 1", "y_multi = 3")} AS r2l_recall, 'binary' AS target_type
  FROM me GROUP BY model_name, midx, split),
pct AS (SELECT model_name, midx, split, cls, sum(support) AS support, sum(tp) AS tp, sum(n_pred) AS n_pred FROM (
    SELECT model_name, midx, split, y_multi AS cls, count(*) AS support,
           count(*) FILTER (WHERE y_multi = pm) AS tp, 0 AS n_pred FROM me GROUP BY ALL
    UNION ALL SELECT model_name, midx, split, pm AS cls, 0, 0, count(*) FROM me GROUP BY ALL) GROUP BY ALL),
mac AS (SELECT model_name, midx, split, avg({Q.sdiv('tp', 'n_pred')}) AS precision,
        avg({Q.sdiv('tp', 'support')}) AS recall, avg({Q.sdiv('2 * tp', 'support + n_pred')}) AS f1
        FROM pct GROUP BY ALL),
mul AS (SELECT model_name, midx, split, count(*) AS n,
   {Q.sdiv("count(*) FILTER (WHERE y_multi = pm)", "count(*)")} AS accuracy,
   {_sdiv_cnt("pm <> 0", "y_multi = 0")} AS fpr, {_sdiv_cnt("pm <> 0", "segment = 'seen'")} AS seen_recall,
   {_sdiv_cnt("pm <> 0", "segment = 'novel'")} AS novel_recall, {_sdiv_cnt("pm = 4", "y_multi = 4")} AS u2r_recall,
   {_sdiv_cnt("pm = 3", "y_multi = 3")} AS r2l_recall, 'multiclass' AS target_type
  FROM me GROUP BY model_name, midx, split),
sh AS (SELECT model_name, midx, split, sm, sum(y) AS pos, count(*) - sum(y) AS neg FROM me GROUP BY ALL),
sc AS (SELECT *, sum(pos) OVER (PARTITION BY model_name, split ORDER BY sm DESC) AS cpos FROM sh),
auc AS (SELECT model_name, split, CASE WHEN sum(pos) > 0 AND sum(neg) > 0
          THEN sum(neg * (cpos - pos + pos / 2.0)) / (sum(pos) * sum(neg)) ELSE 0.5 END AS roc_auc
        FROM sc GROUP BY model_name, split),
allr AS (
  SELECT model_name, midx, split, n, target_type, accuracy, precision, recall, f1, fpr, seen_recall, novel_recall,
         u2r_recall, r2l_recall FROM bin
  UNION ALL
  SELECT mul.model_name, mul.midx, mul.split, n, target_type, accuracy, mac.precision, mac.recall, mac.f1, fpr,
         seen_recall, novel_recall, u2r_recall, r2l_recall
  FROM mul JOIN mac ON mul.model_name = mac.model_name AND mul.split = mac.split),
records AS (
  SELECT a.model_name, target_type, a.split, {Q.r6('accuracy')} AS accuracy, {Q.r6('precision')} AS precision,
         {Q.r6('recall')} AS recall, {Q.r6('f1')} AS f1, {Q.r6('roc_auc')} AS roc_auc, {Q.r6('fpr')} AS fpr,
         {Q.r6('seen_recall')} AS seen_recall, {Q.r6('novel_recall')} AS novel_recall,
         {Q.r6('u2r_recall')} AS u2r_recall, {Q.r6('r2l_recall')} AS r2l_recall,
         {Q.r6('n * (midx + 1) / 100000.0')} AS fit_time
  FROM allr a JOIN auc ON a.model_name = auc.model_name AND a.split = auc.split)"""

from connlens.plans.metric_queries import EVAL_CTE as _EV  # noqa: E402,F811

REC = with_ctes(SCORED_CTE, _EV, ME_CTE)
REC_COLS = ("model_name, target_type, split, accuracy, precision, recall, f1, roc_auc, fpr, seen_recall, "
            "novel_recall, u2r_recall, r2l_recall, fit_time")


@register("model_records", REC + f"SELECT {REC_COLS} FROM records")
def q_model_records(spark, sf_dir):
    return records(spark, sf_dir)


def _val(spark, sf_dir):
    return records(spark, sf_dir).where("split = 'val'").drop("split")


LB_COLS = ["model_name", "target_type", "recall", "f1", "roc_auc", "accuracy", "fit_time"]


@register("leaderboard_rank", REC + """
SELECT model_name, target_type, recall, f1, roc_auc, accuracy, fit_time,
       CAST(row_number() OVER (ORDER BY recall DESC, f1 DESC, roc_auc DESC, accuracy DESC, model_name) AS INTEGER) AS rank
FROM records WHERE split = 'val'""")
def q_leaderboard_rank(spark, sf_dir):
    return R.leaderboard(_val(spark, sf_dir).select(*LB_COLS))


@register("rank_within_task", REC + """
SELECT model_name, target_type, recall, f1, roc_auc, accuracy, fit_time,
       CAST(row_number() OVER (PARTITION BY target_type ORDER BY recall DESC, f1 DESC, roc_auc DESC, accuracy DESC,
                               model_name) AS INTEGER) AS rank
FROM records WHERE split = 'val'""")
def q_rank_within_task(spark, sf_dir):
    return R.leaderboard(_val(spark, sf_dir).select(*LB_COLS), ["target_type"])


@register("report_leaderboard", REC + """
SELECT model_name, target_type, rank, rank = 1 AS is_best,
       upper(target_type) AS task,
       array_to_string(list_transform(string_split(model_name, '_'), lambda x: upper(x[1]) || lower(x[2:])), ' ') AS display_name,
       printf('%.4f%%', recall * 100) AS recall_pct, printf('%.2fs', fit_time) AS fit_time_s
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY target_type ORDER BY recall DESC, f1 DESC, roc_auc DESC,
             accuracy DESC, model_name) AS INTEGER) AS rank FROM records WHERE split = 'val')""")
def q_report_leaderboard(spark, sf_dir):
    lb = R.leaderboard(_val(spark, sf_dir), ["target_type"])
    return lb.select("model_name", "target_type", "rank", (F.col("rank") == 1).alias("is_best"),
                     F.upper("target_type").alias("task"),
                     F.initcap(F.replace(F.col("model_name"), F.lit("_"), F.lit(" "))).alias("display_name"),
                     F.format_string("%.4f%%", F.col("recall") * 100).alias("recall_pct"),
                     F.format_string("%.2fs", F.col("fit_time")).alias("fit_time_s"))


GAP_METRICS = ["recall", "f1", "accuracy"]


def _gap(rec):
    val = rec.where("split = 'val'")  # a holdout record without a validation record counts as 0 there
    hold = rec.where("split = 'holdout'").select("model_name", "target_type", *GAP_METRICS, "precision", "roc_auc",
                                                  "seen_recall", "novel_recall")
    return R.holdout_gap(val, hold, ["model_name", "target_type"], GAP_METRICS)


GAP_SQL = REC + """
, v AS (SELECT * FROM records WHERE split = 'val'),
h AS (SELECT * FROM records WHERE split = 'holdout'),
g AS (SELECT h.model_name, h.target_type, h.recall AS test_recall, h.f1 AS test_f1, h.accuracy AS test_accuracy,
             h.precision, h.roc_auc, h.seen_recall, h.novel_recall,
             COALESCE(v.recall, 0.0) AS val_recall, COALESCE(v.f1, 0.0) AS val_f1,
             COALESCE(v.accuracy, 0.0) AS val_accuracy
      FROM h LEFT JOIN v ON h.model_name = v.model_name AND h.target_type = v.target_type)"""
GAP_SELECT = f"""SELECT model_name, target_type, test_recall, test_f1, test_accuracy, precision, roc_auc, seen_recall,
       novel_recall, val_recall, val_f1, val_accuracy, {Q.r6('val_recall - test_recall')} AS recall_gap,
       {Q.r6('val_f1 - test_f1')} AS f1_gap, {Q.r6('val_accuracy - test_accuracy')} AS accuracy_gap"""


@register("join_val_holdout_gap", GAP_SQL + GAP_SELECT + " FROM g")
def q_join_val_holdout_gap(spark, sf_dir):
    return _gap(records(spark, sf_dir))


@register("report_holdout_gap", GAP_SQL + GAP_SELECT + f""", {Q.r6('seen_recall - novel_recall')} AS novel_deficit,
       CAST(row_number() OVER (PARTITION BY target_type ORDER BY novel_recall DESC, model_name) AS INTEGER) AS rank
FROM g""")
def q_report_holdout_gap(spark, sf_dir):
    g = _gap(records(spark, sf_dir)).withColumn("novel_deficit", r6(F.col("seen_recall") - F.col("novel_recall")))
    return R.leaderboard(g, ["target_type"], ["novel_recall"])


SEL_SQL = REC + """
, h AS (SELECT * FROM records WHERE split = 'holdout'),
fast AS (SELECT model_name AS fm FROM h ORDER BY fit_time, model_name, target_type LIMIT 1)"""


@register("report_selection_matrix", SEL_SQL + """
SELECT model_name, target_type, novel_recall, u2r_recall, r2l_recall, fpr, fit_time,
       CASE WHEN model_name = fm THEN 'Low-Latency Alternative'
            WHEN novel_recall > 0.75 OR u2r_recall > 0.5 THEN 'Production Candidate'
            ELSE 'Rejected (Overfitting)' END AS status
FROM h, fast""")
def q_report_selection_matrix(spark, sf_dir):
    h = records(spark, sf_dir).where("split = 'holdout'").select(
        "model_name", "target_type", "novel_recall", "u2r_recall", "r2l_recall", "fpr", "fit_time")
    return R.selection_matrix(h)


@register("deploy_status", SEL_SQL + """
SELECT model_name, target_type, CASE WHEN model_name = fm THEN 'Low-Latency Alternative'
            WHEN novel_recall > 0.75 OR u2r_recall > 0.5 THEN 'Production Candidate'
            ELSE 'Rejected (Overfitting)' END AS status FROM h, fast""")
def q_deploy_status(spark, sf_dir):
    h = records(spark, sf_dir).where("split = 'holdout'")
    return R.selection_matrix(h).select("model_name", "target_type", "status")


@register("best_by", GAP_SQL + """
SELECT * FROM (SELECT 'fastest' AS criterion, model_name, target_type, fit_time AS value FROM records
               WHERE split = 'holdout' ORDER BY fit_time, model_name, target_type LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'best_generalizer', model_name, target_type, abs(val_recall - test_recall) FROM g
               ORDER BY abs(val_recall - test_recall), model_name, target_type LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'best_rare_detector', model_name, target_type, u2r_recall FROM records
               WHERE split = 'holdout' ORDER BY u2r_recall DESC, model_name, target_type LIMIT 1)""")
def q_best_by(spark, sf_dir):
    rec = records(spark, sf_dir)
    h = rec.where("split = 'holdout'")
    g = _gap(rec).withColumn("abs_gap", F.abs(F.col("val_recall") - F.col("test_recall")))
    a = R.best_by(h, "fit_time", "min").select(F.lit("fastest").alias("criterion"), "model_name", "target_type",
                                                F.col("fit_time").alias("value"))
    b = R.best_by(g, "abs_gap", "min").select(F.lit("best_generalizer").alias("criterion"), "model_name",
                                               "target_type", F.col("abs_gap").alias("value"))
    c = R.best_by(h, "u2r_recall", "max").select(F.lit("best_rare_detector").alias("criterion"), "model_name",
                                                  "target_type", F.col("u2r_recall").alias("value"))
    return a.unionByName(b).unionByName(c)


@register("union_records", REC + """
SELECT model_name, target_type, recall, f1, NULL::DOUBLE AS novel_recall, 'baseline' AS phase FROM records
WHERE split = 'val'
UNION ALL SELECT model_name, target_type, recall, f1, novel_recall, 'robust' AS phase FROM records
WHERE split = 'holdout'""")
def q_union_records(spark, sf_dir):
    rec = records(spark, sf_dir)
    a = rec.where("split = 'val'").select("model_name", "target_type", "recall", "f1", F.lit("baseline").alias("phase"))
    b = rec.where("split = 'holdout'").select("model_name", "target_type", "recall", "f1", "novel_recall",
                                              F.lit("robust").alias("phase"))
    return a.unionByName(b, allowMissingColumns=True)


@register("sort_multi_key", REC + """
SELECT model_name, target_type, novel_recall, fpr FROM records WHERE split = 'holdout'
ORDER BY target_type, novel_recall DESC, fpr, model_name""")
def q_sort_multi_key(spark, sf_dir):
    h = records(spark, sf_dir).where("split = 'holdout'")
    return h.select("model_name", "target_type", "novel_recall", "fpr").orderBy(
        "target_type", F.col("novel_recall").desc(), "fpr", "model_name")


@register("champion_per_model", REC + """
SELECT model_name, target_type, split, recall, f1 FROM (
  SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY recall DESC, f1 DESC, target_type, split) AS r
  FROM records) WHERE r = 1""")
def q_champion_per_model(spark, sf_dir):
    rec = records(spark, sf_dir).select("model_name", "target_type", "split", "recall", "f1")
    return R.champion_per_model(rec, "model_name", [F.col("recall").desc(), F.col("f1").desc(), "target_type", "split"])


@register("target_flag", SWEEP_SQL + f"""
SELECT threshold, novel_attack_recall, fpr,
       novel_attack_recall >= {config.TARGET_NOVEL_RECALL} AND fpr <= {config.TARGET_FPR} AS meets_target FROM metrics""")
def q_target_flag(spark, sf_dir):
    s = sweep(spark, sf_dir)
    meets = (F.col("novel_attack_recall") >= config.TARGET_NOVEL_RECALL) & (F.col("fpr") <= config.TARGET_FPR)
    return s.select("threshold", "novel_attack_recall", "fpr", meets.alias("meets_target"))


@register("report_threshold_delta", SWEEP_SQL + f"""
, opt AS (SELECT * FROM metrics ORDER BY (novel_attack_recall >= {config.TARGET_NOVEL_RECALL}
            AND fpr <= {config.TARGET_FPR}) DESC, novel_attack_recall DESC,
            CASE WHEN novel_attack_recall >= {config.TARGET_NOVEL_RECALL} AND fpr <= {config.TARGET_FPR} THEN fpr END
            ASC NULLS LAST, threshold LIMIT 1),
d AS (SELECT * FROM metrics WHERE threshold = 0.5)
SELECT 0.5 AS default_threshold, opt.threshold AS optimal_threshold,
       {", ".join(f"d.{m} AS default_{m}" for m in ("novel_attack_recall", "fpr", "precision", "f1_score"))},
       {", ".join(f"opt.{m} AS optimal_{m}" for m in ("novel_attack_recall", "fpr", "precision", "f1_score"))},
       {", ".join(Q.r6(f"opt.{m} - d.{m}") + f" AS change_{m}" for m in ("novel_attack_recall", "fpr", "precision", "f1_score"))}
FROM opt, d""")
def q_report_threshold_delta(spark, sf_dir):
    s = sweep(spark, sf_dir)
    opt = operating_point(s, min_recall=config.TARGET_NOVEL_RECALL, max_fpr=config.TARGET_FPR)
    return R.threshold_delta(s, opt, 0.5)


@register("cross_threshold_sweep", with_ctes(SCORED_CTE, LABELED_CTE) + " UNION ALL ".join(
    f"SELECT {float(t)!r}::DOUBLE AS threshold, CAST(score >= {float(t)!r} AS INTEGER) AS pred, "
    f"CAST(count(*) AS BIGINT) AS n FROM labeled GROUP BY 2" for t in config.THRESHOLDS))
def q_cross_threshold_sweep(spark, sf_dir):
    """Every threshold applied to every row, counted in one pass (no row replication)."""
    s = scored_labeled(spark, sf_dir)
    aggs = []
    for i, t in enumerate(config.THRESHOLDS):
        aggs += [_cnt(F.col("score") >= t).alias(f"p{i}"), _cnt(F.col("score") < t).alias(f"q{i}")]
    one = s.agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.lit(p).alias("pred"),
                                        F.col(f"{'p' if p else 'q'}{i}").alias("n"))
                               for i, t in enumerate(config.THRESHOLDS) for p in (1, 0)])).alias("x")
    return one.select(rows).select("x.threshold", "x.pred", "x.n").where("n > 0")


@register("score_probability_fallback", with_ctes(SCORED_CTE, _EV, FIT.ME_SQL) + f"""
SELECT row_id, model_name,
       {Q.r6("COALESCE(CASE WHEN model_name <> 'nearest_centroid' THEN sm END, CASE WHEN model_name <> 'decision_tree' THEN margin END, pb)")} AS score,
       CASE WHEN model_name = 'nearest_centroid' THEN 'decision_function' ELSE 'predict_proba' END AS source
FROM me""")
def q_score_probability_fallback(spark, sf_dir):
    """Probability if the learner has one, else its raw decision value, else the hard label (the nearest centroid has no
    probability, the tree no decision value)."""
    me = model_eval(spark, sf_dir)
    proba = F.when(F.col("model_name") != "nearest_centroid", F.col("sm"))
    decision = F.when(F.col("model_name") != "decision_tree", F.col("margin"))
    return me.select("row_id", "model_name", r6(F.coalesce(proba, decision, F.col("pb").cast("double"))).alias("score"),
                     F.when(F.col("model_name") == "nearest_centroid", "decision_function").otherwise("predict_proba").alias("source"))


@register("router_fallback", REC + f"""
, avail AS (SELECT DISTINCT CASE model_name WHEN 'naive_bayes_cost_sensitive' THEN 'logistic_regression_cs_cost_sensitive' ELSE model_name END AS model_name
            FROM records WHERE split = 'val' AND target_type = 'binary' AND roc_auc >= 0.5)
SELECT model_name, CAST(pos AS INTEGER) AS priority FROM avail JOIN
  (VALUES {", ".join(f"({i}, '{n}')" for i, n in enumerate(config.ROUTER_PREFERENCE))}) p(pos, name)
  ON avail.model_name = p.name ORDER BY pos LIMIT 1""")
def q_router_fallback(spark, sf_dir):
    """The first model in order of preference that was fitted here and ranks validation rows no worse than chance; the
    cost-sensitive learner holds the place of the cost-sensitive regression."""
    from connlens.operators.models import router_choice
    good = records(spark, sf_dir).where("split = 'val' AND target_type = 'binary' AND roc_auc >= 0.5")
    name = F.when(F.col("model_name") == "naive_bayes_cost_sensitive", "logistic_regression_cs_cost_sensitive").otherwise(F.col("model_name"))
    return router_choice(good.select(name.alias("model_name")).distinct(), config.ROUTER_PREFERENCE)
