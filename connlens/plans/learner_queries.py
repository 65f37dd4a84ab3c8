"""MLlib learners on the ``conn`` view (rows-only checks: training is not SQL).

Features: log1p of the byte/duration counters, the raw counters and rates; split 80/20
by md5 of the order key.  Each query fits on the train part and returns the metric
row(s) on the validation part.
"""

from __future__ import annotations

import functools
import os

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql import types as T

from connlens import config
from connlens.functions.core import md5_hex, md5_uniform, r6
from connlens.operators import joins as J
from connlens.operators import labels as L
from connlens.operators import metrics as M
from connlens.operators import models as MD
from connlens.operators import sampling as S
from connlens.plans import feature_queries as FQ
from connlens.plans import sqlfrag as Q
from connlens.plans.label_queries import DIFF_SQL
from connlens.plans.quality_queries import CONN_COLS
from connlens.plans.registry import register
from connlens.session import drop_table, materialize
from connlens.sources import io as IO
from connlens.sources import schemas
from connlens.sources.tables import CONN_CTE, conn_view, with_ctes

FEATS = ["f_duration", "f_src", "f_dst", "count_", "hot", "serror_rate", "rerror_rate", "logged_in"]


def learn_frame(spark, sf_dir):
    c = conn_view(spark, sf_dir)
    d = c.select(F.concat_ws("|", "l_orderkey", "l_partkey", "dst_host", "l_linenumber",
                             F.col("count_").cast("long")).alias("rkey"),
                 F.log1p("duration").alias("f_duration"), F.log1p("src_bytes").alias("f_src"),
                 F.log1p("dst_bytes").alias("f_dst"), "count_", "hot", "serror_rate", "rerror_rate",
                 F.col("logged_in").cast("double").alias("logged_in"),
                 L.binary_label().cast("double").alias("y"), L.family_label().cast("double").alias("y_multi"),
                 F.when(md5_uniform("l_orderkey", 9) < config.TRAIN_RATIO, "train").otherwise("val").alias("split"))
    return d


def learn_split(spark, sf_dir, keyed=True):
    """Train / validation rows of one table written to the checkpoint folder: MLlib makes
    many passes over its input, which then read the table instead of re-running the
    three-table join (lineage cut; survives executor loss).  The rows are dealt evenly over
    several files a core: a learner's tasks follow the files, and where the join ran beside
    the scan of one row group, one task had all the rows in every pass.  Learners that do not
    use the row key (``keyed=False``), a long string, have its hash shuffled and nothing of it written."""
    d = learn_frame(spark, sf_dir)
    if not keyed:
        d = d.withColumn("rkey", F.xxhash64("rkey"))
    d = MD.assemble(materialize(d, "learn-frame", spread="rkey", keep_spread=keyed), FEATS)
    return d.where("split = 'train'"), d.where("split = 'val'")


def _binary_report(pred, name, score_col="p1"):
    pred = materialize(pred.select("y", "prediction", score_col), "predictions")  # two aggregates: the rows are scored once
    m = M.binary_metrics(pred, "y", "prediction", score_col)
    return m.select(F.lit(name).alias("model_name"), F.lit("binary").alias("target_type"), "*")


def _multi_report(pred, name):
    pred = materialize(pred.select("y_multi", "prediction"), "predictions")  # two aggregates: the rows are scored once
    m = M.multiclass_metrics(pred, "y_multi", "prediction").drop("class_specific")
    return m.select(F.lit(name).alias("model_name"), F.lit("multiclass").alias("target_type"), "*")


def _p1(df):
    return df.withColumn("p1", vector_to_array("probability")[1])


@register("fit_logistic")
def q_fit_logistic(spark, sf_dir):
    tr, va = learn_split(spark, sf_dir, keyed=False)
    base = MD.fit_logistic(tr, "y")
    w = J.join_class_weight(tr, "y")
    cs = MD.fit_logistic(w, "y", weight="weight")
    return _binary_report(_p1(base.transform(va)), "logistic_regression").unionByName(
        _binary_report(_p1(cs.transform(va)), "logistic_regression_cs"))


@register("fit_tree")
def q_fit_tree(spark, sf_dir):
    tr, va = learn_split(spark, sf_dir, keyed=False)
    w = J.join_class_weight(tr, "y_multi")
    a = MD.fit_tree(tr, "y_multi", 10)
    b = MD.fit_tree(w, "y_multi", 10, weight="weight")
    return _multi_report(a.transform(va), "decision_tree").unionByName(_multi_report(b.transform(va), "decision_tree_cs"))


@register("fit_random_forest")
def q_fit_random_forest(spark, sf_dir):
    tr, va = learn_split(spark, sf_dir, keyed=False)
    m = MD.fit_random_forest(tr, "y", 100, 10)
    return _binary_report(_p1(m.transform(va)), "random_forest")


@register("fit_gbt")
def q_fit_gbt(spark, sf_dir):
    tr, va = learn_split(spark, sf_dir, keyed=False)
    m = MD.fit_gbt(tr, "y", 100, 5, 0.05, 0.8)
    return _binary_report(_p1(m.transform(va)), "gradient_boosting")


@register("fit_gbt_ovr")
def q_fit_gbt_ovr(spark, sf_dir):
    tr, va = learn_split(spark, sf_dir, keyed=False)
    m = MD.fit_gbt_ovr(tr, "y_multi", 100, 5, 0.05, 0.8)
    return _multi_report(MD.ovr_probabilities(m.transform(va)), "gradient_boosting")


@register("fit_linear_svm")
def q_fit_linear_svm(spark, sf_dir):
    tr, va = learn_split(spark, sf_dir, keyed=False)
    svm, platt = MD.fit_linear_svm(tr, "y")
    p = MD.svm_probability(svm, platt, va)
    return _binary_report(_p1(p), "svm")


@register("fit_adaboost")
def q_fit_adaboost(spark, sf_dir):
    tr, va = learn_split(spark, sf_dir, keyed=False)
    model = MD.fit_adaboost(tr, FEATS, "y", 100, 2)
    p = MD.adaboost_predict(model, va, keep=["y"])
    p = p.withColumn("prediction", F.col("pred").cast("double")).withColumn("p1", F.col("score"))
    return _binary_report(p, "adaboost")


@register("fit_random_forest_multi")
def q_fit_random_forest_multi(spark, sf_dir):
    tr, va = learn_split(spark, sf_dir, keyed=False)
    return _multi_report(MD.fit_random_forest(tr, "y_multi", 100, 10).transform(va), "random_forest")


@register("fit_linear_svm_multi")
def q_fit_linear_svm_multi(spark, sf_dir):
    tr, va = learn_split(spark, sf_dir, keyed=False)
    return _multi_report(MD.fit_linear_svm_ovr(tr, "y_multi").transform(va), "svm")


@register("fit_adaboost_multi")
def q_fit_adaboost_multi(spark, sf_dir):
    tr, va = learn_split(spark, sf_dir, keyed=False)
    p = MD.adaboost_predict(MD.fit_adaboost(tr, FEATS, "y_multi", 100, 5), va, keep=["y_multi"])
    return _multi_report(p.withColumn("prediction", F.col("pred").cast("double")), "adaboost")


@register("vote_soft_mllib")
def q_vote_soft_mllib(spark, sf_dir):
    """Mean of naive-Bayes, random-forest and logistic probabilities, argmax."""
    tr, va = learn_split(spark, sf_dir, keyed=False)
    nb = MD.gaussian_nb_fit(tr, FEATS, "y")
    rf = MD.fit_random_forest(tr, "y", 100, 10)
    lr = MD.fit_logistic(tr, "y")
    # every model scores the same row: the transforms are chained, nothing is joined
    j = MD.gaussian_nb_predict(va, nb, FEATS, keep=["y", "features"]).withColumnRenamed("probability", "p_nb").drop("pred")
    for name, model in (("p_rf", rf), ("p_lr", lr)):
        j = model.transform(j).withColumn(name, vector_to_array("probability")).drop("rawPrediction", "probability", "prediction")
    prob, pred = MD.soft_vote("p_nb", "p_rf", "p_lr")
    out = j.select("y", pred.cast("double").alias("prediction"), F.element_at(prob, 2).alias("p1"))
    return _binary_report(out, "voting_nb_rf_lr")


def folded_rows(spark, sf_dir):
    """The rows of ``learn_split`` with the folds of the training rows.  Of the row key only 16 bytes of hash are written
    and shuffled, and of all columns only those that the learners read; the rows are shuffled once, by the ranking."""
    frame = learn_frame(spark, sf_dir).select(*FEATS, "y", "split", F.unhex(md5_hex("rkey")).alias("_hash"))
    frame = materialize(frame, "learn-frame")
    folds = materialize(S.kfold_of_hash(frame, "_hash", ["split", "y"], 5), "folds")
    drop_table(frame)
    return folds


@register("stack")
def q_stack(spark, sf_dir):
    """5-fold out-of-fold probabilities of two base learners (NB, LR) -> stacking LR."""
    rows = folded_rows(spark, sf_dir)
    tr, va = rows.where("split = 'train'"), rows.where("split = 'val'")
    nb_held_out = MD.gaussian_nb_held_out(MD.gaussian_nb_fit_leaving_out(tr, FEATS, "y", "fold"), FEATS, "fold", 1.0)
    nb = MD.gaussian_nb_probability(MD.gaussian_nb_fit(tr, FEATS, "y"), FEATS, 1.0)
    *held_out, lr = MD.fit_logistic_leaving_out(tr, FEATS, "y", "fold", 5)
    lr_held_out = F.lit(None).cast("double")
    for k, model in enumerate(held_out):
        lr_held_out = F.when(F.col("fold") == k, model.probability(FEATS)).otherwise(lr_held_out)
    oof = materialize(tr.select("y", nb_held_out.alias("s_nb"), lr_held_out.alias("s_lr")), "out-of-fold")
    (meta,) = MD.fit_logistic_leaving_out(oof, ["s_nb", "s_lr"], "y")
    drop_table(oof)
    scored = va.select("y", nb.alias("s_nb"), lr.probability(FEATS).alias("s_lr"))
    stacked = scored.select("y", meta.probability(["s_nb", "s_lr"]).alias("p1")).withColumn("prediction", (F.col("p1") > 0.5).cast("double"))
    return _binary_report(stacked, "stacking_nb_lr")


@register("model_store")
def q_model_store(spark, sf_dir):
    """Save a fitted pipeline under a folder of this run, models/<target>/<name>, write a
    manifest row, load it back, score the validation rows with the loaded copy and count
    the rows on which it differs from the saved model."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import LogisticRegression
    tr, va = learn_split(spark, sf_dir, keyed=False)
    model = MD.pipeline_fit([LogisticRegression(featuresCol="features", labelCol="y", maxIter=100)], tr)
    root = IO.scratch(spark, "models")
    path = os.path.join(root, "binary", "logistic_regression")
    model.write().save(path)
    manifest = spark.range(1).select(F.lit("logistic_regression").alias("model_name"), F.lit("binary").alias("target"),
                                     F.lit(path).alias("path"), F.lit(len(FEATS)).alias("n_features"),
                                     F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("created_at"))
    manifest.write.mode("append").parquet(os.path.join(root, "manifest"))
    own = _p1(model.transform(va)).select("*", F.col("p1").alias("own_p1")).drop("p1", "rawPrediction", "probability", "prediction")
    both = _p1(PipelineModel.load(path).transform(own))
    differ = both.agg(F.count_if(~F.col("p1").eqNullSafe(F.col("own_p1")))).scalar()
    return _binary_report(both, "logistic_regression_loaded").withColumn("mismatches", differ)


@register("coef_importance")
def q_coef_importance(spark, sf_dir):
    """Mean |coefficient| across classes of a multinomial logistic regression."""
    tr, _ = learn_split(spark, sf_dir, keyed=False)
    lr = MD.fit_logistic(tr, "y_multi")
    mat = lr.coefficientMatrix.toArray()  # classes x features: bounded by the schema
    rows = [(f, float(abs(mat[:, j]).mean())) for j, f in enumerate(FEATS)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc())


def _learn_sql():
    key = "concat_ws('|', l_orderkey, l_partkey, dst_host, l_linenumber, CAST(count_ AS BIGINT))"
    return f"""lf AS (SELECT {key} AS rkey, ln(1 + duration) AS f_duration, ln(1 + src_bytes) AS f_src, ln(1 + dst_bytes) AS f_dst, count_, hot,
  serror_rate, rerror_rate, CAST(logged_in AS DOUBLE) AS logged_in, CAST({Q.binary_label()} AS DOUBLE) AS y,
  {Q.md5_uniform('l_orderkey', 9)} < {config.TRAIN_RATIO} AS train FROM conn)"""


def _oof_sql():
    stats = ", ".join(f"avg({f}) AS m_{f}, var_pop({f}) AS v_{f}" for f in FEATS)
    eps = ", ".join(f"var_pop({f})" for f in FEATS)
    jll = " - ".join(["ln(prior)", *[f"0.5 * ln(2 * pi() * (v_{f} + eps)) - (folded.{f} - m_{f}) ^ 2 / (2 * (v_{f} + eps))" for f in FEATS]])
    return with_ctes(CONN_CTE, _learn_sql(), f"""
folded AS (SELECT *, CAST((row_number() OVER (PARTITION BY y ORDER BY {Q.md5_hex('rkey')}) - 1) % 5 AS INTEGER) AS fold FROM lf WHERE train),
k AS (SELECT DISTINCT fold AS k FROM folded),
eps AS (SELECT k, count(*) AS n, 1e-9 * greatest({eps}) AS eps FROM k JOIN folded ON fold <> k GROUP BY k),
st AS (SELECT k, y AS cls, count(*) AS nc, {stats} FROM k JOIN folded ON fold <> k GROUP BY k, y),
model AS (SELECT st.*, nc * 1.0 / n AS prior, eps FROM st JOIN eps USING (k)),
j AS (SELECT rkey, folded.y, fold, cls, {jll} AS jll FROM folded JOIN model ON k = fold)""") + f"""
SELECT a.rkey, a.y, a.fold, {Q.r6('1.0 / sum(exp(b.jll - a.jll))')} AS oof_p1
FROM j a JOIN j b USING (rkey) WHERE a.cls = 1 GROUP BY a.rkey, a.y, a.fold, a.jll"""


@register("kfold_oof", _oof_sql())
def q_kfold_oof(spark, sf_dir):
    """Out-of-fold naive-Bayes probabilities over 5 stratified folds: one pass for all five fits, one for the scores."""
    tr, _ = learn_split(spark, sf_dir)
    folded = materialize(S.kfold_assign(tr, F.col("rkey"), "y", 5), "folds")
    models = MD.gaussian_nb_fit_leaving_out(folded, FEATS, "y", "fold")
    return folded.select("rkey", "y", "fold", r6(MD.gaussian_nb_held_out(models, FEATS, "fold", 1.0)).alias("oof_p1"))


def request_records(spark, sf_dir):
    """Validation rows as JSON request lines with the 41 fields (those the tables do not
    carry are 0); every 50th or so lacks two required fields, another is cut short."""
    c = conn_view(spark, sf_dir)
    key = F.concat_ws("|", "l_orderkey", "l_partkey", "dst_host", "l_linenumber", F.col("count_").cast("long"))
    have = {"count": "count_"}
    fields = []
    for f in schemas.REQUEST.fields:
        name = have.get(f.name, f.name)
        fields.append((F.col(name) if name in c.columns else F.lit(0)).cast(f.dataType).alias(f.name))
    rows = c.withColumn("rkey", key).where(md5_uniform("l_orderkey", 9) >= config.TRAIN_RATIO)
    rows = rows.select("rkey", md5_uniform("rkey", 77).alias("u"), F.struct(*fields).alias("r"))
    whole = F.to_json(F.struct("rkey", "r.*"))
    short = F.to_json(F.struct("rkey", F.col("r").dropFields("duration", "src_bytes").alias("q")))
    short = F.regexp_replace(F.regexp_replace(short, '"q":[{]', ""), "[}][}]$", "}")
    return rows.select(F.when(F.col("u") < 0.02, short).when(F.col("u") < 0.03, F.substr(whole, F.lit(1), F.length(whole) - 1)).otherwise(whole).alias("value"))


@register("score_records")
def q_score_records(spark, sf_dir):
    """Batch scoring of JSON request records: the 41-field contract splits out incomplete
    and malformed lines; the others go through one saved and reloaded pipeline of
    preprocessor and model.  Rejected lines come back with a null score."""
    from pyspark.ml import PipelineModel
    root = IO.scratch(spark, "scoring")
    train = scoring_rows(spark, sf_dir)
    scoring_pipeline(train).write().save(os.path.join(root, "model"))
    drop_table(train)
    # a line is some 900 characters, most of them field names: gzip stores a twentieth; its files are read whole, so they are short
    request_records(spark, sf_dir).write.option("compression", "gzip").option("maxRecordsPerFile", 100_000).text(os.path.join(root, "requests"))
    recs = IO.read_json_records(spark, os.path.join(root, "requests"), REQUESTS, schemas.REQUEST.names)
    return scored_requests(recs, PipelineModel.load(os.path.join(root, "model")))


REQUESTS = T.StructType([T.StructField("rkey", T.StringType()), *schemas.REQUEST.fields])


def scoring_rows(spark, sf_dir):
    """What the scoring pipelines use of the training records, written once."""
    train = conn_view(spark, sf_dir).withColumnRenamed("count_", "count").withColumn("y", L.binary_label().cast("double"))
    used = dict.fromkeys([*FQ.CAT, *FQ.LOG, "count", "hot", "serror_rate", *FQ.RATE, *FQ.BIN, "y"])
    train = train.where(md5_uniform("l_orderkey", 9) < config.TRAIN_RATIO).select("l_orderkey", *used)
    return materialize(train, "score-train", spread="l_orderkey", keep_spread=False)


def scoring_pipeline(train, max_iter=100, fitted=None):
    """Preprocessor and logistic regression, fitted to the training records, as one PipelineModel; the preprocessor is
    that of the pipeline ``fitted`` if given (to the same records)."""
    from pyspark.ml.classification import LogisticRegression

    from connlens import ml
    from connlens.plans.feature_queries import BIN, CAT, LOG, RATE, THRESH
    stages = fitted.stages[:5] if fitted else ml.record_stages(CAT, LOG, ["count", "hot", "serror_rate"], RATE, BIN, THRESH)
    return ml.fit_pipeline(train, stages, LogisticRegression(featuresCol="features", labelCol="y", maxIter=max_iter))


def scored_requests(recs, model):
    """rkey, valid, is_attack and confidence of checked request records; those of invalid ones are null."""
    scored = model.transform(recs.where("valid"))
    good = scored.select("rkey", F.lit(True).alias("valid"), F.col("prediction").cast("int").alias("is_attack"),
                         r6(vector_to_array("probability")[1]).alias("confidence"))
    bad = recs.where("NOT valid").select("rkey", "valid", F.lit(None).cast("int").alias("is_attack"), F.lit(None).cast("double").alias("confidence"))
    return good.unionByName(bad)


@register("stream_score_records")
def q_stream_score_records(spark, sf_dir):
    """Request lines as a stream: the first half scored by one published model, the second by its successor, which is
    picked up between micro-batches.  Rejected lines come from their own sink with a null score."""
    from connlens.streaming import jobs as SJ
    root, models = IO.scratch(spark, "stream_scoring"), IO.scratch(spark, "models")
    lines = materialize(request_records(spark, sf_dir), "request-lines", spread="value")
    train, model = scoring_rows(spark, sf_dir), None
    online = SJ.score_online(models, lambda b: IO.json_records(b, REQUESTS, schemas.REQUEST.names), lambda rows, model: scored_requests(rows, model))
    for version, max_iter, half in (("v1", 5, 0), ("v2", 100, 1)):
        model = scoring_pipeline(train, max_iter, fitted=model)
        SJ.publish_model(model, models, version)
        lines.where(F.pmod(F.xxhash64("value"), F.lit(2)) == half).write.mode("append").text(os.path.join(root, "requests"))
        stream = spark.readStream.schema("value string").text(os.path.join(root, "requests"))
        SJ.run_to_table(stream, "score_records", per_batch=online, root=root)
    good = SJ.read_if_exists(spark, os.path.join(root, "out")).drop("batch")
    bad = SJ.read_if_exists(spark, os.path.join(root, "rejects"))
    return good.unionByName(bad.select("rkey", "valid", F.lit(None).cast("int").alias("is_attack"), F.lit(None).cast("double").alias("confidence"), "model_version"))


@register("build_features", with_ctes(CONN_CTE, FQ.split_cte(), FQ.names_ctes("tr", "train", "names")) + f"""
SELECT count(*) AS n_rows, count(*) FILTER (WHERE split = 'train') AS train_rows, count(*) FILTER (WHERE split = 'val') AS val_rows,
       count(*) FILTER (WHERE tl = 0) AS benign, count(*) FILTER (WHERE tl = 1) AS anomaly, {len(CONN_COLS)} AS features_before,
       (SELECT CAST(count(*) AS INTEGER) FROM names) AS features_after,
       (SELECT CAST(COALESCE(sum(c - 1), 0) AS BIGINT) FROM (SELECT count(*) AS c FROM conn GROUP BY {", ".join(c for c in CONN_COLS if c != "class")})) AS duplicate_count,
       'COMPATIBLE' AS compat_status FROM sp""")
def q_build_features(spark, sf_dir):
    """End to end: read -> validate -> label -> split -> fit on train -> transform ->
    write the splits (partitioned) -> JSON manifest -> feature-order audit."""
    from connlens.operators import features as FE
    from connlens.operators import quality as QL
    from connlens.plans.feature_queries import BIN, CAT, LOG, RATE, ROB, THRESH, conn_split
    audit = QL.validate(conn_view(spark, sf_dir), CONN_COLS, "class", CAT)
    df = conn_split(spark, sf_dir)
    pre = FE.Preprocessor(CAT, LOG, ROB, RATE, BIN, threshold=THRESH).fit(df.where("split = 'train'"))
    out = pre.transform(df, keep=["split", "target_label", "multiclass_label"])
    root = IO.scratch(spark, "processed")
    IO.write_partitioned(out, os.path.join(root, "data"), "split")
    written = spark.read.parquet(os.path.join(root, "data"))
    names = pre.feature_names()
    manifest = written.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("split") == "train").alias("train_rows"), F.count_if(F.col("split") == "val").alias("val_rows"),
        F.count_if(F.col("target_label") == 0).alias("benign"), F.count_if(F.col("target_label") == 1).alias("anomaly"),
    ).select("*", F.lit(len(CONN_COLS)).alias("features_before"), F.lit(len(names)).alias("features_after"),
             F.lit(audit["duplicate_count"]).alias("duplicate_count"),
             F.lit("COMPATIBLE" if [c for c in written.columns if c not in ("split", "target_label", "multiclass_label")]
                   == names else "INCOMPATIBLE").alias("compat_status"))
    IO.write_json_manifest(manifest, os.path.join(root, "manifest"))
    return manifest


@register("report_compat_audit", with_ctes(CONN_CTE, FQ.split_cte(), FQ.names_ctes("tr", "train", "e"), FQ.names_ctes("va", "val", "a")) + ", " + DIFF_SQL)
def q_report_compat_audit(spark, sf_dir):
    """Feature-order audit: the manifest of a preprocessor fitted on the train split
    (expected) against one fitted on the validation split (actual)."""
    from connlens.operators import features as FE
    from connlens.operators import joins as JN
    from connlens.plans.feature_queries import BIN, CAT, LOG, RATE, ROB, THRESH, conn_split
    df = conn_split(spark, sf_dir)
    exp = FE.Preprocessor(CAT, LOG, ROB, RATE, BIN, threshold=THRESH).fit(df.where("split = 'train'")).feature_names()
    act = FE.Preprocessor(CAT, LOG, ROB, RATE, BIN, threshold=THRESH).fit(df.where("split = 'val'")).feature_names()
    return JN.manifest_diff(JN.names_table(spark, exp), JN.names_table(spark, act))
