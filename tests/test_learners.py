"""Queries whose result SQL cannot give: invariants, closed forms and exact round trips."""

import os
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from connlens import config
from connlens.operators import features as FE
from connlens.operators import joins as J
from connlens.operators import metrics as M
from connlens.operators import models as MD
from connlens.plans import learner_queries as LQ
from connlens.sources import schemas

SF = "/root/testdata/sf0.001"


def run(spark, name):
    return E.queries()[name](spark, SF).collect()


NAMES = [f"x{i}" for i in range(4)]


@pytest.fixture(scope="module")
def separable(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 4))
    y = (x[:, 0] + x[:, 1] + 0.2 * rng.normal(size=600) > 1.2).astype(float)  # the positive class is the rare one
    return MD.assemble(spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], [*NAMES, "y"]), NAMES).cache()


def scored(name, df, weight=None):
    if name == "adaboost":
        return MD.adaboost_predict(MD.fit_adaboost(df, NAMES, "y", 20, 2), df, keep=["y"]).withColumnRenamed("score", "p1").withColumnRenamed("pred", "prediction")
    if name == "svm":
        return LQ._p1(MD.svm_probability(*MD.fit_linear_svm(df, "y"), df))
    fit = {"logistic": lambda: MD.fit_logistic(df, "y", weight=weight), "tree": lambda: MD.fit_tree(df, "y", 3, weight=weight),
           "forest": lambda: MD.fit_random_forest(df, "y", 10, 4, weight=weight), "gbt": lambda: MD.fit_gbt(df, "y", 10, 3, 0.3, 0.8)}
    return LQ._p1(fit[name]().transform(df))


@pytest.mark.parametrize("name", ["logistic", "tree", "forest", "gbt", "svm", "adaboost"])
def test_learners_separate_separable_data(separable, name):
    assert M.roc_auc(scored(name, separable), "y", "p1").first()[0] > 0.9


@pytest.mark.parametrize("name", ["logistic", "tree", "forest"])
def test_balanced_weights_raise_minority_recall(separable, name):
    def recall(df):
        hit = df.where("y = 1").agg(F.avg((F.col("prediction") == 1).cast("int"))).first()[0]
        return hit
    weighted = J.join_class_weight(separable, "y")
    assert recall(scored(name, weighted, "weight")) >= recall(scored(name, separable))


@pytest.mark.parametrize("name", ["vote_soft_mllib", "stack"])
def test_ensembles_report_one_row(spark, name):
    (r,) = run(spark, name)
    assert 0 <= r.roc_auc <= 1 and 0.5 < r.accuracy <= 1


def test_loaded_model_predicts_as_the_saved_one(spark):
    (r,) = run(spark, "model_store")
    assert r.mismatches == 0 and r.model_name == "logistic_regression_loaded"


def test_out_of_fold_naive_bayes_matches_closed_form(spark):
    got = run(spark, "kfold_oof")
    tr, _ = LQ.learn_split(spark, SF)
    rows = {r.rkey: ([float(r[f]) for f in LQ.FEATS], r.y) for r in tr.select("rkey", "y", *LQ.FEATS).collect()}
    assert {r.rkey for r in got} == set(rows)
    sizes = np.bincount([r.fold for r in got])
    assert len(sizes) == 5 and sizes.max() - sizes.min() <= 2
    x, y = np.array([rows[r.rkey][0] for r in got]), np.array([rows[r.rkey][1] for r in got])
    fold, p1 = np.array([r.fold for r in got]), np.array([r.oof_p1 for r in got])
    for k in range(5):
        a, b = x[fold != k], y[fold != k]
        eps = 1e-9 * a.var(0).max()
        jll = np.stack([np.log((b == c).mean()) - 0.5 * (np.log(2 * np.pi * (a[b == c].var(0) + eps)) + (x[fold == k] - a[b == c].mean(0)) ** 2 / (a[b == c].var(0) + eps)).sum(1)
                        for c in (0, 1)])
        want = 1 / (1 + np.exp(np.clip(jll[0] - jll[1], -700, 700)))
        assert np.allclose(want, p1[fold == k], atol=2e-6)


def test_requests_are_scored_or_rejected(spark):
    got = run(spark, "score_records")
    lines = LQ.request_records(spark, SF).collect()
    bad = sum('"duration":' not in r.value or not r.value.endswith("}") for r in lines)
    assert len(got) == len(lines) and sum(not r.valid for r in got) == bad > 0
    for r in got:
        assert (r.is_attack in (0, 1) and 0 <= r.confidence <= 1) if r.valid else (r.is_attack is None and r.confidence is None)


def test_schemas():
    kinds = [f.dataType.simpleString() for f in schemas.REQUEST.fields]
    assert (len(schemas.RECORD), len(kinds), kinds.count("bigint"), kinds.count("double"), kinds.count("string")) == (43, 41, 23, 15, 3)
    assert schemas.RECORD.names == config.RAW_COLUMNS


def test_saved_preprocessor_gives_identical_output(spark, tmp_path):
    df = spark.createDataFrame([(f"s{i % 3}" if i % 10 else "rare", float(i), float(i % 7), i % 2) for i in range(100)], "svc string, bytes double, hot double, flag int")
    pre = FE.Preprocessor(["svc"], ["bytes"], ["hot"], ["hot"], ["flag"], threshold=0.15).fit(df)
    pre.save(spark, str(tmp_path / "p"))
    back = FE.Preprocessor.load(spark, str(tmp_path / "p"))
    assert back.feature_names() == pre.feature_names()
    assert back.transform(df).collect() == pre.transform(df).collect()
    with pytest.raises(Exception, match="negative values"):
        back.transform(df.withColumn("bytes", F.lit(-1.0))).collect()


def test_naive_bayes_uses_every_dimension(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 64))
    y = rng.integers(0, 2, 200)
    x[:, 63] += 8 * y  # only the last dimension tells the classes apart
    df = spark.createDataFrame([(int(b), *map(float, a)) for a, b in zip(x, y)], ["y", *[f"e{i}" for i in range(64)]])
    feats = [f"e{i}" for i in range(64)]
    p = MD.gaussian_nb_predict(df, MD.gaussian_nb_fit(df, feats, "y"), feats, keep=["y"])
    assert p.where("pred = y").count() >= 195


def test_isolation_forest_query_and_hybrid_cover_the_test_rows(spark):
    forest, hybrid = run(spark, "isolation_forest"), run(spark, "hybrid_fit_score")
    assert {r.vec_id for r in forest} == {r.vec_id for r in hybrid}
    assert all(-1 < r.score < 0 and r.is_anomaly == (r.decision < 0) for r in forest)
    assert {r.pred for r in hybrid} <= set(range(5))


def test_leaving_a_fold_out_equals_a_fit_without_it(spark):
    rng = np.random.default_rng(9)
    rows = [(int(k), float(y), *(rng.normal(5 * y, 1 + y, 2) * [1, 1e4]).tolist()) for k, y in zip(rng.integers(0, 4, 400), rng.integers(0, 3, 400))]
    rows += [(7, 9.0, 1.0, 2.0), (7, 9.0, 1.5, 2.5)]  # a class that only one fold has
    df = spark.createDataFrame(rows, "fold int, y double, a double, b double")
    models = MD.gaussian_nb_fit_leaving_out(df, ["a", "b"], "y", "fold")
    assert sorted(models) == [0, 1, 2, 3, 7]
    for k, model in models.items():
        plain = MD.gaussian_nb_fit(df.where(F.col("fold") != k), ["a", "b"], "y")
        assert model["classes"] == plain["classes"] and (9.0 in model["classes"]) == (k != 7)
        for part in ("prior", "mean", "var"):
            assert np.allclose(model[part], plain[part], rtol=1e-9)
    held = df.select("fold", "y", "a", "b", MD.gaussian_nb_held_out(models, ["a", "b"], "fold", 1.0).alias("p"))
    for k in models:
        plain = MD.gaussian_nb_fit(df.where(F.col("fold") != k), ["a", "b"], "y")
        want = MD.gaussian_nb_predict(df.where(F.col("fold") == k), plain, ["a", "b"], keep=["a"]).select("a", F.element_at("probability", 2).alias("p"))
        assert np.allclose(sorted(tuple(r) for r in want.collect()), sorted((r.a, r.p) for r in held.where(F.col("fold") == k).collect()), rtol=1e-9)
    assert MD.gaussian_nb_fit_leaving_out(df.where("y > 100"), ["a", "b"], "y", "fold") == {}


@pytest.mark.parametrize("kind", ["forest", "svm", "adaboost"])
def test_family_learners_learn_five_classes(spark, kind):
    rng = np.random.default_rng(4)
    y = rng.integers(0, 5, 1500)
    x = np.c_[y // 2 * 3 + rng.normal(size=1500), y % 2 * 4 + rng.normal(size=1500), rng.normal(size=1500)]
    df = MD.assemble(spark.createDataFrame([(float(a), *map(float, b)) for a, b in zip(y, x)], "y double, a double, b double, c double"), ["a", "b", "c"])
    train, held = df.limit(1000).cache(), df.offset(1000).cache()
    if kind == "forest":
        out = MD.fit_random_forest(train, "y", 30, 6).transform(held)
    elif kind == "svm":
        out = MD.fit_linear_svm_ovr(train, "y", 50).transform(held)
    else:
        out = MD.adaboost_predict(MD.fit_adaboost(train, ["a", "b", "c"], "y", 60, 5), held, keep=["y"]).withColumn("prediction", F.col("pred").cast("double"))
    share = out.agg(F.avg((F.col("prediction") == F.col("y")).cast("double"))).first()[0]
    assert share > (0.45 if kind == "svm" else 0.7) and out.select("prediction").distinct().count() >= 4


def test_training_rows_are_dealt_evenly_over_the_tasks(spark):
    for rows in LQ.learn_split(spark, SF):  # the lineitem file has one row group
        sizes = [r["n"] for r in rows.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
        assert len(sizes) >= spark.sparkContext.defaultParallelism and max(sizes) <= 2 * sum(sizes) / len(sizes)


def test_adaboost_weights_come_from_the_votes(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(900, 3))
    x[::50, 0], x[1::60, 1] = np.nan, np.nan
    y = rng.integers(0, 3, 900) * (np.nan_to_num(x[:, 0]) > -0.5)
    df = spark.createDataFrame([(float(b), *(None if np.isnan(v) and i % 2 else float(v) for v in a)) for i, (a, b) in enumerate(zip(x, y))], "y double, a double, b double, c double").repartition(5)
    names = ["a", "b", "c"]
    model = MD.fit_adaboost(df, names, "y", 25, 3)
    bins = np.stack([np.where(np.isnan(v), len(s) - 1, np.searchsorted(s[1:-1], v, side="right")) for v, s in zip(x.T, model["splits"].values())])
    log_weight = np.zeros(900)  # SAMME as written: a row's log-weight grows by alpha where the stump is wrong
    for st in model["stumps"]:
        weight = np.exp(log_weight - log_weight.max())
        errors = {}
        for f in range(3):
            cells = np.array([[weight[(bins[f] == b) & (y == k)].sum() for k in range(3)] for b in range(bins[f].max() + 1)])
            errors.update({(f, cut): weight.sum() - cells[:cut].sum(0).max() - cells[cut:].sum(0).max() for cut in range(1, len(cells))})
        own = errors[names.index(st["feature"]), st["cut"]]
        assert np.isclose(own, min(errors.values())) and np.isclose(st["err"], own / weight.sum())
        log_weight += st["alpha"] * (np.where(bins[names.index(st["feature"])] < st["cut"], st["left"], st["right"]) != y)
    votes = sum(t[bins[names.index(f)]] for f, t in MD.adaboost_votes(model["stumps"], model["splits"], 3).items())
    assert np.allclose(log_weight, sum(st["alpha"] for st in model["stumps"]) - votes[np.arange(900), y])
    got = Counter(r.pred for r in MD.adaboost_predict(model, df).collect())
    assert len(model["stumps"]) == 25 and got == Counter(votes.argmax(1).tolist())


def test_both_published_models_are_fitted_to_one_table(spark, monkeypatch):
    rows, fits = [], []
    monkeypatch.setattr(LQ, "scoring_rows", lambda *a, read=LQ.scoring_rows: rows.append(1) or read(*a))
    monkeypatch.setattr(FE.RobustScaler, "fit", lambda self, *a, fit=FE.RobustScaler.fit: fits.append(1) or fit(self, *a))
    versions = {r.model_version for r in run(spark, "stream_score_records")}
    assert versions == {"v1", "v2"} and len(rows) == 1 and len(fits) == 1


def test_forests_are_grown_in_node_groups_that_fit_a_cache(spark, separable):
    model = MD.fit_random_forest(separable, "y", 10, 4)
    assert model.getMaxMemoryInMB() == MD.FOREST_NODE_MB <= 16 and model.getNumTrees == 10
    whole = MD.RandomForestClassifier(featuresCol="features", labelCol="y", numTrees=10, maxDepth=4, seed=42, featureSubsetStrategy="sqrt").fit(separable)
    assert model.toDebugString.splitlines()[1:] == whole.toDebugString.splitlines()[1:]  # one group either way: the same trees


def test_learners_without_a_key_read_the_same_rows_without_it(spark):
    kept, bare = LQ.learn_split(spark, SF), LQ.learn_split(spark, SF, keyed=False)
    for a, b in zip(kept, bare):
        cols = [*LQ.FEATS, "y", "y_multi"]
        assert "rkey" not in b.columns and Counter(a.select(cols).collect()) == Counter(b.select(cols).collect())
        sizes = [r["n"] for r in b.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
        assert max(sizes) <= 2 * sum(sizes) / len(sizes)


@pytest.mark.parametrize("report, label", [(LQ._multi_report, "y_multi"), (LQ._binary_report, "y")])
def test_reports_score_each_row_once(spark, report, label):
    scored_rows = spark.sparkContext.accumulator(0)

    def score(x):
        scored_rows.add(1)
        return float(x % 2)

    pred = spark.range(0, 200, 1, 4).select((F.col("id") % 2).cast("double").alias(label), F.udf(score, "double")("id").alias("prediction"),
                                            (F.col("id") % 7).cast("double").alias("p1"))
    assert report(pred, "m").first()["accuracy"] == 1.0 and scored_rows.value == 200


def test_scoring_stores_lean_rows_and_compressed_requests(spark, monkeypatch):
    roots, trained = [], []
    monkeypatch.setattr(LQ.IO, "scratch", lambda *a, new=LQ.IO.scratch: roots.append(new(*a)) or roots[-1])
    monkeypatch.setattr(LQ, "scoring_rows", lambda *a, read=LQ.scoring_rows: trained.append(read(*a)) or trained[-1])
    columns = set(LQ.scoring_rows(spark, SF).columns)
    assert not columns & {"l_orderkey", "ts", "src_host", "class"} and {"y", "count", *LQ.FQ.CAT} <= columns
    run(spark, "score_records")
    (root,), files = roots, trained[1].inputFiles()
    assert not any(os.path.exists(f.removeprefix("file://")) for f in files)  # the training table has no more readers
    folder = os.path.join(root.removeprefix("file:"), "requests")
    stored = sum(os.path.getsize(os.path.join(folder, f)) for f in os.listdir(folder))
    assert stored < LQ.request_records(spark, SF).agg(F.sum(F.length("value"))).first()[0] / 5
