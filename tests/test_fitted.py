"""The learners behind the model records."""

import numpy as np
from pyspark.sql import functions as F

from connlens.operators import models as MD
from connlens.plans import fitted as FIT
from connlens.plans import report_queries

SF = "/root/testdata/sf0.01"


def test_scores_equal_plain_fits(spark):
    rows = FIT.learner_rows(spark, SF).cache()
    train, rest = rows.where("split = 'train'"), rows.where("split <> 'train'")
    got = FIT.scored(rows, FIT.fit(rows)).cache()
    assert got.count() == rest.count() * len(FIT.MODELS)
    own = {r["row_id"]: r for r in got.where("model_name = 'naive_bayes'").collect()}
    for label, column in (("y", "pb"), ("y_multi", "pm")):
        plain = MD.gaussian_nb_predict(rest, MD.gaussian_nb_fit(train, FIT.FEATS, label), FIT.FEATS, keep=["row_id"]).collect()
        assert all(own[r["row_id"]][column] == r["pred"] for r in plain)
        if label == "y":
            assert np.allclose([own[r["row_id"]]["sm"] for r in plain], [r["probability"][1] for r in plain], rtol=1e-9)
    shares = {r["b0"]: (r["p"] + 1) / (r["n"] + 2) for r in train.groupBy("b0").agg(F.sum("y").alias("p"), F.count("*").alias("n")).collect()}
    tree = got.where("model_name = 'decision_tree'").join(rest.select("row_id", "b0"), "row_id").collect()
    assert np.allclose([r["sm"] for r in tree], [shares.get(r["b0"], 0.5) for r in tree])


def test_learners_learn_and_differ(spark):
    rows = FIT.learner_rows(spark, SF).cache()
    got = FIT.scored(rows, FIT.fit(rows))
    per = {r["model_name"]: r["a"] for r in got.groupBy("model_name").agg(F.avg((F.col("pb") == F.col("y")).cast("double")).alias("a")).collect()}
    assert set(per) == set(FIT.MODELS) and len({round(v, 4) for v in per.values()}) > 2 and max(per.values()) > 0.55


def test_one_class_and_no_training_rows(spark):
    rows = FIT.learner_rows(spark, SF).limit(500).cache()
    one = FIT.scored(rows.where("y = 1"), FIT.fit(rows.where("y = 1")))
    assert {(r["pb"], r["sm"] > 0.99) for r in one.collect()} == {(1, True)}
    none = rows.where("split = 'val'")
    assert FIT.fit(none) == {} and FIT.scored(none, {}).collect() == []


def test_best_by_fits_the_learners_once(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(report_queries.FIT, "fit", lambda rows, fit=report_queries.FIT.fit: calls.append(1) or fit(rows))
    best = report_queries.q_best_by(spark, "/root/testdata/sf0.001").collect()
    assert len(best) == 3 and len(calls) == 1
    written = report_queries.records(spark, "/root/testdata/sf0.001")
    assert all("model-records" in f for f in written.inputFiles())
