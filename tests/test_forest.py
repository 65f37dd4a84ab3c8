"""Forests on blocks of binned rows, against MLlib's trees and forests."""

import math

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from connlens.operators import forest as FO
from connlens.operators import metrics as M
from connlens.operators import models as MD
from connlens.plans import learner_queries as LQ


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(1)
    n = 3000
    x = np.c_[rng.integers(0, 20, n), rng.integers(0, 30, n), rng.integers(0, 4, n), np.ones(n)].astype(float)
    level = x[:, 0] * (x[:, 2] > 1) + 0.5 * x[:, 1] + 3 * rng.normal(size=n)
    data = [(*map(float, a), float(v > 14), float(int(v > 10) + int(v > 18)), float(w)) for a, v, w in zip(x, level, rng.integers(1, 5, n))]
    return MD.assemble(spark.createDataFrame(data, "a double, b double, c double, d double, y double, k double, w double").repartition(3), ["a", "b", "c", "d"]).cache()


def probabilities(d):
    return np.array([r[0] + [r[1]] for r in d.select(vector_to_array("probability"), "prediction").collect()])


@pytest.mark.parametrize("label, weight, depth", [("y", None, 6), ("k", None, 4), ("k", "w", 6)])
def test_a_tree_of_all_rows_and_features_is_that_of_mllib(rows, monkeypatch, label, weight, depth):
    monkeypatch.setattr(FO, "TABLES_MB", 0)  # a pass a tree
    own = FO.fit_forest(rows, label, 2, depth, weight, slots=4, bootstrap=False).transform(rows)
    whole = DecisionTreeClassifier(featuresCol="features", labelCol=label, maxDepth=depth)
    whole = (whole.setWeightCol(weight) if weight else whole).fit(rows).transform(rows)
    a, b = probabilities(own), probabilities(whole)
    assert a.shape == b.shape and np.isclose(a, b, atol=1e-9).all(axis=1).mean() > 0.99  # equal gains may be told apart by rounding


def test_rows_are_drawn_as_often_as_by_poisson():
    share = -np.diff([65536, *[65536 - b for b in FO.DRAWN], 0]) / 65536
    assert np.allclose(share[:6], [math.exp(-1) / math.factorial(i) for i in range(6)], atol=2e-5) and np.isclose(share @ np.arange(len(share)), 1, atol=1e-4)


@pytest.mark.parametrize("label", ["y", "k"])
def test_large_inputs_are_read_once_a_level(rows, monkeypatch, label):
    monkeypatch.setattr(MD, "FOREST_MLLIB_ROWS", 1000)
    passes = []
    monkeypatch.setattr(FO, "_grow_level", lambda blocks, trees, *a, run=FO._grow_level: passes.append((len(trees), blocks.count())) or run(blocks, trees, *a))
    train, held = rows.where("a % 5 > 0"), rows.where("a % 5 = 0")
    own = MD.fit_random_forest(train, label, 40, 5)
    assert [n for n, _ in passes] == [40] * 5 and max(b for _, b in passes) <= 6  # blocks instead of 2,400 rows
    whole = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=40, maxDepth=5, seed=42, featureSubsetStrategy="sqrt").fit(train)
    a, b = own.transform(held), whole.transform(held)
    assert set(a.columns) == set(b.columns)
    hit = [d.agg(F.avg((F.col("prediction") == F.col(label)).cast("double"))).first()[0] for d in (a, b)]
    assert abs(hit[0] - hit[1]) < 0.04
    if label == "y":
        auc = [M.roc_auc(d.withColumn("p1", vector_to_array("probability")[1]), "y", "p1").first()[0] for d in (a, b)]
        assert abs(auc[0] - auc[1]) < 0.02
    again = MD.fit_random_forest(train, label, 40, 5).transform(held)
    assert np.array_equal(probabilities(again), probabilities(a))


def test_weights_count_as_copies(rows, monkeypatch):
    copies = rows.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("w").cast("int"))))
    a, b = (FO.fit_forest(d, "k", 1, 4, w, slots=4, bootstrap=False).transform(rows) for d, w in ((rows, "w"), (copies, None)))
    assert np.isclose(probabilities(a), probabilities(b), atol=1e-9).all(axis=1).mean() > 0.99


def test_voting_uses_the_forest_on_blocks(spark, monkeypatch):
    fits = []
    monkeypatch.setattr(MD, "FOREST_MLLIB_ROWS", 1000)
    monkeypatch.setattr(FO, "fit_forest", lambda *a, run=FO.fit_forest: fits.append(a[2:4]) or run(*a))
    (r,) = LQ.q_vote_soft_mllib(spark, "/root/testdata/sf0.001").collect()
    assert fits == [(100, 10)] and 0 <= r.roc_auc <= 1 and 0.5 < r.accuracy <= 1
