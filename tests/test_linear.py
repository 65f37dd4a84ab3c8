"""Linear models fitted in shared passes, against MLlib's and plain sums."""

import os
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from connlens import session
from connlens.operators import linear as LI
from connlens.operators import models as MD
from connlens.operators import sampling as S
from connlens.plans import learner_queries as LQ

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal([1, 200, 0, 7], [1, 50, 0.01, 0], (1500, 4))
    level = x[:, 0] + (x[:, 1] - 200) / 40 + 60 * x[:, 2] + rng.logistic(size=1500)
    data = [(*map(float, a), float(v > 1.5), float(int(v > 0) + int(v > 2)), int(f)) for a, v, f in zip(x, level, rng.integers(0, 3, 1500))]
    return MD.assemble(spark.createDataFrame(data, "a double, b double, c double, d double, y double, k double, fold int").repartition(3), ["a", "b", "c", "d"]).cache()


def test_logistic_regressions_without_each_fold_are_those_of_mllib(rows, monkeypatch):
    passes = []
    monkeypatch.setattr(LI, "_loss_sums", lambda t, models, *a, run=LI._loss_sums: passes.append(len(models)) or run(t, models, *a))
    names = ["a", "b", "c", "d"]
    found = MD.fit_logistic_leaving_out(rows, names, "y", "fold", 3)
    assert len(found) == 4 and passes[0] == 4 and len(passes) < 60
    for k, own in zip([0, 1, 2, None], found):
        part = rows if k is None else rows.where(F.col("fold") != k)
        whole = MD.fit_logistic(part, "y")
        p = [r for r in whole.transform(rows).select(own.probability(names).alias("a"), LQ.vector_to_array("probability")[1].alias("b")).collect()]
        assert np.allclose([r.a for r in p], [r.b for r in p], atol=5e-3)


def test_folded_rows_are_those_of_the_split(spark):
    kept = S.kfold_assign(LQ.learn_split(spark, SF)[0], F.col("rkey"), "y", 5)
    lean = LQ.folded_rows(spark, SF)
    cols = [*LQ.FEATS, "y", "fold"]
    assert set(lean.columns) == {*cols, "split"}
    assert Counter(lean.where("split = 'train'").select(cols).collect()) == Counter(kept.select(cols).collect())
    assert Counter(lean.where("split = 'val'").select(cols[:-1]).collect()) == Counter(LQ.learn_split(spark, SF)[1].select(cols[:-1]).collect())


def test_stacking_keeps_one_table_of_the_rows(spark):
    folder = session.run_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    (r,) = LQ.q_stack(spark, SF).collect()
    left = {n.rsplit("-", 1)[0] for n in set(os.listdir(folder)) - before}
    assert "folds" in left and not left & {"learn-frame", "out-of-fold"}
    assert 0.5 < r.accuracy <= 1


def test_a_loss_that_is_not_finite_is_an_error(rows):
    with pytest.raises(ValueError, match="not finite"):
        MD.fit_logistic_leaving_out(rows.withColumn("a", F.lit(float("nan"))), ["a", "b"], "y")


def hinge(x, sign, weights, shift):
    return np.maximum(1 - sign * (x @ weights + shift), 0).mean()


def test_support_vector_machines_of_all_classes_share_their_passes(rows, monkeypatch):
    passes = []
    monkeypatch.setattr(LI, "_loss_sums", lambda t, models, *a, run=LI._loss_sums: passes.append((len(models), t.count())) or run(t, models, *a))
    own = MD.fit_linear_svm_ovr(rows, "k")
    assert passes[0][0] == 3 and len(passes) < 300 and max(b for _, b in passes) <= 6  # blocks instead of 1,500 rows
    got = rows.select("features", "k").collect()
    x, y = np.array([r.features.toArray() for r in got]), np.array([r.k for r in got])
    for k, m in enumerate(own.models):
        whole = MD.LinearSVC(featuresCol="features", labelCol="t", maxIter=100).fit(rows.withColumn("t", (F.col("k") == k).cast("double")))
        sign = np.where(y == k, 1, -1)
        assert hinge(x, sign, np.array(m.coefficients), m.intercept) <= 1.01 * hinge(x, sign, whole.coefficients.toArray(), whole.intercept)
    margins = np.stack([x @ m.coefficients + m.intercept for m in own.models], axis=1)
    out = own.transform(rows.select("features", "k")).collect()
    assert Counter((tuple(r.features), r.prediction) for r in out) == Counter((tuple(a), float(i)) for a, i in zip(x, margins.argmax(axis=1)))
