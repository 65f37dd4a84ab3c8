"""The pyspark.ml stages: fitted, saved and loaded as one pipeline."""

import math

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from connlens import ml
from connlens.operators import features as FE

SCHEMA = "svc string, flag string, bytes double, hot double, rate double, up int, y double"
ROWS = [(s, f, b, h, r, u, y) for k in range(40) for s, f, b, h, r, u, y in [
    (("http", "http", "ssh", "rare" if k == 7 else "http", None)[k % 5], "SF" if k % 3 else None, float(k * k), float(k % 7), k / 40, k % 2, float(k % 2))]]
GROUPS = (["svc", "flag"], ["bytes"], ["hot", "rate"], ["rate"], ["up"], 0.1)


def stages():
    return ml.record_stages(*GROUPS)


def test_a_saved_and_loaded_pipeline_gives_identical_rows(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    model = ml.fit_pipeline(df, stages(), LogisticRegression(featuresCol="features", labelCol="y", maxIter=20))
    model.write().save(str(tmp_path / "m"))
    back = PipelineModel.load(str(tmp_path / "m"))
    assert [type(s) for s in back.stages] == [type(s) for s in model.stages]
    new = spark.createDataFrame([*ROWS, ("telnet", "SF", 3.0, 900.0, 0.0, 1, 0.0), (None, None, 0.0, 0.0, 0.5, 0, 1.0)], SCHEMA)
    columns = [*ml.feature_names(model.stages), "features", "probability", "prediction"]
    assert model.transform(new).select(*[F.col(f"`{c}`") for c in columns]).collect() == back.transform(new).select(*[F.col(f"`{c}`") for c in columns]).collect()


def test_an_unfitted_pipeline_survives_a_round_trip(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    Pipeline(stages=stages()).write().save(str(tmp_path / "p"))
    a, b = (p.fit(df).transform(df).collect() for p in (Pipeline(stages=stages()), Pipeline.load(str(tmp_path / "p"))))
    assert a == b


def test_stages_equal_the_preprocessor(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    pre = FE.Preprocessor(*GROUPS[:5], threshold=0.1).fit(df)
    model = Pipeline(stages=stages()).fit(df)
    names = ml.feature_names(model.stages)
    assert names == pre.feature_names()
    got = model.transform(df).select(*[F.col(f"`{n}`") for n in names]).collect()
    assert [tuple(0.0 if x is None else x for x in r) for r in got] == [tuple(0.0 if x is None else x for x in r) for r in pre.transform(df).collect()]


def test_literal_cases_nulls_and_negatives(spark):
    df = spark.createDataFrame([("tcp",)] * 9 + [("icmp",), (None,)], "p string")
    model = ml.RareCategories(inputCols=["p"], outputCols=["q"], threshold=0.15).fit(df)
    assert {(r.p, r.q) for r in model.transform(df).collect()} == {("tcp", "tcp"), ("icmp", "other"), (None, "other")}
    counts = spark.createDataFrame([(0.0,), (9.0,), (99.0,), (None,)], "x double")
    logs = ml.Log1pColumns(inputCols=["x"], outputCols=["l"]).transform(counts).orderBy("x").collect()
    assert [r.l for r in logs] == [None, 0.0, pytest.approx(math.log(10)), pytest.approx(math.log(100))]
    with pytest.raises(Exception, match="negative values"):
        ml.Log1pColumns(inputCols=["x"]).transform(spark.createDataFrame([(-1.0,)], "x double")).collect()
    scaled = ml.RobustScaling(inputCols=["x"], outputCols=["s"]).fit(counts).transform(counts).orderBy("x").collect()
    assert [r.s for r in scaled] == [None, *[(x - 9) / 49.5 for x in (0, 9, 99)]]


def test_fitted_on_an_empty_table(spark):
    empty, df = spark.createDataFrame([], SCHEMA), spark.createDataFrame(ROWS, SCHEMA)
    model = Pipeline(stages=stages()).fit(empty)
    assert ml.feature_names(model.stages) == ["log__bytes", "robust__hot", "robust__rate", "rate__rate", "binary__up"]
    assert model.transform(empty).count() == 0
    assert {r.v for r in model.transform(df).select(F.col("__svc").alias("v")).collect()} == {"other"}
