"""Scoring a stream with a model that is replaced between micro-batches."""

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F
from pyspark.sql import types as T

from connlens import ml
from connlens.sources import io
from connlens.streaming import jobs

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("svc", T.StringType()), T.StructField("bytes", T.DoubleType())])


def fitted(spark, flip):
    rows = [("a" if k % 3 else "b", float(k % 50), float(((k % 50) > 25) != flip)) for k in range(200)]
    train = spark.createDataFrame(rows, "svc string, bytes double, y double")
    stages = [ml.RareCategories(inputCols=["svc"], outputCols=["s"], threshold=0.1), ml.OneHotColumns(inputCols=["s"], prefix="cat"), ml.Log1pColumns(inputCols=["bytes"], outputCols=["l"]),
              ml.RobustScaling(inputCols=["l"]), ml.ColumnCopies(inputCols=["bytes"], outputCols=["raw"])]
    return ml.fit_pipeline(train, stages, LogisticRegression(featuresCol="features", labelCol="y", maxIter=20))


def parse(lines):
    return io.json_records(lines, SCHEMA, ["id", "svc", "bytes"])


def score(rows, model):
    return model.transform(rows).select("id", F.col("prediction").cast("int").alias("label"))


def test_two_versions_over_three_batches_equal_the_batch_result(spark, tmp_path):
    models, source, root = str(tmp_path / "models"), str(tmp_path / "in"), str(tmp_path / "run")
    own = {"v1": fitted(spark, False), "v2": fitted(spark, True)}
    want = {}
    online = jobs.score_online(models, parse, score)
    for batch, version in enumerate(("v1", "v1", "v2")):
        if batch != 1:
            jobs.publish_model(own[version], models, version)
        lines = [f'{{"id": {100 * batch + k}, "svc": "{"abz"[k % 3]}", "bytes": {k}}}' for k in range(50)]
        lines += [f'{{"id": {100 * batch + 60}, "svc": "a"}}', '{"id": 1, "svc', ""]
        df = spark.createDataFrame([(x,) for x in lines], "value string")
        df.coalesce(1).write.mode("append").text(source)
        want |= {r["id"]: (r.label, version) for r in score(parse(df).where("valid"), own[version]).collect()}
        jobs.run_to_table(spark.readStream.schema("value string").text(source), "scores", per_batch=online, root=root)
    out = jobs.read_if_exists(spark, f"{root}/out").collect()
    assert {r["id"]: (r.label, r.model_version) for r in out} == want and len(out) == 150
    assert {v for _, v in want.values()} == {"v1", "v2"} and len({label for label, _ in want.values()}) == 2
    rejects = jobs.read_if_exists(spark, f"{root}/rejects").collect()
    assert sorted(r.model_version for r in rejects) == ["v1"] * 4 + ["v2"] * 2 and sum(r._corrupt is not None for r in rejects) == 3
    assert jobs.current_version(spark, models) == "v2" and PipelineModel.load(f"{models}/versions/v1") is not None
    # a batch that runs again keeps its version, whatever is current by then
    online(spark.read.text(source).limit(1), 0, root)
    assert {r.model_version for r in jobs.read_if_exists(spark, f"{root}/version").where("batch = 0").withColumnRenamed("version", "model_version").collect()} == {"v1"}
    assert {r.model_version for r in jobs.read_if_exists(spark, f"{root}/out").where("batch = 0").collect()} <= {"v1"}
