"""The reference test suite's literal cases, re-expressed on Spark DataFrames."""

import math

import pytest
from pyspark.sql import functions as F

from connlens.operators import features as FE
from connlens.operators import labels as L
from connlens.operators import metrics as M
from connlens.operators import quality as QL


def test_rare_category_consolidation(spark):
    df = spark.createDataFrame([("tcp",)] * 9 + [("icmp",)], "protocol_type string")
    enc = FE.FrequencyEncoder(threshold=0.15).fit(df, ["protocol_type"])
    out = [r[0] for r in enc.transform(df).collect()]
    assert out.count("tcp") == 9 and out.count("other") == 1 and "icmp" not in out


def test_unseen_category_maps_to_other(spark):
    fit = spark.createDataFrame([("http",)] * 10, "service string")
    enc = FE.FrequencyEncoder(threshold=0.01).fit(fit, ["service"])
    new = spark.createDataFrame([("ssh",), ("http",)], "service string")
    assert [r[0] for r in enc.transform(new).collect()] == ["other", "http"]


def test_column_unseen_at_fit_is_all_other(spark):
    enc = FE.FrequencyEncoder().fit(spark.createDataFrame([("a",)], "x string"), ["x"])
    df = spark.createDataFrame([("q",)], "y string")
    assert df.select(enc.expr("y").alias("y")).first()[0] == "other"


def test_frequency_share_excludes_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,), (None,)], "c string")
    enc = FE.FrequencyEncoder(threshold=0.4).fit(df, ["c"])
    assert enc.frequent["c"] == ["a"]  # a = 2/3 of non-null rows, b = 1/3
    assert [r[0] for r in enc.transform(df).collect()].count("other") == 4  # b and the three nulls


def test_log1p_values(spark):
    df = spark.createDataFrame([(0.0,), (9.0,), (99.0,)], "x double")
    got = [r[0] for r in df.select(FE.log1p_expr("x")).collect()]
    assert got == pytest.approx([0.0, math.log(10), math.log(100)])


def test_log1p_negative_raises(spark):
    df = spark.createDataFrame([(-1.0,), (5.0,)], "x double")
    with pytest.raises(Exception, match="negative values"):
        df.select(FE.log1p_expr("x")).collect()


def test_robust_scale_zero_iqr_divides_by_one(spark):
    df = spark.createDataFrame([(0.0,)] * 8 + [(5.0,), (7.0,)], "x double")
    sc = FE.RobustScaler().fit(df, ["x"])
    assert sc.scale["x"] == 1.0 and sc.center["x"] == 0.0
    assert [r[0] for r in df.select(sc.expr("x")).collect()][-2:] == [5.0, 7.0]


def test_one_hot_sorted_full_width_unknown_all_zero(spark):
    df = spark.createDataFrame([("SF",), ("REJ",), ("other",)], "flag string")
    oh = FE.OneHot().fit(df, ["flag"])
    assert oh.names() == ["cat__flag_REJ", "cat__flag_SF", "cat__flag_other"]
    row = oh.transform(spark.createDataFrame([("S0",)], "flag string")).first()
    assert list(row) == [0.0, 0.0, 0.0]


def test_binary_metrics_five_rows(spark):
    df = spark.createDataFrame([(0, 0, .1), (1, 1, .9), (1, 0, .2), (0, 0, .3), (1, 1, .85)],
                               "y int, yhat int, p double")
    m = M.binary_metrics(df, "y", "yhat", "p").first()
    assert m["accuracy"] == pytest.approx(0.8)
    assert m["recall"] == pytest.approx(2 / 3, abs=1e-6)
    assert m["precision"] == pytest.approx(1.0)
    assert m["f1"] == pytest.approx(0.8)
    assert m["roc_auc"] > 0.5


def test_binary_label_exact_match_only(spark):
    df = spark.createDataFrame([("normal",), ("neptune",), (" Normal ",), (None,)], "class string")
    assert [r[0] for r in df.select(L.binary_label()).collect()] == [0, 1, 1, 1]


def test_family_label_trim_lower_unknown_is_r2l(spark):
    df = spark.createDataFrame([(" Normal ",), ("SMURF",), ("zzz",), (None,), ("buffer_overflow",)], "class string")
    assert [r[0] for r in df.select(L.family_label()).collect()] == [0, 1, 3, 3, 4]


def test_eda_category_has_no_default(spark):
    df = spark.createDataFrame([("worm",), ("httptunnel",), ("normal",)], "class string")
    assert [r[0] for r in df.select(L.eda_category()).collect()] == ["R2L", None, "Normal"]


def _frame(spark, n=10):
    cols = "protocol_type string, service string, flag string, duration long, class string"
    rows = [("tcp", "http", "SF", i, "normal" if i % 2 else "neptune") for i in range(n)]
    return spark.createDataFrame(rows, cols)


EXPECTED = ["protocol_type", "service", "flag", "duration", "class"]


def test_validation_empty(spark):
    with pytest.raises(QL.ValidationException, match="completely empty"):
        QL.validate(_frame(spark, 0), EXPECTED, "class", ["protocol_type", "service", "flag"])


def test_validation_missing_columns(spark):
    with pytest.raises(QL.ValidationException, match="Missing columns"):
        QL.validate(_frame(spark).drop("flag", "duration"), EXPECTED, "class", ["protocol_type", "service", "flag"])


def test_validation_numeric_categorical(spark):
    df = _frame(spark).withColumn("protocol_type", F.lit(1.0))
    with pytest.raises(QL.ValidationException, match="Type inconsistency"):
        QL.validate(df, EXPECTED, "class", ["protocol_type", "service", "flag"])


def test_validation_success(spark):
    rep = QL.validate(_frame(spark), EXPECTED, "class", ["protocol_type", "service", "flag"])
    assert rep["status"] == "success" and rep["num_samples"] == 10 and rep["duplicate_count"] == 0
