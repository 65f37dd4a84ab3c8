"""Day sketches against exact values."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from connlens.operators import sketches as SK

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    return [(int(d), f"k{int(rng.integers(0, 4000))}" if rng.random() > 0.02 else None, float(rng.normal(d / 10, 1)) if rng.random() > 0.02 else None)
            for d in rng.integers(0, 12, 30_000)]


@pytest.fixture(scope="module")
def days(spark, rows):
    df = spark.createDataFrame(rows, "d int, k string, x double")
    return SK.day_sketches(df, F.col("d"), ["k"], ["x"]).cache()


def test_counts_and_quantiles_lie_within_their_bounds(rows, days):
    keys, values = {k for _, k, _ in rows if k is not None}, np.sort([x for *_, x in rows if x is not None])
    got = SK.distinct_counts(days).collect()
    assert [(r.column, r.n) for r in got] == [("k", sum(k is not None for _, k, _ in rows))]
    assert abs(got[0].nunique - len(keys)) <= 4 * SK.DISTINCT_ERROR * len(keys)
    probs = [0.01, 0.25, 0.5, 0.9, 0.999]
    for r in SK.quantiles(days, probs).collect():
        rank = np.searchsorted(values, r.value) / len(values)
        assert abs(rank - r.q) <= 2 * SK.RANK_ERROR
    for r in SK.quantiles(days, [0.5], ["column", "day"]).collect():
        own = np.sort([x for d, _, x in rows if d == r.day and x is not None])
        assert abs(np.searchsorted(own, r.value) / len(own) - 0.5) <= 2 * SK.RANK_ERROR + 1 / len(own)


def test_merging_in_any_order_agrees(spark, rows, days):
    stored = days.collect()
    values = np.sort([x for *_, x in rows if x is not None])
    counts = set()
    for seed in range(3):
        random.Random(seed).shuffle(stored)
        shuffled = spark.createDataFrame(stored, days.schema).repartition(seed + 1)
        halves = SK.merged(shuffled.where(F.col("day") % 2 == seed % 2)).unionByName(SK.merged(shuffled.where(F.col("day") % 2 != seed % 2)))
        counts |= {SK.distinct_counts(halves).first().nunique, SK.distinct_counts(shuffled).first().nunique}
        for source in (halves, shuffled):
            for r in SK.quantiles(source, [0.1, 0.5, 0.9]).collect():
                assert abs(np.searchsorted(values, r.value) / len(values) - r.q) <= 2 * SK.RANK_ERROR
    assert len(counts) == 1


def test_drift_against_exact_distances(rows, days):
    base = np.sort([x for d, _, x in rows if x is not None and d < 3])
    edges = np.quantile(base, np.arange(1, 10) / 10)
    for r in SK.drift(days, days.where("day < 3")).collect():
        own = np.sort([x for d, _, x in rows if x is not None and d == r.day])
        share = lambda v: np.maximum(np.diff(np.concatenate(([0], np.searchsorted(v, edges, "right") / len(v), [1]))), SK.LEAST_SHARE)
        psi = ((share(own) - share(base)) * np.log(share(own) / share(base))).sum()
        grid = np.concatenate((own, base))
        ks = np.abs(np.searchsorted(own, grid, "right") / len(own) - np.searchsorted(base, grid, "right") / len(base)).max()
        assert abs(r.psi - psi) < 0.05 and abs(r.ks - ks) < 4 * SK.RANK_ERROR + 0.01 and r.n == len(own)


def test_nulls_empty_tables_and_constant_columns(spark):
    schema = "d int, k string, x double"
    assert SK.distinct_counts(SK.day_sketches(spark.createDataFrame([], schema), F.col("d"), ["k"], ["x"])).collect() == []
    df = spark.createDataFrame([(1, None, None), (2, "a", 5.0), (2, "a", 5.0), (3, None, float("nan")), (None, "b", 5.0)], schema)
    days = SK.day_sketches(df, F.col("d"), ["k"], ["x"])
    assert [(r.column, r.n, r.nunique) for r in SK.distinct_counts(days).collect()] == [("k", 3, 2)]
    assert [(r.q, r.value) for r in SK.quantiles(days, [0.0, 1.0]).collect()] == [(0.0, 5.0), (1.0, 5.0)]
    assert {(r.day, r.n, r.ks) for r in SK.drift(days, days).collect()} == {(2, 2, 0.0), (None, 1, 0.0)}


def test_registered_queries_against_the_table(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    for r in E.queries()["sketch_nunique"](spark, SF).collect():
        exact = events.agg(F.count_distinct(r.column)).first()[0]
        assert r.n == 10_000 and abs(r.nunique - exact) <= max(1, 4 * SK.DISTINCT_ERROR * exact)
    values = np.sort([r.value for r in events.select("value").collect()])
    for r in E.queries()["sketch_quantiles"](spark, SF).collect():
        assert abs(np.searchsorted(values, r.value) / len(values) - r.q) <= 2 * SK.RANK_ERROR
    got = E.queries()["sketch_drift"](spark, SF).collect()
    assert len(got) == 30 and all(0 <= r.ks < 0.2 and 0 <= r.psi < 0.3 for r in got)
