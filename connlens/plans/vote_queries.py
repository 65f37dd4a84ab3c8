"""Soft votes of the closed-form learners (``plans/fitted.py``): the mean of their probabilities, 0.5 or more is an attack."""

from __future__ import annotations

import functools
import itertools

from pyspark.sql import functions as F

from connlens.functions.core import r6, safe_div
from connlens.operators import metrics as M
from connlens.operators.sweep import _cnt
from connlens.plans import fitted as FIT
from connlens.plans import sqlfrag as Q
from connlens.plans.metric_queries import BINARY_SQL, EVAL_CTE
from connlens.plans.registry import register
from connlens.session import materialize
from connlens.sources.tables import SCORED_CTE, with_ctes

TRIO = [0, 2, 3]  # Gaussian naive Bayes, the tree, categorical naive Bayes
COMBINATIONS = [c for size in range(2, len(FIT.MODELS) + 1) for c in itertools.combinations(range(len(FIT.MODELS)), size)]
BASE = [SCORED_CTE, EVAL_CTE.replace("ev AS (", "ev0 AS (", 1), FIT.ME_SQL.replace("FROM ev JOIN", "FROM ev0 ev JOIN"), FIT.WIDE_SQL]


def _mean_sql(members) -> str:
    return "(" + " + ".join(f"p{i}" for i in members) + f") / {float(len(members))}"


def _mean(members):
    return functools.reduce(lambda a, b: a + b, [F.col(f"p{i}") for i in members]) / float(len(members))


def _name(members) -> str:
    return "+".join(FIT.MODELS[i] for i in members)


def _wide(spark, sf_dir):
    rows = materialize(FIT.learner_rows(spark, sf_dir), "learner-rows", spread="row_id")
    return materialize(FIT.probabilities(rows, FIT.fit(rows)), "learner-votes")


@register("vote_soft", with_ctes(*BASE, f"ev AS (SELECT y, score, CAST(score >= 0.5 AS INTEGER) AS pred FROM (SELECT y, {_mean_sql(TRIO)} AS score FROM wd))") + BINARY_SQL.replace(
    "SELECT " + Q.r6(Q.sdiv("tp + tn", "n")), f"SELECT '{_name(TRIO)}' AS model_name, 'binary' AS target_type, " + Q.r6(Q.sdiv("tp + tn", "n")), 1))
def q_vote_soft(spark, sf_dir):
    """The trio's vote on the validation and holdout rows."""
    p = _wide(spark, sf_dir).select("y", _mean(TRIO).alias("score")).withColumn("pred", (F.col("score") >= 0.5).cast("int"))
    return M.binary_metrics(p, "y", "pred", "score").select(F.lit(_name(TRIO)).alias("model_name"), F.lit("binary").alias("target_type"), "*")


def _ablation_sql(members) -> str:
    hit, yes, no = f"{_mean_sql(members)} >= 0.5", "y = 1", "y = 0"
    n = lambda c: f"count(*) FILTER (WHERE {c})"
    tp, fp = n(f"{hit} AND {yes}"), n(f"{hit} AND {no}")
    return (f"SELECT '{_name(members)}' AS members, {len(members)} AS size, {Q.r6(Q.sdiv(n(f'({hit}) = ({yes})'), 'count(*)'))} AS accuracy, "
            f"{Q.r6(Q.sdiv(tp, n(hit)))} AS precision, {Q.r6(Q.sdiv(tp, n(yes)))} AS recall, {Q.r6(Q.sdiv(fp, n(no)))} AS fpr FROM wd")


@register("vote_ablation", with_ctes(*BASE) + " UNION ALL ".join(_ablation_sql(c) for c in COMBINATIONS))
def q_vote_ablation(spark, sf_dir):
    """Every vote of two or more learners, judged in one aggregate of conditional counts."""
    yes, aggs = F.col("y") == 1, []
    for k, c in enumerate(COMBINATIONS):
        hit = _mean(c) >= 0.5
        aggs += [_cnt(hit == yes).alias(f"a{k}"), _cnt(hit & yes).alias(f"t{k}"), _cnt(hit).alias(f"h{k}"), _cnt(hit & ~yes).alias(f"f{k}")]
    one = _wide(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"), _cnt(yes).alias("pos"), *aggs)
    rows = F.array(*[F.struct(F.lit(_name(c)).alias("members"), F.lit(len(c)).alias("size"), r6(safe_div(f"a{k}", "n")).alias("accuracy"),
                              r6(safe_div(f"t{k}", f"h{k}")).alias("precision"), r6(safe_div(f"t{k}", "pos")).alias("recall"),
                              r6(safe_div(f"f{k}", F.col("n") - F.col("pos"))).alias("fpr")) for k, c in enumerate(COMBINATIONS)])
    return one.select(F.explode(rows).alias("r")).select("r.*")
