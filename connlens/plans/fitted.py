"""Five learners with closed-form fits, for the model records: fitted to the training rows of ``events``, judged on the
validation and holdout rows, for the binary and the five-family target.

Features: the score of the ``scored`` view, props.k / 100 and the hour / 24.  Every learner gives each class a
log-likelihood; probabilities are their softmax, the predicted class is the largest (the least class if tied).

* naive_bayes: Gaussian, class priors;              * naive_bayes_cost_sensitive: the same with equal priors;
* nearest_centroid: class means, pooled variances;   * decision_tree: one split of the score into 20 bins, Laplace shares;
* categorical_naive_bayes: bins of all three features, Laplace shares.

A fit is two grouped aggregates over the training rows (moments per class, counts per class and bin) whose results have
at most classes x bins rows; scoring is one projection.  The SQL does the same with joins.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from connlens.functions.core import md5_uniform
from connlens.operators import models as MD
from connlens.plans import sqlfrag as Q
from connlens.plans.metric_queries import evaluated
from connlens.sources.tables import table

MODELS = ["naive_bayes", "nearest_centroid", "decision_tree", "categorical_naive_bayes", "naive_bayes_cost_sensitive"]
TARGETS = {"binary": "y", "multiclass": "y_multi"}
FEATS = ["x0", "x1", "x2"]
#: Bins (column, count): the tree's, then those of the categorical naive Bayes.
BINS = [("b0", 20), ("c0", 10), ("c1", 5), ("c2", 4)]


def learner_rows(spark, sf_dir) -> DataFrame:
    more = table(spark, sf_dir, "events").select(F.col("event_id").alias("row_id"), F.get_json_object("props", "$.k").cast("int").alias("k"), F.hour("ts").alias("h"))
    u = md5_uniform("row_id", 7)
    ev = evaluated(spark, sf_dir).select("row_id", "y", "y_multi", "segment", "score").join(more, "row_id")
    return ev.select("row_id", "y", "y_multi", "segment", "score", F.when(u < 0.6, "train").when(u < 0.8, "val").otherwise("holdout").alias("split"),
                     F.col("score").alias("x0"), (F.col("k") / 100.0).alias("x1"), (F.col("h") / 24.0).alias("x2"),
                     F.least(F.floor(F.col("score") * 20), F.lit(19)).cast("int").alias("b0"), F.least(F.floor(F.col("score") * 10), F.lit(9)).cast("int").alias("c0"),
                     F.floor(F.col("k") / 20).cast("int").alias("c1"), F.floor(F.col("h") / 6).cast("int").alias("c2"))


def fit(rows: DataFrame) -> dict:
    """Per target: the classes' moments, the pooled ones, and counts (column, bin, class) -> n, from two aggregates;
    empty if there are no training rows."""
    train = rows.where("split = 'train'")
    parts = MD.gaussian_nb_moments(train, FEATS, "y_multi", ["y"])
    entries = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("bin")) for c, _ in BINS])).alias("e")
    counts = train.select("y", "y_multi", entries).groupBy("y", "y_multi", "e.column", "e.bin").agg(F.count(F.lit(1)).alias("n")).collect()
    out = {}
    for target, label in TARGETS.items() if parts else ():
        named = [{**p, "class": p["y"]} if label == "y" else p for p in parts]
        classes = sorted({p["class"] for p in named})
        held: dict = {}
        for r in counts:
            key = (r["column"], r["bin"], r[label])
            held[key] = held.get(key, 0) + r["n"]
        out[target] = {"classes": [MD.merged_moments([p for p in named if p["class"] == c]) for c in classes], "pool": MD.merged_moments(named), "counts": held}
    return out


def _likelihoods(model: dict) -> dict[str, Column]:
    """Learner -> array of the classes' log-likelihoods."""
    classes, pool, counts = model["classes"], model["pool"], model["counts"]
    eps, total = 1e-9 * max(pool["var"]), pool["n"]

    def squares(c: dict, var: list[float]) -> Column:
        out = F.lit(0.0)
        for f, m, v in zip(FEATS, c["mean"], var):
            out = out + (F.col(f) - m) * (F.col(f) - m) / (2 * (v + eps))
        return out

    def table_of(column: str, size: int, share) -> Column:
        return F.element_at(F.array(*[F.lit(math.log(share(b))) for b in range(size)]), F.col(column) + 1)

    def count(column: str, b: int, c: dict) -> int:
        return counts.get((column, b, c["class"]), 0)

    gauss = [-squares(c, c["var"]) - 0.5 * sum(math.log(2 * math.pi * (v + eps)) for v in c["var"]) for c in classes]
    prior = [math.log(c["n"] / total) for c in classes]
    tree = [table_of("b0", 20, lambda b, c=c: (count("b0", b, c) + 1) / (sum(count("b0", b, o) for o in classes) + len(classes))) for c in classes]
    binned = []
    for c, p in zip(classes, prior):
        term = F.lit(p)
        for column, size in BINS[1:]:
            term = term + table_of(column, size, lambda b, c=c, column=column, size=size: (count(column, b, c) + 1) / (c["n"] + size))
        binned.append(term)
    return {"naive_bayes": F.array(*[g + p for g, p in zip(gauss, prior)]), "nearest_centroid": F.array(*[-squares(c, pool["var"]) for c in classes]),
            "decision_tree": F.array(*tree), "categorical_naive_bayes": F.array(*binned), "naive_bayes_cost_sensitive": F.array(*gauss)}


def scored(rows: DataFrame, fitted: dict) -> DataFrame:
    """The validation and holdout rows per learner: sm (probability of class 1), margin (its log-odds), pb and pm (predicted
    classes of the binary and the family target)."""
    if not fitted:  # no training rows, no models
        return rows.limit(0).select("row_id", "y", "y_multi", "segment", "score", "split", F.lit(0).alias("midx"), F.lit("").alias("model_name"),
                                    F.lit(0.0).alias("margin"), F.lit(0.0).alias("sm"), F.lit(0).alias("pb"), F.lit(0).alias("pm"))
    two, five = _likelihoods(fitted["binary"]), _likelihoods(fitted["multiclass"])
    families = F.array(*[F.lit(c["class"]) for c in fitted["multiclass"]["classes"]])
    where = {c["class"]: i + 1 for i, c in enumerate(fitted["binary"]["classes"])}

    def margin(a: Column) -> Column:
        if len(where) < 2:  # one class only
            return F.lit(50.0 if 1 in where else -50.0)
        return F.element_at(a, where[1]) - F.element_at(a, where[0])

    each = F.array(*[F.struct(F.lit(i).alias("midx"), F.lit(n).alias("model_name"), margin(two[n]).alias("margin"),
                              F.element_at(families, F.array_position(five[n], F.array_max(five[n])).cast("int")).alias("pm")) for i, n in enumerate(MODELS)])
    long = rows.where("split <> 'train'").select("row_id", "y", "y_multi", "segment", "score", "split", F.explode(each).alias("m"))
    sm = 1.0 / (1.0 + F.exp(-F.col("m.margin")))
    return long.select("row_id", "y", "y_multi", "segment", "score", "split", "m.midx", "m.model_name", "m.margin", sm.alias("sm"),
                       (F.col("m.margin") >= 0).cast("int").alias("pb"), "m.pm")


def probabilities(rows: DataFrame, fitted: dict) -> DataFrame:
    """row_id, y and each learner's probability of class 1 (p0, p1, ...) of the validation and holdout rows."""
    each = scored(rows, fitted).groupBy("row_id", "y")
    return each.agg(*[F.max(F.when(F.col("midx") == i, F.col("sm"))).alias(f"p{i}") for i in range(len(MODELS))])


def _sql() -> str:
    gauss = " + ".join(f"(x{i} - m{i}) * (x{i} - m{i}) / (2 * (v{i} + eps))" for i in range(3))
    logs = " + ".join(f"ln(2 * pi() * (v{i} + eps))" for i in range(3))
    pooled = " + ".join(f"(x{i} - m{i}) * (x{i} - m{i}) / (2 * (p{i} + eps))" for i in range(3))
    binned = " + ".join(f"ln((coalesce(t_{c}.n, 0) + 1) / (mom.n + {size}))" for c, size in BINS[1:])
    joins = " ".join(f"LEFT JOIN bins t_{c} ON t_{c}.target = mom.target AND t_{c}.cls = mom.cls AND t_{c}.col = '{c}' AND t_{c}.bin = f.{c}" for c, _ in BINS)
    return f"""f AS (
  SELECT ev.row_id, y, y_multi, segment, score, u, CASE WHEN u < 0.6 THEN 'train' WHEN u < 0.8 THEN 'val' ELSE 'holdout' END AS split,
         score AS x0, k / 100.0 AS x1, h / 24.0 AS x2, CAST(least(floor(score * 20), 19) AS INTEGER) AS b0,
         CAST(least(floor(score * 10), 9) AS INTEGER) AS c0, CAST(floor(k / 20.0) AS INTEGER) AS c1, CAST(floor(h / 6.0) AS INTEGER) AS c2
  FROM ev JOIN (SELECT event_id AS row_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, hour(ts) AS h, {Q.md5_uniform('event_id', 7)} AS u FROM events) USING (row_id)),
tr AS (SELECT 'binary' AS target, y AS cls, * FROM f WHERE split = 'train' UNION ALL SELECT 'multiclass', y_multi, * FROM f WHERE split = 'train'),
mom AS (SELECT target, cls, CAST(count(*) AS DOUBLE) AS n, {", ".join(f"avg(x{i}) AS m{i}, var_pop(x{i}) AS v{i}" for i in range(3))} FROM tr GROUP BY target, cls),
pool AS (SELECT count(*) AS total, {", ".join(f"var_pop(x{i}) AS p{i}" for i in range(3))}, 1e-9 * greatest({", ".join(f"var_pop(x{i})" for i in range(3))}) AS eps
         FROM tr WHERE target = 'binary'),
bins AS ({" UNION ALL ".join(f"SELECT target, cls, '{c}' AS col, {c} AS bin, CAST(count(*) AS DOUBLE) AS n FROM tr GROUP BY target, cls, {c}" for c, _ in BINS)}),
whole AS (SELECT target, bin, sum(n) AS n FROM bins WHERE col = 'b0' GROUP BY target, bin),
sizes AS (SELECT target, count(*) AS c FROM mom GROUP BY target),
wide AS (
  SELECT f.row_id, mom.target, mom.cls, -({gauss}) - 0.5 * ({logs}) AS gauss, ln(mom.n / total) AS prior, -({pooled}) AS centroid,
         ln((coalesce(t_b0.n, 0) + 1) / (coalesce(whole.n, 0) + sizes.c)) AS tree, {binned} AS cat
  FROM f CROSS JOIN mom CROSS JOIN pool JOIN sizes ON sizes.target = mom.target {joins}
  LEFT JOIN whole ON whole.target = mom.target AND whole.bin = f.b0 WHERE f.split <> 'train'),
likely AS (
  SELECT row_id, target, cls, 0 AS midx, gauss + prior AS l FROM wide UNION ALL SELECT row_id, target, cls, 1, centroid FROM wide
  UNION ALL SELECT row_id, target, cls, 2, tree FROM wide UNION ALL SELECT row_id, target, cls, 3, prior + cat FROM wide
  UNION ALL SELECT row_id, target, cls, 4, gauss FROM wide),
margins AS (SELECT row_id, midx, max(l) FILTER (WHERE cls = 1) - max(l) FILTER (WHERE cls = 0) AS margin FROM likely WHERE target = 'binary' GROUP BY row_id, midx),
chosen AS (SELECT row_id, midx, cls AS pm FROM likely WHERE target = 'multiclass' QUALIFY row_number() OVER (PARTITION BY row_id, midx ORDER BY l DESC, cls) = 1),
me AS (
  SELECT f.row_id, f.y, f.y_multi, f.segment, f.score, f.split, m.midx, m.model_name, margin, 1.0 / (1.0 + exp(-margin)) AS sm,
         CAST(margin >= 0 AS INTEGER) AS pb, pm
  FROM margins JOIN chosen USING (row_id, midx) JOIN f USING (row_id)
  JOIN (VALUES {", ".join(f"({i}, '{n}')" for i, n in enumerate(MODELS))}) m(midx, model_name) USING (midx))"""


ME_SQL = _sql()
WIDE_SQL = "wd AS (SELECT row_id, y, " + ", ".join(f"max(sm) FILTER (WHERE midx = {i}) AS p{i}" for i in range(len(MODELS))) + " FROM me GROUP BY row_id, y)"
