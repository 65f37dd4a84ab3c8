"""Split / subsample / oversample / SMOTE / fold queries."""

from __future__ import annotations

import functools
import math

from pyspark.sql import functions as F

from connlens import config
from connlens.functions.core import r6
from connlens.operators import labels as L
from connlens.operators import neighbors as N
from connlens.operators import sampling as S
from connlens.plans import sqlfrag as Q
from connlens.plans.registry import register
from connlens.session import materialize
from connlens.sources.tables import CONN_CTE, conn_view, table, with_ctes

KEY = ["l_orderkey", "l_partkey", "dst_host", "l_linenumber", "count_"]
KEYS = ", ".join(KEY)
KEY_SQL = "concat_ws('|', l_orderkey, l_partkey, dst_host, l_linenumber, CAST(count_ AS BIGINT))"
#: Two balancing plans: the size a class is grown to, as a multiple of its own.
PLANS = {"B": {3: 2.0, 5: 2.5}, "C": {3: 3.5, 5: 5.0}}


def plan_targets(e, plan):
    """Target row count of each grown class (one row per class comes back)."""
    counts = dict(e.groupBy("label").count().collect())
    return {c: math.ceil(counts.get(c, 0) * m) for c, m in PLANS[plan].items()}


def both_plans(one):
    """The rows of ``one(plan)`` for every plan, with the plan's name."""
    frames = [one(p).withColumn("plan", F.lit(p)) for p in PLANS]
    return functools.reduce(lambda a, b: a.unionByName(b), frames)


def conn_keyed(spark, sf_dir):
    c = conn_view(spark, sf_dir)
    k = F.concat_ws("|", "l_orderkey", "l_partkey", "dst_host", "l_linenumber", F.col("count_").cast("long"))
    return c.select(*KEY, "class", k.alias("rkey"), L.binary_label().alias("target_label"),
                    L.family_label().alias("multiclass_label"))


LAB_CTE = f"""lab AS (SELECT {KEYS}, class, {KEY_SQL} AS rkey, {Q.binary_label()} AS target_label,
  {Q.family_label()} AS multiclass_label, {Q.md5_hex(KEY_SQL)} AS h FROM conn)"""
W = with_ctes(CONN_CTE, LAB_CTE)


@register("stratified_split", W + f"""
SELECT {KEYS}, target_label,
       CASE WHEN row_number() OVER (PARTITION BY target_label ORDER BY h)
                 <= floor(count(*) OVER (PARTITION BY target_label) * {config.TRAIN_RATIO} + 0.5)
            THEN 'train' ELSE 'val' END AS split
FROM lab""")
def q_stratified_split(spark, sf_dir):
    df = conn_keyed(spark, sf_dir)
    return S.stratified_split(df, F.col("rkey"), "target_label").select(*KEY, "target_label", "split")


@register("stratified_subsample", W + f"""
, cc AS (SELECT multiclass_label, count(*) AS n_c FROM lab GROUP BY multiclass_label),
ex AS (SELECT multiclass_label, n_c, least({config.SUBSAMPLE_SIZE}, sum(n_c) OVER ()) * n_c / sum(n_c) OVER () AS e FROM cc),
fl AS (SELECT multiclass_label, n_c, floor(e) AS f, e - floor(e) AS rem FROM ex),
qt AS (SELECT multiclass_label, f + CASE WHEN row_number() OVER (ORDER BY rem DESC, multiclass_label)
              <= least({config.SUBSAMPLE_SIZE}, sum(n_c) OVER ()) - sum(f) OVER () THEN 1 ELSE 0 END AS quota FROM fl)
SELECT {KEYS}, l.multiclass_label FROM
  (SELECT *, row_number() OVER (PARTITION BY multiclass_label ORDER BY h) AS rk FROM lab) l
  JOIN qt ON l.multiclass_label = qt.multiclass_label WHERE rk <= quota""")
def q_stratified_subsample(spark, sf_dir):
    df = conn_keyed(spark, sf_dir)
    return S.stratified_subsample(df, F.col("rkey"), "multiclass_label").select(*KEY, "multiclass_label")


@register("uniform_subsample", W + f"""
SELECT {KEYS} FROM lab ORDER BY h LIMIT {config.UNIFORM_SUBSAMPLE_SIZE}""")
def q_uniform_subsample(spark, sf_dir):
    return S.uniform_subsample(conn_keyed(spark, sf_dir), F.col("rkey"), config.UNIFORM_SUBSAMPLE_SIZE).select(*KEY)


@register("kfold_assign", W + f"""
SELECT {KEYS}, target_label,
       CAST((row_number() OVER (PARTITION BY target_label ORDER BY h) - 1) % 5 AS INTEGER) AS fold FROM lab""")
def q_kfold_assign(spark, sf_dir):
    return S.kfold_assign(conn_keyed(spark, sf_dir), F.col("rkey"), "target_label").select(*KEY, "target_label", "fold")


EMB_H = f"""emb AS (SELECT vec_id, label, embedding, {Q.md5_hex('vec_id')} AS h FROM embeddings)"""


def _ros_sql():
    vals = ", ".join(f"('{p}', {k}, {v})" for p, t in PLANS.items() for k, v in t.items())
    names = ", ".join(f"('{p}')" for p in PLANS)
    return with_ctes(EMB_H, f"""plan AS (
  SELECT n.plan, label, n_c, CAST(greatest(n_c, COALESCE(ceil(n_c * t.times), n_c)) - n_c AS BIGINT) AS m
  FROM (SELECT label, count(*) AS n_c FROM embeddings GROUP BY label) c CROSS JOIN (VALUES {names}) n(plan)
  LEFT JOIN (VALUES {vals}) t(plan, lbl, times) ON c.label = t.lbl AND n.plan = t.plan),
ranked AS (SELECT p.plan, e.vec_id, e.label, e.embedding, row_number() OVER (PARTITION BY p.plan, e.label ORDER BY h) AS rk, p.n_c, p.m
           FROM emb e JOIN plan p ON e.label = p.label),
rep AS (SELECT plan, vec_id, label, embedding, CAST(r.replica AS INTEGER) AS replica FROM ranked,
        LATERAL (SELECT unnest(range(0, CAST(floor(m / n_c) + CASE WHEN rk <= m % n_c THEN 1 ELSE 0 END + 1 AS BIGINT)))
                 AS replica) r)""")


@register("random_oversample", _ros_sql() + "SELECT plan, vec_id, label, replica FROM rep")
def q_random_oversample(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    out = both_plans(lambda p: S.random_oversample(e, F.col("vec_id"), "label", plan_targets(e, p)))
    return out.select("plan", "vec_id", "label", F.col("replica").cast("int").alias("replica"))


@register("union_augmented", _ros_sql() + f"""
SELECT plan, label, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT n.plan, vec_id, label FROM embeddings, (VALUES {", ".join(f"('{p}')" for p in PLANS)}) n(plan)
  UNION ALL SELECT plan, vec_id, label FROM rep WHERE replica > 0) GROUP BY plan, label""")
def q_union_augmented(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")

    def one(plan):
        synth = S.random_oversample(e, F.col("vec_id"), "label", plan_targets(e, plan)).where("replica > 0")
        return e.select("vec_id", "label").unionByName(synth.select("vec_id", "label"))
    return both_plans(one).groupBy("plan", "label").agg(F.count(F.lit(1)).cast("long").alias("n"))


def knn_sql(k, where_q="TRUE", where_r="TRUE", exclude_self=True):
    cond = "a.vec_id <> b.vec_id" if exclude_self else "TRUE"
    return f"""nn AS (
  SELECT qid, nid, CAST(rk AS INTEGER) AS rank, dist FROM (
    SELECT a.vec_id AS qid, b.vec_id AS nid, d.dist,
           row_number() OVER (PARTITION BY a.vec_id ORDER BY d.dist, b.vec_id) AS rk
    FROM embeddings a JOIN embeddings b ON {cond} AND ({where_r.replace('@', 'b.')}),
    LATERAL (SELECT array_distance(CAST(a.embedding AS DOUBLE[64]), CAST(b.embedding AS DOUBLE[64])) AS dist) d
    WHERE {where_q.replace('@', 'a.')}) WHERE rk <= {k})"""


_GROWN = sorted({c for t in PLANS.values() for c in t})


@register("smote", _ros_sql().replace("WITH ", "WITH " + knn_sql(5, "TRUE", "@label = a.label") + ",\n", 1) + f"""
, have AS (SELECT qid, count(*) AS k FROM nn GROUP BY qid),
base AS (SELECT plan, label, vec_id AS base_id, replica, embedding AS x,
                CAST(floor({Q.md5_uniform("concat_ws('#', vec_id, replica)", 43)} * k) + 1 AS INTEGER) AS nb_rank,
                {Q.md5_uniform("concat_ws('#', vec_id, replica)", 44)} AS u
         FROM rep JOIN have ON have.qid = vec_id WHERE replica > 0)
SELECT plan, base.label, base_id, replica, nn.nid, {Q.r6('u')} AS u,
       {", ".join(Q.r6(f"CAST(x[{i + 1}] AS DOUBLE) + u * (CAST(e.embedding[{i + 1}] AS DOUBLE) - CAST(x[{i + 1}] AS DOUBLE))") + f" AS s{i}" for i in range(64))}
FROM base JOIN nn ON base.base_id = nn.qid AND base.nb_rank = nn.rank JOIN embeddings e ON e.vec_id = nn.nid""")
def q_smote(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    nearest = {c: materialize(N.knn_join(e.where(F.col("label") == c), e.where(F.col("label") == c), 5, qid="vec_id",
                                         qvec="embedding", exclude_self=True), "class-neighbours") for c in _GROWN}

    def one(plan):
        targets, out = plan_targets(e, plan), []
        for c in PLANS[plan]:
            grown = S.random_oversample(e.where(F.col("label") == c), F.col("vec_id"), "label", targets)
            out.append(N.smote(grown, nearest[c], "vec_id", "embedding", seed=42).withColumn("label", F.lit(c)))
        return functools.reduce(lambda a, b: a.unionByName(b), out)
    made = materialize(both_plans(one), "synthetic")  # else the vector is computed once per output column
    return made.select("plan", "label", "base_id", F.col("replica").cast("int").alias("replica"), "nid", r6("u").alias("u"),
                                  *[r6(F.element_at("synthetic", i + 1)).alias(f"s{i}") for i in range(64)])


@register("split_rank", W + f"""
SELECT {KEYS}, target_label, CAST(row_number() OVER (PARTITION BY target_label ORDER BY h) AS BIGINT) AS rank FROM lab""")
def q_split_rank(spark, sf_dir):
    from connlens.functions.core import md5_hex
    from connlens.operators.ordered import row_rank
    df = conn_keyed(spark, sf_dir).withColumn("_h", md5_hex(F.col("rkey")))
    return row_rank(df, "_h", ["target_label"], "rank").select(*KEY, "target_label", "rank")


@register("balanced_weights", f"""
WITH t AS (SELECT l.toxic FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
c AS (SELECT toxic, count(*) AS n_c FROM t GROUP BY toxic)
SELECT toxic, CAST(n_c AS BIGINT) AS n_c, {Q.r6('(SELECT count(*) FROM t) * 1.0 / ((SELECT count(*) FROM c) * n_c)')} AS weight
FROM c""")
def q_balanced_weights(spark, sf_dir):
    from connlens.operators.joins import class_weights
    lab = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")
    w = class_weights(lab, "toxic")
    n = lab.groupBy("toxic").agg(F.count(F.lit(1)).cast("long").alias("n_c"))
    return w.join(n, "toxic").select("toxic", "n_c", r6("weight").alias("weight"))
