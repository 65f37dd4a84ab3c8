"""kNN, KNN vote and LOF queries over ``embeddings``."""

from __future__ import annotations

from pyspark.sql import functions as F

from connlens.functions.core import r6
from connlens.operators import neighbors as N
from connlens.operators.ordered import exact_quantiles
from connlens.plans import sqlfrag as Q
from connlens.plans.registry import register
from connlens.plans.sampling_queries import knn_sql
from connlens.session import materialize
from connlens.sources.tables import table, with_ctes

K = 5
LOF_K = 10


def _emb(spark, sf_dir):
    return table(spark, sf_dir, "embeddings")


@register("knn_join", with_ctes(knn_sql(K)) + f"SELECT qid, nid, rank, {Q.r6('dist')} AS dist FROM nn")
def q_knn_join(spark, sf_dir):
    e = _emb(spark, sf_dir)
    nn = N.knn_join(e, e, K, qid="vec_id", qvec="embedding", exclude_self=True)
    return nn.select("qid", "nid", "rank", r6("dist").alias("dist"))


@register("knn_classify", with_ctes(knn_sql(K)) + """
, votes AS (SELECT nn.qid, e.label, count(*) AS votes FROM nn JOIN embeddings e ON nn.nid = e.vec_id
            GROUP BY nn.qid, e.label)
SELECT qid, CAST(label AS INTEGER) AS pred, CAST(votes AS BIGINT) AS votes FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY votes DESC, label) AS r FROM votes) WHERE r = 1""")
def q_knn_classify(spark, sf_dir):
    e = _emb(spark, sf_dir)
    nn = N.knn_join(e, e, K, qid="vec_id", qvec="embedding", exclude_self=True)
    return N.knn_classify(nn, e, "vec_id", "label")


def _lof_sql():
    ref_nn = knn_sql(LOF_K, "@label <> 5", "@label <> 5").replace("nn AS (", "ref_nn AS (", 1)
    q_nn = knn_sql(LOF_K, "TRUE", "@label <> 5", exclude_self=False).replace("nn AS (", "q_nn AS (", 1)
    return with_ctes(ref_nn, q_nn) + f"""
, kd AS (SELECT qid, max(dist) AS kdist FROM ref_nn GROUP BY qid),
lrd AS (SELECT r.qid, 1.0 / (avg(greatest(r.dist, k2.kdist)) + 1e-10) AS lrd
        FROM ref_nn r JOIN kd k2 ON r.nid = k2.qid GROUP BY r.qid),
nof AS (SELECT r.qid, -(avg(l.lrd) / (1.0 / (avg(greatest(r.dist, k.kdist)) + 1e-10))) AS score
        FROM ref_nn r JOIN kd k ON r.nid = k.qid JOIN lrd l ON r.nid = l.qid GROUP BY r.qid),
off AS (SELECT quantile_cont(score, 0.1) AS o FROM nof),
sc AS (SELECT q.qid, -(avg(l.lrd) / (1.0 / (avg(greatest(q.dist, k.kdist)) + 1e-10))) AS score
       FROM q_nn q JOIN kd k ON q.nid = k.qid JOIN lrd l ON q.nid = l.qid GROUP BY q.qid)
SELECT qid AS vec_id, {Q.r6('score')} AS score, score < -1.5 AS outlier_auto, score < off.o AS outlier_c10
FROM sc, off"""


@register("lof", _lof_sql())
def q_lof(spark, sf_dir):
    e = _emb(spark, sf_dir)
    ref = e.where("label <> 5")
    # one search serves the scores and, without each row itself, the fit; its table is read several times: write it once
    nn = materialize(N.knn_join(e, ref, LOF_K + 1, qid="vec_id", qvec="embedding"), "lof-neighbours")
    ref_nn = N.without_self(nn.join(ref.select(F.col("vec_id").cast("long").alias("qid")), "qid", "left_semi"), LOF_K)
    fitted = N.lof_fit(ref_nn)
    nof = N.lof_training_factor(ref_nn, fitted)
    offset = exact_quantiles(nof, ["score"], [0.1]).agg(F.first("value")).scalar()
    sc = N.lof_score(nn.where(F.col("rank") <= LOF_K), fitted)
    return sc.select(F.col("qid").alias("vec_id"), r6("score").alias("score"),
                     (F.col("score") < -1.5).alias("outlier_auto"), (F.col("score") < offset).alias("outlier_c10"))
