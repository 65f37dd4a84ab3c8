"""Isolation forest (Liu, Ting & Zhou 2008) as Spark jobs.

fit
  * every tree gets its own sample of ~psi rows chosen by md5(seed, key, tree):
    below psi x trees x 2 rows each row is tested against every tree (one explode,
    bounded by the tree count); above it each row falls into ONE hash bucket and
    tree t uses bucket t -- a single pass, one hash per row;
  * ``groupBy(tree).applyInPandas`` builds each tree from its <= 1.5 psi rows
    (random feature, uniform split between the node's min and max, depth limit
    ceil(log2 psi));
  * the node table has at most trees x (2 psi - 1) rows -- a proven bound -- and is
    broadcast for scoring.
score
  * ``mapInPandas`` walks all trees for a whole Arrow batch at once (vectorised
    NumPy), s(x) = -2^(-E[h(x)] / c(psi)) (score_samples: lower = more anomalous).
label
  * offset 'auto' = -0.5, else the contamination quantile of the training scores;
    anomaly iff score - offset < 0.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from connlens.functions.core import md5_uniform
from connlens.operators.ordered import exact_quantiles

EULER_GAMMA = 0.5772156649015329

NODE_SCHEMA = T.StructType([
    T.StructField("tree", T.IntegerType()), T.StructField("node", T.IntegerType()),
    T.StructField("feature", T.IntegerType()), T.StructField("threshold", T.DoubleType()),
    T.StructField("left", T.IntegerType()), T.StructField("right", T.IntegerType()),
    T.StructField("size", T.LongType()), T.StructField("depth", T.IntegerType())])


def c_factor(n) -> np.ndarray:
    """Average path length of an unsuccessful BST search among n points."""
    n = np.asarray(n, dtype=np.float64)
    out = np.zeros_like(n)
    out = np.where(n == 2, 1.0, out)
    big = n > 2
    out = np.where(big, 2.0 * (np.log(np.maximum(n - 1, 1)) + EULER_GAMMA) - 2.0 * (n - 1) / np.maximum(n, 1), out)
    return out


def _build_tree(x: np.ndarray, rng: np.random.Generator, max_depth: int):
    nodes = []  # feature, threshold, left, right, size, depth

    def grow(idx: np.ndarray, depth: int) -> int:
        me = len(nodes)
        nodes.append([-1, 0.0, -1, -1, len(idx), depth])
        if depth >= max_depth or len(idx) <= 1:
            return me
        sub = x[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        usable = np.flatnonzero(hi > lo)
        if len(usable) == 0:
            return me
        f = int(rng.choice(usable))
        t = float(rng.uniform(lo[f], hi[f]))
        mask = sub[:, f] < t
        left = grow(idx[mask], depth + 1)
        right = grow(idx[~mask], depth + 1)
        nodes[me][:4] = [f, t, left, right]
        return me

    grow(np.arange(len(x)), 0)
    return nodes


def _to_matrix(series: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in series.to_numpy()])


def fit(train: DataFrame, key: str, vec: str, n_trees: int = 100, psi: int = 256, seed: int = 42) -> dict:
    """Returns {'nodes': pandas node table, 'psi': effective sample size}."""
    n = train.count()
    psi_eff = int(min(psi, n))
    max_depth = int(math.ceil(math.log2(max(psi_eff, 2))))
    base = train.select(F.col(key).cast("string").alias("_k"), F.col(vec).alias("_v"))
    # one rule at every size: a row joins a tree when their md5 falls below 1.5 psi / n; the tree keeps its
    # first psi rows in the order of a second md5
    rate = min(1.0, 1.5 * psi_eff / max(n, 1))
    joined = F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)),
                      lambda t: md5_uniform(F.concat_ws("#", F.col("_k"), t.cast("string")), seed) < rate)
    s = base.select("*", F.explode(joined).alias("tree"))
    s = s.select("tree", "_v", md5_uniform(F.concat_ws("#", "_k", F.col("tree").cast("string")), seed + 1).alias("_u"))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        pdf = pdf.sort_values("_u").head(psi_eff)
        x = _to_matrix(pdf["_v"])
        rng = np.random.default_rng(seed * 1_000_003 + tree)
        nodes = _build_tree(x, rng, max_depth)
        arr = np.asarray(nodes, dtype=object)
        return pd.DataFrame({"tree": tree, "node": np.arange(len(nodes), dtype=np.int32),
                             "feature": arr[:, 0].astype(np.int32), "threshold": arr[:, 1].astype(np.float64),
                             "left": arr[:, 2].astype(np.int32), "right": arr[:, 3].astype(np.int32),
                             "size": arr[:, 4].astype(np.int64), "depth": arr[:, 5].astype(np.int32)})

    nodes = s.groupBy("tree").applyInPandas(build, NODE_SCHEMA).toPandas()  # <= trees x (2 psi - 1) rows
    return {"nodes": nodes, "psi": psi_eff, "n_trees": int(nodes["tree"].nunique()) if len(nodes) else 0}


def _pack(model: dict):
    nodes = model["nodes"].sort_values(["tree", "node"])
    packed = []
    for _, g in nodes.groupby("tree"):
        packed.append((g["feature"].to_numpy(), g["threshold"].to_numpy(), g["left"].to_numpy(),
                       g["right"].to_numpy(), (g["depth"].to_numpy() + c_factor(g["size"].to_numpy()))))
    return packed, float(c_factor(model["psi"]))


def score(df: DataFrame, model: dict, key: str, vec: str) -> DataFrame:
    """(key, score): score_samples = -2^(-E[h] / c(psi)), in (-1, 0)."""
    sc = df.sparkSession.sparkContext
    packed, cpsi = _pack(model)
    bc = sc.broadcast((packed, cpsi))
    key_type = df.schema[key].dataType.simpleString()

    def run(batches):
        trees, c_psi = bc.value
        for pdf in batches:
            if len(pdf) == 0:
                continue
            x = _to_matrix(pdf["_v"])
            total = np.zeros(len(x))
            rows = np.arange(len(x))
            for feat, thr, left, right, leaf_h in trees:
                node = np.zeros(len(x), dtype=np.int64)
                while True:
                    f = feat[node]
                    inner = f >= 0
                    if not inner.any():
                        break
                    go_left = x[rows, np.where(inner, f, 0)] < thr[node]
                    nxt = np.where(go_left, left[node], right[node])
                    node = np.where(inner, nxt, node)
                total += leaf_h[node]
            mean_h = total / max(len(trees), 1)
            yield pd.DataFrame({key: pdf[key], "score": -np.power(2.0, -mean_h / c_psi)})

    schema = f"{key} {key_type}, score double"
    return df.select(key, F.col(vec).alias("_v")).mapInPandas(run, schema)


def offset(train_scores: DataFrame, contamination) -> Column:
    """'auto' -> -0.5; else the contamination quantile of the training scores (scalar)."""
    if contamination == "auto":
        return F.lit(-0.5)
    q = exact_quantiles(train_scores, ["score"], [float(contamination)])
    return q.agg(F.first("value")).scalar()


def offsets(train_scores: DataFrame, contaminations: Sequence) -> dict:
    """All contamination offsets from ONE exact-quantile pass (a handful of numbers is
    the fitted state, brought to the driver once)."""
    numeric = sorted({float(c) for c in contaminations if c != "auto"})
    out = {"auto": -0.5} if "auto" in contaminations else {}
    if numeric:
        got = {round(r["q"], 12): r["value"] for r in exact_quantiles(train_scores, ["score"], numeric).collect()}
        for c in contaminations:
            if c != "auto":
                out[c] = got[round(float(c), 12)]
    return out


def label(scored: DataFrame, off: Column, score_col: str = "score") -> DataFrame:
    """decision = score - offset; anomaly (1) iff decision < 0."""
    return scored.withColumn("decision", F.col(score_col) - off).withColumn(
        "is_anomaly", (F.col("decision") < 0).cast("int"))


def vectors(df: DataFrame, cols: Sequence[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in cols])
