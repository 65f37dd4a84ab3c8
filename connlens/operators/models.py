"""Model operators: table in -> scored table out.

* Gaussian naive Bayes is closed form: ONE grouped aggregate (count, mean, population
  variance per class and feature) whose result has #classes x #features numbers and
  is compiled into a projection (no UDF, no join).
* Logistic regression, trees, forests, GBT, linear SVM go through MLlib estimators
  (distributed treeAggregate / histogram training); class weights ride on ``weightCol``.
* AdaBoost (SAMME) fits stumps on quantile bins; each round is one pass that adds up
  weights, which are a sum of table entries of the stumps so far (no lineage growth).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from connlens.functions.arrays import argmax, mean_arrays
from connlens.operators import boosting, forest, linear
from connlens.session import drop_table


# ---------------------------------------------------------------------------
# registry-style helpers
# ---------------------------------------------------------------------------

def router_choice(available: DataFrame, preference: Sequence[str]) -> DataFrame:
    """First available model in preference order: (model_name, priority)."""
    pref = available.sparkSession.createDataFrame(list(enumerate(preference)), "priority int, model_name string")
    j = available.join(F.broadcast(pref), "model_name")  # preference list: fixed, tiny
    return j.agg(F.min_by("model_name", "priority").alias("model_name"), F.min("priority").alias("priority")).where(
        F.col("model_name").isNotNull())


# ---------------------------------------------------------------------------
# Gaussian naive Bayes (closed form)
# ---------------------------------------------------------------------------

def gaussian_nb_moments(df: DataFrame, features: Sequence[Column | str], label: str, keys: Sequence[str] = ()) -> list[dict]:
    """Of each class (and each value of ``keys``): its key columns, n, means and population variances; one grouped pass."""
    feats = [F.col(f) if isinstance(f, str) else f for f in features]
    k = len(feats)
    per = df.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("n"),
                                       *[F.avg(f).alias(f"m{i}") for i, f in enumerate(feats)],
                                       *[F.var_pop(f).alias(f"v{i}") for i, f in enumerate(feats)]).collect()
    return [{**{c: r[c] for c in keys}, "class": r[label], "n": r["n"], "mean": [r[f"m{i}"] for i in range(k)], "var": [r[f"v{i}"] for i in range(k)]} for r in per]


def merged_moments(parts: Sequence[dict]) -> dict:
    """The moments of the union of disjoint parts of one class."""
    n = sum(p["n"] for p in parts)
    mean = [sum(p["n"] * x for p, x in zip(parts, xs)) / n for xs in zip(*(p["mean"] for p in parts))]
    var = [sum(p["n"] * (p["var"][i] + (p["mean"][i] - m) ** 2) for p in parts) / n for i, m in enumerate(mean)]
    return {"class": parts[0]["class"], "n": n, "mean": mean, "var": var}


def without_moments(whole: dict, part: dict | None) -> dict | None:
    """The moments of the rows of ``whole`` outside ``part``, by difference; None if no row is left."""
    if part is None:
        return whole
    n = whole["n"] - part["n"]
    if not n:
        return None
    mean = [(whole["n"] * w - part["n"] * p) / n for w, p in zip(whole["mean"], part["mean"])]
    rest = [whole["n"] * wv - part["n"] * pv - (m - pm) ** 2 * n * part["n"] / whole["n"]
            for wv, pv, m, pm in zip(whole["var"], part["var"], mean, part["mean"])]
    return {"class": whole["class"], "n": n, "mean": mean, "var": [max(r, 0.0) / n for r in rest]}


def gaussian_nb_model(per: Sequence[dict], var_smoothing: float = 1e-9) -> dict:
    """Per-class prior, means and variances (+ epsilon = smoothing * max feature variance) from the classes' moments."""
    n = sum(p["n"] for p in per)
    whole = merged_moments(per) if per else {"var": []}
    eps = var_smoothing * max(whole["var"], default=0.0)
    classes = sorted(per, key=lambda p: p["class"])
    return {"classes": [p["class"] for p in classes], "prior": [p["n"] / n for p in classes], "mean": [p["mean"] for p in classes],
            "var": [[v + eps for v in p["var"]] for p in classes]}


def gaussian_nb_fit(df: DataFrame, features: Sequence[Column | str], label: str, var_smoothing: float = 1e-9) -> dict:
    return gaussian_nb_model(gaussian_nb_moments(df, features, label), var_smoothing)


def gaussian_nb_fit_leaving_out(df: DataFrame, features: Sequence[Column | str], label: str, fold: str, var_smoothing: float = 1e-9) -> dict:
    """fold -> the model fitted without that fold's rows.  All of them come from one grouped pass: the moments per
    (fold, class) are merged, and each fold's are taken away again."""
    parts = gaussian_nb_moments(df, features, label, [fold])
    by_class: dict = {}
    for p in parts:
        by_class.setdefault(p["class"], {})[p[fold]] = p
    out = {}
    for k in sorted({p[fold] for p in parts}):
        rest = [without_moments(merged_moments(list(folds.values())), folds.get(k)) for folds in by_class.values()]
        out[k] = gaussian_nb_model([r for r in rest if r is not None], var_smoothing)
    return out


def gaussian_nb_probability(model: dict, features: Sequence[Column | str], cls) -> Column:
    """The probability of class ``cls`` (0 if the model has not seen it)."""
    if cls not in model["classes"]:
        return F.lit(0.0)
    jll = gaussian_nb_jll(model, features)
    own = F.element_at(jll, model["classes"].index(cls) + 1)
    return 1.0 / F.aggregate(jll, F.lit(0.0), lambda s, x: s + F.exp(x - own))


def gaussian_nb_held_out(models: dict, features: Sequence[Column | str], fold: str, cls) -> Column:
    """The probability of ``cls`` by the model that has not seen the row's fold."""
    out = F.lit(None).cast("double")
    for k, model in models.items():
        out = F.when(F.col(fold) == k, gaussian_nb_probability(model, features, cls)).otherwise(out)
    return out


def gaussian_nb_jll(model: dict, features: Sequence[Column | str]) -> Column:
    """Array of joint log-likelihoods, one per class (in ``model['classes']`` order)."""
    x = F.array(*[(F.col(f) if isinstance(f, str) else f).cast("double") for f in features])
    out = []
    for prior, mean, var in zip(model["prior"], model["mean"], model["var"]):
        start = math.log(prior) - 0.5 * sum(math.log(2 * math.pi * v) for v in var)
        squares = F.zip_with(x, F.array(*[F.lit(m) for m in mean]), lambda a, m: (a - m) * (a - m))
        terms = F.zip_with(squares, F.array(*[F.lit(2 * v) for v in var]), lambda d, v: d / v)
        out.append(F.aggregate(terms, F.lit(start), lambda s, t: s - t))
    return F.array(*out)


def gaussian_nb_predict(df: DataFrame, model: dict, features: Sequence[Column | str], keep: Sequence[str] = ()) -> DataFrame:
    jll = gaussian_nb_jll(model, features)
    d = df.select(*keep, jll.alias("_jll"))
    m = F.array_max("_jll")
    e = F.transform("_jll", lambda x: F.exp(x - m))
    s = F.aggregate(e, F.lit(0.0), lambda a, x: a + x)
    classes = F.array(*[F.lit(c) for c in model["classes"]])
    return d.select(*keep, F.element_at(classes, argmax("_jll") + 1).alias("pred"),
                    F.transform(e, lambda x: x / s).alias("probability"))


# ---------------------------------------------------------------------------
# MLlib estimators
# ---------------------------------------------------------------------------

def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


def fit_logistic(train: DataFrame, label: str, weight: str | None = None, max_iter: int = 1000):
    n = train.count()
    lr = LogisticRegression(featuresCol="features", labelCol=label, maxIter=max_iter, regParam=1.0 / max(n, 1),
                            elasticNetParam=0.0, standardization=False)
    if weight:
        lr.setWeightCol(weight)
    return lr.fit(train)


def fit_logistic_leaving_out(rows: DataFrame, features: Sequence[str], label: str, fold: str | None = None, folds: int = 0,
                             max_iter: int = 1000) -> list[linear.Linear]:
    """The logistic regressions (labels 0 and 1) of ``fit_logistic`` without each fold, and last that of all rows.  They share
    their passes over the table of ``rows``, and no copy of it is cached."""
    given = rows.select(F.array(*[F.col(f).cast("double") for f in features]).alias("x"), F.col(label).alias("y"), *([F.col(fold).alias("fold")] if fold else []))
    return linear.fit_linear(given, [(1, k) for k in [*range(folds), None]], "log", max_iter, penalty=lambda n: 1.0 / max(n, 1))


def fit_tree(train: DataFrame, label: str, max_depth: int = 10, weight: str | None = None, seed: int = 42):
    dt = DecisionTreeClassifier(featuresCol="features", labelCol=label, maxDepth=max_depth, seed=seed)
    if weight:
        dt.setWeightCol(weight)
    return dt.fit(train)


#: A pass of a forest's training adds up one table per open node of its node group, at random places: a group whose
#: tables fit a core's cache costs more passes, each of them much cheaper.
FOREST_NODE_MB = 8
#: With more rows a forest is grown on blocks of binned rows.  MLlib takes some 600 ns a row, tree and level.
FOREST_MLLIB_ROWS = 100_000


def fit_random_forest(train: DataFrame, label: str, n_trees: int = 100, max_depth: int = 10,
                      weight: str | None = None, seed: int = 42):
    if train.count() > FOREST_MLLIB_ROWS:
        return forest.fit_forest(train, label, n_trees, max_depth, weight, seed)
    rf = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=n_trees, maxDepth=max_depth,
                                seed=seed, featureSubsetStrategy="sqrt", maxMemoryInMB=FOREST_NODE_MB)
    if weight:
        rf.setWeightCol(weight)
    return rf.fit(train)


def fit_gbt(train: DataFrame, label: str, n_iter: int = 100, max_depth: int = 5, step: float = 0.05,
            subsample: float = 0.8, seed: int = 42):
    """Gradient-boosted trees for labels 0 and 1."""
    return boosting.fit_boosted_trees(train, label, [1], n_iter, max_depth, step, subsample, seed)


def fit_gbt_ovr(train: DataFrame, label: str, n_iter: int = 100, max_depth: int = 5, step: float = 0.05,
                subsample: float = 0.8, seed: int = 42):
    """Gradient-boosted trees of each class against the others; the models share the passes over the rows."""
    last = train.agg(F.max(label)).first()[0]
    model = boosting.fit_boosted_trees(train, label, range(int(last or 0) + 1), n_iter, max_depth, step, subsample, seed)
    model.one_vs_rest = True
    return model


def ovr_probabilities(scored: DataFrame, raw: str = "rawPrediction", out: str = "probability") -> DataFrame:
    """OneVsRest yields one margin per class: sigmoid each, then normalise."""
    arr = vector_to_array(F.col(raw))
    sig = F.transform(arr, lambda m: 1.0 / (1.0 + F.exp(-m)))
    tot = F.aggregate(sig, F.lit(0.0), lambda a, x: a + x)
    return scored.withColumn(out, F.transform(sig, lambda x: x / tot))


def fit_linear_svm(train: DataFrame, label: str, max_iter: int = 100):
    """Linear SVM + Platt scaling (logistic regression on the margin)."""
    svm = LinearSVC(featuresCol="features", labelCol=label, maxIter=max_iter).fit(train)
    margin = (svm.transform(train).withColumn("_margin", vector_to_array("rawPrediction")[1])
              .drop("rawPrediction", "prediction"))
    platt = LogisticRegression(featuresCol="_mf", labelCol=label).fit(
        VectorAssembler(inputCols=["_margin"], outputCol="_mf").transform(margin))
    return svm, platt


def fit_linear_svm_ovr(train: DataFrame, label: str, max_iter: int = 100):
    """One linear SVM per class against the others; the class with the largest decision value is predicted.  The models
    share their passes over blocks of the rows."""
    last = train.agg(F.max(label)).first()[0]
    rows = train.select(vector_to_array("features").alias("x"), F.col(label).alias("y"))
    return linear.LinearOneVsRest(linear.fit_linear(rows, [(k, None) for k in range(int(last or 0) + 1)], "hinge", max_iter, blocks=True))


def svm_probability(svm, platt, df: DataFrame) -> DataFrame:
    m = svm.transform(df).withColumn("_margin", vector_to_array("rawPrediction")[1])
    m = VectorAssembler(inputCols=["_margin"], outputCol="_mf").transform(m.drop("rawPrediction", "prediction"))
    return platt.transform(m)


def adaboost_bins(df: DataFrame, features: Sequence[str], n_bins: int = 32) -> tuple[DataFrame, dict]:
    """Quantile bin edges per feature (one approxQuantile job; features x bins numbers)
    and the binned frame (JVM Bucketizer, multi-column)."""
    from pyspark.ml.feature import Bucketizer
    probs = [i / n_bins for i in range(1, n_bins)]
    qs = df.approxQuantile(list(features), probs, 1.0 / (10 * n_bins))
    splits = {f: [float("-inf")] + sorted(set(q)) + [float("inf")] for f, q in zip(features, qs)}
    bk = Bucketizer(splitsArray=[splits[f] for f in features], inputCols=list(features),
                    outputCols=[f"_bin_{f}" for f in features], handleInvalid="keep")
    return bk.transform(df), splits


def adaboost_votes(stumps: Sequence[dict], splits: dict, classes: int) -> dict:
    """Per feature the votes of its stumps for each class at each bin, (bins x classes).  A stump reads one feature, so
    a row's votes for a class are the sum of one entry a feature; rows without a value are in the last bin."""
    import numpy as np
    votes = {f: np.zeros((len(cuts), classes)) for f, cuts in splits.items()}
    for st in stumps:
        t = votes[st["feature"]]
        t[:st["cut"], st["left"]] += st["alpha"]
        t[st["cut"]:, st["right"]] += st["alpha"]
    return votes


def _bin(f: str, splits: dict) -> Column:
    return F.coalesce(F.col(f"_bin_{f}").cast("int"), F.lit(len(splits[f]) - 1))


def fit_adaboost(train: DataFrame, features: Sequence[str], label: str, n_rounds: int = 100, classes: int = 2,
                 n_bins: int = 32) -> dict:
    """SAMME with decision stumps on quantile bins.

    The binned rows are written once, in blocks, with one code per group of features for the bins and the class.  A row's
    weight is the exponential of the votes against its class so far, the sum of one entry per group of ``adaboost_votes``;
    so no weight column is kept.  Round r is one pass in which every task adds up the weights by (feature, bin, class);
    their sum (<= features x bins x classes numbers) comes to the driver, which picks the stump with the smallest weighted error."""
    binned, splits = adaboost_bins(train, features, n_bins)
    bins = [len(splits[f]) for f in features]
    groups = boosting.feature_groups(bins)
    y = F.col(label).cast("int")

    def codes_of(batch):
        import numpy as np
        cols = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("_y", *features)]
        return [cols[0], *[c * classes + cols[0] for c in boosting.group_codes(cols[1:], bins, groups)]]

    rows = binned.where(y.between(0, classes - 1)).select(y.alias("_y"), *[_bin(f, splits).alias(f) for f in features])
    cells = max(math.prod(bins[i] for i in g) for g in groups) * classes
    blocks = boosting.write_blocks(rows, codes_of, boosting.code_types(groups, "uint16" if cells <= 1 << 16 else "uint32"), "adaboost-blocks")
    stumps: list[dict] = []
    for _ in range(n_rounds):
        sums = _weight_sums(bins, groups, classes, list(adaboost_votes(stumps, splits, classes).values()), sum(st["alpha"] for st in stumps), cells <= 1 << 16)
        best = _best_stump(boosting.sum_over_blocks(blocks, sums), features, bins, classes)
        if best is None:
            break
        err = best["err"]
        if err >= 1 - 1.0 / classes:
            break
        best["alpha"] = (math.log((1 - err) / err) + math.log(classes - 1)) if err > 0 else 1.0
        stumps.append(best)
        if err <= 0:
            break
    drop_table(blocks)
    return {"stumps": stumps, "splits": splits, "features": list(features), "classes": classes}


def _weight_sums(bins: list[int], groups: list[list[int]], classes: int, votes: list, total: float, short: bool):
    """A task's weights by feature, bin and class, from blocks whose group codes are cell * classes + class."""
    def sums(blocks):
        import numpy as np
        tables = [boosting.over_group({i: votes[i] for i in g}, bins, g, np.add, None).ravel() for g in groups]
        held = [np.zeros(len(t)) for t in tables]
        for block in blocks:
            codes = [np.frombuffer(block[f"g{i}"], np.uint16 if short else np.uint32).astype(np.int64) for i in range(len(groups))]
            weight = np.full(len(codes[0]), total / 2)  # weights count relative to one another: away from over- and underflow
            for t, c in zip(tables, codes):
                weight -= t[c]
            np.exp(weight, out=weight)
            for h, c in zip(held, codes):
                h += np.bincount(c, weights=weight, minlength=len(h))
        parts = {}
        for g, h in zip(groups, held):
            parts |= boosting.by_feature(h.reshape(-1, classes).T, bins, g)
        return [parts[i].T for i in range(len(bins))]

    return sums


def _best_stump(sums, features, bins, classes):
    import numpy as np
    best = None
    for f, b, flat in zip(features, bins, sums):  # the first feature wins a tie
        m = flat.reshape(b, classes)
        total = m.sum()
        if total <= 0:
            continue
        cum = np.cumsum(m, axis=0)
        for cut in range(1, int(np.flatnonzero(m.any(axis=1))[-1]) + 1):
            left, right = cum[cut - 1], cum[-1] - cum[cut - 1]
            lc, rc = int(np.argmax(left)), int(np.argmax(right))
            err = (total - left[lc] - right[rc]) / total
            if best is None or err < best["err"] - 1e-15:
                best = {"feature": f, "cut": cut, "left": lc, "right": rc, "err": float(err)}
    return best


def adaboost_predict(model: dict, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """argmax_k sum_i alpha_i [stump_i(x) = k]: per feature and class one look-up of the stumps' votes at the row's
    bin, whatever the number of rounds."""
    from pyspark.ml.feature import Bucketizer
    feats, splits, classes = model["features"], model["splits"], model["classes"]
    bk = Bucketizer(splitsArray=[splits[f] for f in feats], inputCols=feats,
                    outputCols=[f"_bin_{f}" for f in feats], handleInvalid="keep")
    d = bk.transform(df)
    if not model["stumps"]:
        return d.select(*keep, F.lit(0).alias("pred"), F.lit(0.0).alias("score"))
    tables = adaboost_votes(model["stumps"], splits, classes)

    def votes_for(k):
        out = F.lit(0.0)
        for f in feats:
            if tables[f].any():  # features without a stump have no votes
                out = out + F.element_at(F.array(*[F.lit(float(v)) for v in tables[f][:, k]]), _bin(f, splits) + 1)
        return out

    share = F.element_at("_votes", 2) / F.aggregate("_votes", F.lit(0.0), lambda s, v: s + v)
    return d.withColumn("_votes", F.array(*[votes_for(k) for k in range(classes)])).select(*keep, argmax("_votes").alias("pred"), share.alias("score"))


def soft_vote(*prob_cols: str) -> tuple[Column, Column]:
    """Mean of probability arrays and its argmax."""
    p = mean_arrays(*prob_cols)
    return p, argmax(p)


def pipeline_fit(stages, df: DataFrame):
    return Pipeline(stages=stages).fit(df)
