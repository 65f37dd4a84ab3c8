"""Invariants and brute-force checks for the scalable primitives."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from connlens.operators import anomaly as IF
from connlens.operators import hybrid as H
from connlens.operators import metrics as M
from connlens.operators import neighbors as N
from connlens.operators import ordered as O
from connlens.operators import traffic as TR


def test_prefix_sums_match_cumsum(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 400), "k": rng.permutation(400).astype(float),
                        "v": rng.integers(0, 10, 400)})
    df = spark.createDataFrame(pdf)
    got = O.prefix_sums(df, F.col("k"), ["v"], ["g"], num_buckets=7).toPandas()
    exp = pdf.sort_values(["g", "k"]).assign(cum_v=lambda d: d.groupby("g")["v"].cumsum())
    m = got.merge(exp, on=["g", "k"])
    assert (m["cum_v_x"] == m["cum_v_y"]).all() and len(m) == 400


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=301).round(2)
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    got = {r["q"]: r["value"] for r in O.exact_quantiles(df, ["x"], [0.1, 0.25, 0.5, 0.9]).collect()}
    for q, v in got.items():
        assert v == pytest.approx(np.quantile(x, q))


def test_exact_quantiles_over_ties_magnitudes_and_infinities(spark):
    rng = np.random.default_rng(5)
    n = 30_000
    cols = {"tied": rng.integers(0, 7, n).astype(float), "wide": 10.0 ** rng.uniform(-200, 200, n) * rng.choice([-1, 1], n),
            "near": 1e9 + rng.integers(0, 50_000, n) * 1e-5, "ends": np.r_[[-np.inf] * 3, rng.normal(size=n - 6), [np.inf] * 3], "one": np.ones(n)}
    df = spark.createDataFrame(pd.DataFrame(cols)).withColumn("none", F.lit(None).cast("double"))
    probs = [0.0, 0.001, 0.25, 0.5, 0.5001, 0.9, 1.0]
    got = {(r["column"], r["q"]): r["value"] for r in O.exact_quantiles(df, [*cols, "none"], probs).collect()}
    assert len(got) == len(cols) * len(probs)
    for c, x in cols.items():
        for q in probs:
            want = np.quantile(x, q) if c != "ends" else np.quantile(np.clip(x, -1e9, 1e9), q)
            assert got[c, q] == pytest.approx(want if abs(want) < 1e9 or c != "ends" else np.sign(want) * np.inf, rel=1e-12)


def test_roc_auc_beyond_the_range_of_int(spark):
    df = spark.range(140_000).select((F.col("id") % 2).alias("y"), (F.col("id") / 7).alias("p"))
    assert 70_000**2 > 2**31
    assert M.roc_auc(df, "y", "p").first()[0] == pytest.approx(0.5, abs=1e-4)
    assert M.roc_auc(df, "y", F.col("y") + 0.5).first()[0] == 1.0


@pytest.mark.parametrize("limit", [5, 200_000])
def test_rank_cutoffs_match_sorted_ranks(spark, monkeypatch, limit):
    # limit=5 forces the histogram-refinement passes; the default ranks directly
    monkeypatch.setattr(O, "MAX_FINAL_CANDIDATES", limit)
    import hashlib
    rng = np.random.default_rng(4)
    n = 3000
    pdf = pd.DataFrame({"g": rng.integers(0, 4, n), "id": np.arange(n)})
    pdf["h"] = [hashlib.md5(f"7|{i}".encode()).hexdigest() for i in pdf["id"]]
    sizes = pdf.groupby("g").size()
    quotas = {0: 0, 1: int(sizes[1]) // 3, 2: int(sizes[2]) + 5}  # group 3 has no quota row -> 0
    q = spark.createDataFrame([(int(k), int(v)) for k, v in quotas.items()], "g long, _q long")
    got = O.first_in_hash_order(spark.createDataFrame(pdf), "h", ["g"], q).toPandas()
    pdf["rk"] = pdf.groupby("g")["h"].rank(method="first")
    pdf["exp"] = pdf["rk"] <= pdf["g"].map(quotas).fillna(0)
    m = got.merge(pdf, on="id")
    assert len(m) == n and (m["_in"] == m["exp"]).all()
    one = spark.createDataFrame([(777,)], "_q long")
    flat = O.first_in_hash_order(spark.createDataFrame(pdf[["id", "h"]]), "h", [], one).where("_in")
    assert sorted(r["id"] for r in flat.collect()) == sorted(pdf.sort_values("h")["id"].head(777))


def test_auc_symmetry_and_ties(spark):
    pdf = pd.DataFrame({"y": [0, 0, 1, 1, 1, 0], "p": [0.1, 0.5, 0.5, 0.9, 0.3, 0.2]})
    df = spark.createDataFrame(pdf)
    a = M.roc_auc(df, "y", "p").first()[0]
    b = M.roc_auc(df.withColumn("p", 1 - F.col("p")), "y", "p").first()[0]
    assert a + b == pytest.approx(1.0)
    # brute force Mann-Whitney with half credit for ties
    pos, neg = pdf[pdf.y == 1].p.to_numpy(), pdf[pdf.y == 0].p.to_numpy()
    mw = np.mean([(pp > nn) + 0.5 * (pp == nn) for pp in pos for nn in neg])
    assert a == pytest.approx(mw)


def test_auc_single_class_is_half(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.4)], "y int, p double")
    assert M.roc_auc(df, "y", "p").first()[0] == 0.5


def test_average_precision_step_rule(spark):
    pdf = pd.DataFrame({"y": [1, 0, 1, 1, 0, 0], "p": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4]})
    ap = M.average_precision(spark.createDataFrame(pdf), "y", "p").first()[0]
    # precisions at each positive: 1/1, 2/3, 3/4 -> mean
    assert ap == pytest.approx((1 + 2 / 3 + 3 / 4) / 3)


def test_hybrid_t_zero_equals_always_override(spark):
    pdf = pd.DataFrame({"d1": [-0.3, -0.01, 0.2, -0.2, 0.05], "s2": [0, 0, 0, 2, 0]})
    df = spark.createDataFrame(pdf).withColumn("s1", F.col("d1") < 0)
    a = [r[0] for r in df.select(H.decide("s1", "s2", "d1", None)).collect()]
    b = [r[0] for r in df.select(H.decide("s1", "s2", "d1", 0.0)).collect()]
    c = [r[0] for r in df.select(H.decide("s1", "s2", "d1", -0.1)).collect()]
    assert a == b == [3, 3, 0, 2, 0]
    assert c == [3, 0, 0, 2, 0]


def _vec_frame(spark, n=60, d=4, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    return spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in range(n)], "id long, vec array<double>"), x


def test_knn_join_matches_brute_force_in_any_blocks(spark):
    df, x = _vec_frame(spark)
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    exp = {i: list(np.lexsort((np.arange(len(x)), d[i]))[:3]) for i in range(len(x))}
    for cut in ({}, {"pivots": 5, "block_rows": 7, "chunk_rows": 11}, {"pivots": 1, "block_rows": 13}):
        nn = N.knn_join(df, df, 3, qid="id", qvec="vec", exclude_self=True, **cut)
        got = nn.toPandas().sort_values(["qid", "rank"]).groupby("qid")["nid"].apply(list).to_dict()
        assert got == exp


def test_knn_join_ranks_equal_vectors_by_id(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(40)] + [(100, [5.0, 5.0])], "id long, vec array<double>")
    nn = N.knn_join(same.where("id = 100"), same, 3, qid="id", qvec="vec", exclude_self=True, pivots=4, block_rows=9)
    assert [(r["rank"], r.nid) for r in nn.orderBy("rank").collect()] == [(1, 0), (2, 1), (3, 2)]
    assert N.knn_join(same, same.limit(0), 3, qid="id", qvec="vec").count() == 0


def test_knn_join_prunes_clustered_vectors_of_64_dimensions(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(25, 64))
    x = centres[rng.integers(0, 25, 3000)] + 0.15 * rng.normal(size=(3000, 64))
    x[40:60] = x[40]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>")
    counts = {}
    got = N.knn_join(df, df, 5, qid="id", qvec="vec", exclude_self=True, block_rows=100, counts=counts).toPandas()
    got = got.sort_values(["qid", "rank"]).groupby("qid")["nid"].apply(list)
    d = ((x[:, None, :] - x[None, :500, :]) ** 2).sum(-1).T
    for i in range(500):
        d[i, i] = np.inf
        assert got[i] == list(np.lexsort((np.arange(3000), d[i].round(12)))[:5])
    assert counts["distances"] < 0.2 * 3000**2


def test_null_labels_keep_their_rows(spark):
    from connlens.operators import joins as J
    from connlens.operators import sampling as S
    df = spark.createDataFrame([(i, None if i % 5 == 0 else i % 2) for i in range(50)], "id long, label int")
    key = F.col("id")
    split = S.stratified_split(df, key, "label", 0.8)
    assert split.where("label IS NULL").groupBy("split").count().orderBy("split").collect() == [("train", 8), ("val", 2)]
    assert S.kfold_assign(df, key, "label").count() == 50
    assert S.random_oversample(df, key, "label", {1: 30}).count() == 60
    assert J.join_class_weight(df, "label").count() == 50


def test_manifest_status(spark):
    from connlens.operators import joins as J

    def status(expected, actual):
        r = J.manifest_diff(J.names_table(spark, expected), J.names_table(spark, actual)).first()
        return r.status, r.first_mismatch_pos, r.expected_name, r.actual_name
    assert status(["a", "b", "c"], ["x", "b"]) == ("DEVIATION_DETECTED", 0, "a", "x")
    assert status(["a", "b", "c"], ["a", "b"]) == ("INCOMPATIBLE", None, None, None)
    assert status(["a", "b"], ["a", "b"]) == ("COMPATIBLE", None, None, None)
    assert status(["a", "b"], ["b", "a"]) == ("DEVIATION_DETECTED", 0, "a", "b")


def test_smote_uses_each_rows_own_neighbours(spark):
    from connlens.operators import sampling as S
    df, _ = _vec_frame(spark, 6, 2)
    df = df.withColumn("label", F.lit(1))
    plan = S.random_oversample(df, F.col("id"), "label", {1: 60})
    nn = N.knn_join(df, df, 5, qid="id", qvec="vec", exclude_self=True).where("qid <> 2 OR rank <= 1")
    assert N.smote(plan, nn, "id", "vec").count() == 54


def test_smote_points_lie_between_parents(spark):
    from connlens.operators import sampling as S
    df, x = _vec_frame(spark, 20, 3)
    df = df.withColumn("label", F.lit(1))
    plan = S.random_oversample(df, F.col("id"), "label", {1: 50})
    nn = N.knn_join(df, df, 5, qid="id", qvec="vec", exclude_self=True)
    syn = N.smote(plan, nn, "id", "vec").toPandas()
    assert len(syn) == 30
    for _, r in syn.iterrows():
        a, b, s = x[r.base_id], x[r.nid], np.asarray(r.synthetic)
        assert np.allclose(s, a + r.u * (b - a)) and 0 <= r.u < 1


def test_isolation_forest_scores_and_contamination(spark):
    df, _ = _vec_frame(spark, 300, 3)
    model = IF.fit(df, "id", "vec", n_trees=50, psi=64)
    sc = IF.score(df, model, "id", "vec")
    s = sc.toPandas()["score"]
    assert ((s < 0) & (s > -1)).all()
    off = IF.offsets(sc, [0.1])[0.1]
    frac = (s < off).mean()
    assert 0.08 <= frac <= 0.12


def _traffic(seed, n, span):
    rng = np.random.default_rng(seed)
    pick = lambda values: [None if rng.random() < 0.05 else values[int(k)] for k in rng.integers(0, len(values), n)]
    at = rng.integers(0, span, n)
    return [(i, h, s, None if rng.random() < 0.03 else int(t), int(e), o, p)
            for i, h, s, t, e, o, p in zip(range(n), pick([0, 0, 0, 1, 2]), pick(["a", "b"]), at, rng.integers(0, 2, n), pick([7, 8, 9, 10]), pick([80, 443]))]


def _traffic_frame(spark, rows):
    df = spark.createDataFrame(rows, "id long, host long, svc string, t long, err int, src long, port long")
    return df.withColumn("ts", F.timestamp_micros(F.col("t") * 100_000))


@pytest.mark.parametrize("seconds,slices", [(2, 64), (300, 64), (300, 1), (0.1, 7)])
def test_time_window_matches_brute_force(spark, seconds, slices):
    rows = _traffic(4, 400, 36_000 if seconds > 2 else 900)
    df = _traffic_frame(spark, rows)
    got = {r["id"]: r for r in TR.traffic_time_window(df, "id", "ts", "host", "svc", F.col("err") == 1, F.col("err") == 0, seconds, slices).collect()}
    assert len(got) == len(rows)
    inside = lambda a, b: a is None and b is None or a is not None and b is not None and b - 10 * seconds <= a <= b
    for i, h, s, t, *_ in rows:
        own = [r for r in rows if inside(r[3], t)]
        w, v = [r for r in own if r[1] == h], [r for r in own if r[2] == s]
        r = got[i]
        assert (r["count"], r["srv_count"]) == (len(w), len(v))
        assert r["serror_rate"] == pytest.approx(sum(x[4] for x in w) / len(w), abs=1e-6) and r["srv_rerror_rate"] == pytest.approx(sum(1 - x[4] for x in v) / len(v), abs=1e-6)
        assert r["same_srv_rate"] == pytest.approx(sum(x[2] == s for x in w) / len(w), abs=1e-6)


def test_a_hot_service_is_dealt_over_many_window_partitions(spark, monkeypatch):
    """Half of all rows are one service within one window: no (key, slice) holds more than a small part of them."""
    rows = [(k, k % 50, "hot" if k % 2 else f"s{k % 9}", k * 5, 0, 1, 1) for k in range(6000)]
    df = _traffic_frame(spark, rows)
    sizes = []
    plain = TR.Window.partitionBy

    class Spied(TR.Window):
        @staticmethod
        def partitionBy(*cols):
            sizes.append(cols)
            return plain(*cols)

    monkeypatch.setattr(TR, "Window", Spied)
    got = TR.traffic_time_window(df, "id", "ts", "host", "svc", F.col("err") == 1, F.col("err") == 0, 3000).where("id = 5999").first()
    assert got["srv_count"] == 3000 and ("_key", "_slice") in sizes and all("_key" in c[0] or "_block" in c for c in sizes)
    per = df.where("svc = 'hot'").groupBy(F.floor(F.col("t") * 100_000 / (3000 * 1_000_000 // 64))).count().agg(F.max("count")).first()[0]
    assert per < 60


def test_last_n_window_matches_brute_force(spark):
    rows = [r for r in _traffic(5, 500, 72_000) if r[3] is not None]
    got = {r["id"]: r for r in TR.traffic_host_window(_traffic_frame(spark, rows), "id", "ts", "host", "svc", "src", "port", F.col("err") == 1,
                                                      F.col("err") == 0, 10, bucket_seconds=600).collect()}
    assert len(got) == len(rows)
    for dest in {r[1] for r in rows}:
        own = sorted((r for r in rows if r[1] == dest), key=lambda r: (r[3], r[0]))
        for k, r in enumerate(own):
            w = own[max(0, k - 9):k + 1]
            v = [x for x in w if x[2] == r[2]]
            f = got[r[0]]
            assert (f["dst_host_count"], f["dst_host_srv_count"]) == (len(w), len(v))
            assert f["dst_host_serror_rate"] == pytest.approx(sum(x[4] for x in w) / len(w), abs=1e-6)
            assert f["dst_host_same_src_port_rate"] == pytest.approx(sum(x[6] == r[6] for x in w) / len(w), abs=1e-6)
            assert f["dst_host_srv_diff_host_rate"] == pytest.approx(len({x[5] for x in v}) / len(v), abs=1e-6)


def test_traffic_windows_of_an_empty_table(spark):
    df = _traffic_frame(spark, [])
    yes = F.lit(True)
    assert TR.traffic_time_window(df, "id", "ts", "host", "svc", yes, yes, 2).collect() == []
    assert TR.traffic_host_window(df, "id", "ts", "host", "svc", "src", "port", yes, yes).collect() == []


def test_set_operations_join_distinct_labels(spark, capsys):
    from connlens.plans import label_queries as LBL
    for query, join in ((LBL.q_novel_labels_except, "LeftAnti"), (LBL.q_intersect_labels, "LeftSemi")):
        capsys.readouterr()
        query(spark, "/root/testdata/sf0.001").explain("extended")
        plan = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
        sides = plan.split(join, 1)[1]  # a label reaches the join once, not once a row
        assert sides.count("Aggregate [label") >= (2 if join == "LeftAnti" else 1)


def test_a_rank_is_dealt_over_several_buckets_a_partition(spark, monkeypatch):
    from pyspark.sql import Window
    from connlens.operators import ordered as O
    seen = []
    monkeypatch.setattr(O, "bucketize", lambda *a, cut=O.bucketize, **k: seen.append(cut(*a, **k)) or seen[-1])
    rows = spark.range(4000).select((F.col("id") % 3).alias("g"), F.md5(F.col("id").cast("string")).alias("h"))
    want = {(r.h, r.k) for r in rows.select("h", F.row_number().over(Window.partitionBy("g").orderBy("h")).alias("k")).collect()}
    assert {(r.h, r.k) for r in O.row_rank(rows, "h", ["g"], "k").collect()} == want
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert seen[0].select("_pid").distinct().count() >= 8 * parts
