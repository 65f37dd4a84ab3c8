"""Hard negatives against brute force over all rows."""

import itertools
import math
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from connlens.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, row string, block long"


def brute(rows):
    own = []
    for i, vec, label in rows:
        if label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        own.append((i, [math.floor(256 * float(np.float32(x))) for x in vec], (label + 1) % 10 if i is not None and i % 7 == 0 else label))
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for n, (a, va, la) in enumerate(own):
        if a is None or a % 100:
            continue
        scored = [(sum(x * y for x, y in zip(va, vb)), b, lb) for m, (b, vb, lb) in enumerate(own) if m != n]
        others = sorted((r for r in scored if r[2] != la), key=order)
        for ps, p, _ in sorted((r for r in scored if r[2] == la), key=order)[:5]:
            fits = [(s, b) for s, b, _ in others if 30 * ps <= 100 * s <= 90 * ps][:10]
            out += [(a, p, rank, b, ps, s) for rank, (s, b) in enumerate(fits, 1)]
    return Counter(out)


def clustered(n, dims=12, seed=1):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(9, dims))
    which = rng.integers(0, 9, n)
    x = (centers[which] + 0.3 * rng.normal(size=(n, dims))).astype(np.float32)
    return [(i, x[i].tolist(), int(which[i]) if rng.random() < 0.5 else int(rng.integers(0, 10))) for i in range(n)]


def run(spark, rows, **more):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    label = H.F.when(H.F.col("vec_id") % 7 == 0, (H.F.col("label") + 1) % 10).otherwise(H.F.col("label"))
    return Counter(tuple(r) for r in H.mine(df, H.F.col("id") % 100 == 0, label, **more).collect())


@pytest.mark.parametrize("size", [16, 1024])
def test_results_equal_brute_force(spark, size):
    rows = clustered(900)
    assert run(spark, rows, size=size) == brute(rows)


def test_nulls_ties_copies_and_short_vectors_equal_brute_force_and_sql(spark, monkeypatch):
    monkeypatch.setattr(H, "CHUNK", 4)
    rows = clustered(300, 5, 2)
    rows += [(400, [0.5, 0.5, 0.1, 0.0, 0.0], 1)] * 2 + [(k, [0.5, 0.5, 0.1, 0.0, 0.0], k % 2) for k in range(401, 520)]
    rows += [(None, [0.4] * 5, 1), (None, [0.4] * 5, 2), (600, None, 1), (700, [0.1] * 5, None), (800, [0.1, None, 0.1, 0.1, 0.1], 1), (900, [float("nan")] * 5, 1),
             (1000, [float("inf")] * 5, 1), (1100, [0.0] * 5, 1), (1200, [-0.5] * 5, 3)]
    want = brute(rows)
    assert run(spark, rows, size=8) == want
    con = duckdb.connect()
    con.register("t", pa.table({"vec_id": [r[0] for r in rows], "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float32())), "label": pa.array([r[2] for r in rows], pa.int32())}))
    con.execute("CREATE VIEW embeddings AS SELECT * FROM t")
    assert Counter(con.execute(H.REPORT_SQL).fetchall()) == want
    assert run(spark, [*rows, (1300, [1.0, 1.0], 4), (1301, [1.0], 4), (1302, [], 5)], size=8) == brute([(i, v and [*v, *[0.0] * (5 - len(v))] if v != [] else [0.0] * 5, label) for i, v, label in [*rows, (1300, [1.0, 1.0], 4), (1301, [1.0], 4), (1302, [], 5)]])


def test_one_vector_holding_most_rows(spark):
    rows = [(i, [0.3, 0.2], 1) for i in range(3000)] + clustered(400, 2, 4)
    rows = [(i, v, label) for i, (_, v, label) in enumerate(rows)]
    assert run(spark, rows, size=64) == brute(rows)


def test_the_curve_visits_every_cell_by_single_steps():
    for d, bits in ((2, 3), (3, 2), (4, 2), (5, 1)):
        cells = np.array(list(itertools.product(range(2**bits), repeat=d)))
        place = H.hilbert(cells, bits)
        assert sorted(place.tolist()) == list(range(len(cells)))
        path = cells[np.argsort(place)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_bounds_hold_and_prune_clustered_blocks(spark):
    rows = clustered(4000, 8, 6)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    own = H.quantised(df, "vec_id", "embedding", H.F.col("label")).cache()
    n, mean, spread, largest = H.spreads(own)
    x = np.array([r["vec"] for r in own.orderBy("row").collect()], float)
    assert n == 4000 and np.allclose(mean, x.mean(0)) and np.allclose(spread, x.std(0)) and (largest == np.abs(x).max(0)).all()
    blocks = H.write_blocks(own, n, mean, spread, largest, 64).collect()
    assert sum(b["n"] for b in blocks) == 4000 and max(b["n"] for b in blocks) == 64
    low, high = H.bounds(x[:40], np.array([b["lo"] for b in blocks], float), np.array([b["hi"] for b in blocks], float))
    for k, b in enumerate(blocks):
        score = x[:40] @ np.frombuffer(b["vectors"], np.int16).reshape(b["n"], 8).T
        assert (low[:, k] <= score.min(1)).all() and (score.max(1) <= high[:, k]).all()
    best = np.sort(x[:40] @ x.T, axis=1)[:, -6]
    assert (high >= best[:, None]).mean() < 0.6  # blocks that a search for the best rows must read
    anchors = own.where("id % 100 = 0")
    everything = [H.F.array(H.F.lit(v).cast("long")).alias(c) for c, v in (("lo", -(2**62)), ("hi", 2**62))]
    reads = []
    plain = H._read
    H._read = lambda pairs, *a: reads.append(pairs.count()) or plain(pairs, *a)
    try:
        H.search(anchors.select("row", "label", "vec", *everything), H.write_blocks(own, n, mean, spread, largest, 64), 8, True, 5, (40, len(blocks))).collect()
    finally:
        H._read = plain
    assert sum(reads) < 0.2 * 40 * len(blocks)


def test_empty_tables(spark):
    assert run(spark, []) == Counter()
    assert run(spark, [(100, None, 1), (101, [1.0], None)]) == Counter()
    assert run(spark, [(100, [1.0], 1)]) == Counter()


def test_scores_that_doubles_cannot_hold_are_refused(spark):
    with pytest.raises(ValueError):
        run(spark, [(100, [1e6, 1e6], 1), (101, [1e6, 1e6], 2)])
