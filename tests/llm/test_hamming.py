import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from connlens.llm import hamming as H


def brute(index, queries, k):
    out = []
    for q, c in queries:
        far = sorted((bin(int.from_bytes(c.ljust(9, b"\0"), "big") ^ int.from_bytes(d.ljust(9, b"\0"), "big")).count("1"), i is None, i or 0) for i, d in index)
        out += [(q, r + 1, None if none else i, x) for r, (x, none, i) in enumerate(far[:k])]
    return sorted(map(str, out))


def frame(spark, rows):
    return spark.createDataFrame([(i, bytearray(c)) for i, c in rows], "id long, code binary")


@pytest.mark.parametrize("block_rows,chunk_rows", [(1 << 18, 1 << 15), (40, 3)])
def test_search_matches_brute_force(spark, block_rows, chunk_rows):
    rng = random.Random(4)
    centre = [rng.randbytes(8) for _ in range(5)]
    rows = []
    for i in range(600):
        c = bytearray(rng.choice(centre))
        for _ in range(rng.randrange(12)):
            c[rng.randrange(8)] ^= 1 << rng.randrange(8)
        rows.append((i, bytes(c)))
    rows += [(i, centre[0]) for i in range(600, 1000)] + [(None, centre[1]), (7, rows[7][1])]
    asked = [r for r in rows if r[0] is not None and r[0] % 50 == 0]
    got = H.search(frame(spark, rows), frame(spark, asked), 10, block_rows, chunk_rows).collect()
    assert sorted(str(tuple(r)) for r in got) == brute(rows, asked, 10)


def test_search_stops_early_and_stays_exact():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 256, (20000, 8), dtype=np.uint8)
    codes[:50] = codes[50] ^ (rng.random((50, 8)) < 0.05)
    index, ids = H.MultiIndex(codes), np.arange(20000)
    for q in (0, 49, 777):
        for k in (1, 10):
            found, far, met = index.search(codes[q], ids, k)
            d = np.bitwise_count(codes ^ codes[q]).sum(1)
            want = np.lexsort((ids, d))[:k]
            assert found.tolist() == want.tolist() and far.tolist() == d[want].tolist()
            assert met < 20000
    assert index.search(codes[0], ids, 1)[2] < 2000


@pytest.mark.parametrize("segments", [1, 2, 3, 5, 9])
def test_any_segments(segments):
    rng = np.random.default_rng(segments)
    codes = rng.integers(0, 256, (300, 2), dtype=np.uint8)
    index, ids = H.MultiIndex(codes, segments), np.arange(300)[::-1].copy()
    for q in range(0, 300, 37):
        d = np.bitwise_count(codes ^ codes[q]).sum(1)
        found, far, _ = index.search(codes[q], ids, 7)
        assert found.tolist() == np.lexsort((ids, d))[:7].tolist() and (np.diff(far) >= 0).all()


def test_codes_and_edge_rows(spark):
    df = spark.createDataFrame([(1, [1.0, -1.0, 0.5], "a", 3), (2, None, "b", 4), (None, [float("nan"), None, 2.0], "c", 5), (4, [], "d", 6), (5, [1.0] * 20, "e", 7)],
                               "vec_id long, embedding array<float>, code string, id int")
    got = {r.id: bytes(r.code) for r in H.sign_codes(df, "vec_id", "embedding").collect()}
    assert got == {1: b"\xa0", None: b"\x20", 4: b"", 5: b"\xff\xff\xf0"}
    codes = H.sign_codes(df, "vec_id", "embedding")
    found = H.search(codes, codes.where("id in (1, 4)"), 10)
    assert found.groupBy("query_id").agg(F.count("*")).collect() and found.count() == 8
    empty = frame(spark, [])
    assert H.search(empty, empty).count() == 0 and H.search(empty, frame(spark, [(1, b"ab")])).count() == 0
