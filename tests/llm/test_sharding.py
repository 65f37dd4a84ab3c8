import hashlib
import math
from collections import Counter

import pytest

from connlens.llm import sharding as S


def brute(shards, size):
    num = lambda t: int(hashlib.md5(t.encode()).hexdigest()[:15], 16)
    prefs = [[(num(f"{s}:offset") + j * (num(f"{s}:skip") % (size - 1) + 1)) % size for j in range(size)] for s in shards]
    owner = [None] * size
    turn = 0
    while None in owner:
        i = turn % len(shards)
        owner[next(p for p in prefs[i] if owner[p] is None)] = i
        turn += 1
    return owner


@pytest.mark.parametrize("n,size", [(1, 2), (3, 7), (10, 251), (7, 1009)])
def test_table_matches_brute_force(n, size):
    names = [f"s{i}" for i in range(n)]
    assert S.fill_table(names, size) == brute(names, size)


def test_shares_are_even_and_removal_moves_little():
    full = S.fill_table(S.SHARDS)
    counts = Counter(full)
    assert max(counts.values()) - min(counts.values()) <= 1
    less = S.fill_table(S.SHARDS[:-1])
    moved = sum(a != b for a, b in zip(full, less) if a != 63)
    assert moved / len(full) < 0.1
    heavy = Counter(S.fill_table(["a", "b"], 1009, [3, 1]))
    assert math.isclose(heavy[0] / 1009, 0.75, abs_tol=0.01)


def test_bad_arguments():
    for args in ((["a", "a"], 7), ([], 7), (["a", "b"], 8), (["a", "b", "c"], 2)):
        with pytest.raises(ValueError):
            S.fill_table(*args)


def test_place(spark, frame):
    rows = [(None, "x"), (1, None), (1, "y"), (2, "z" * 100000), (-5, "")]
    got = S.place(frame(rows)).collect()
    owner = S.fill_table(S.SHARDS)
    for r in got:
        key = "" if r.doc_id is None else str(r.doc_id)
        slot = int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % S.TABLE_SIZE
        assert (r.slot, r.shard) == (slot, owner[slot])
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    assert S.place(frame([])).count() == 0
    plan = S.place(frame(rows))._jdf.queryExecution().toString()
    assert "Python" not in plan and "BroadcastHashJoin" in plan


def test_write_shards_keeps_every_row(spark, frame, tmp_path):
    df = frame([(i, f"t{i}") for i in range(500)])
    S.write_shards(df, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted(r.doc_id for r in back.select("row.doc_id").collect()) == list(range(500))
