import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from connlens.llm import components as C
from connlens.llm import near_dedup as N
from connlens.llm.components import components


def shingles(text):
    w = [x for x in (text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if x]
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def similarity(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both) if both else 0.0


def brute(rows, least=0.8):
    """Class (set of row numbers) of every row."""
    bags = [shingles(t) for _, t in rows]
    top = list(range(len(rows)))

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    by = defaultdict(set)
    for i, b in enumerate(bags):
        for s in b:
            by[s].add(i)
    first = {}
    for i, (_, t) in enumerate(rows):
        top[root(i)] = root(first.setdefault(t or "", i))
    for i, b in enumerate(bags):
        for j in set().union(*[by[s] for s in b]) if b else ():
            if j < i and similarity(bags[i], bags[j]) >= least:
                top[root(i)] = root(j)
    out = defaultdict(list)
    for i in range(len(rows)):
        out[root(i)].append(i)
    return list(out.values())


def expected(rows):
    out = []
    for group in brute(rows):
        ids = [rows[i][0] for i in group]
        least = min((x for x in ids if x is not None), default=None)
        out += [(str(x), str(least), len(group)) for x in ids]
    return sorted(out)


def check(df, rows):
    got = N.classes(df).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.class_size) for r in got) == expected(rows)
    kept = Counter(str(r.class_id) for r in got if r.kept)
    assert len(brute(rows)) == sum(kept.values())


def variant(rng, words, changes):
    w = list(words)
    for _ in range(changes):
        w[rng.randrange(len(w))] = f"new{rng.random()}"
    return " ".join(w)


def test_table_matches_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(docs, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


LONG = " ".join(f"w{i}" for i in range(40000))
EDGES = [(1, None), (2, ""), (3, "  "), (4, "a b"), (5, "a  b"), (6, "a b c"), (None, "x y z q r s"), (None, "x y z q r s"), (8, "x y z q r s"),
         (9, LONG), (10, LONG + " extra"), (11, "same " * 300), (12, "same " * 400), (12, "same " * 400), (13, "same " * 900)]


def families():
    """A large family of near copies, texts that share a passage only, a chain, and families behind one passage."""
    rng = random.Random(4)
    family, passage, other = ([f"{k}{i}" for i in range(n)] for k, n in (("f", 120), ("p", 60), ("o", 80)))
    rows = [(100 + i, variant(rng, family, rng.choice([0, 1, 2, 3]))) for i in range(400)]
    rows += [(1000 + i, " ".join(passage + [f"u{i}_{j}" for j in range(rng.randrange(5, 40))])) for i in range(150)]
    rows += [(2000 + i, " ".join(f"c{j}" for j in range(5 * i, 5 * i + 100))) for i in range(20)]
    rows += [(3000 + i, " ".join(other + [f"g{i // 4}_{j}" for j in range(15)] + [f"v{i}_{j}" for j in range(rng.randrange(0, 9))])) for i in range(80)]
    rng.shuffle(rows)
    return rows


def test_edge_rows_families_chains_and_shared_passages(frame, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 3000)
    monkeypatch.setattr(N, "CENTER_ROWS", 16)
    rows = EDGES + families()
    check(frame(rows), rows)


def test_kept_rows(frame):
    kept = N.kept_rows(frame(EDGES))
    assert kept.columns == ["doc_id", "text", "id", "__row", "group"] and kept.count() == len(brute(EDGES))


def test_empty_table(frame):
    assert N.classes(frame([])).count() == 0 and N.kept_rows(frame([])).count() == 0


def test_signatures_estimate_weighted_similarity():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    a, b = " ".join(words + words[:100]), " ".join(words[:250] + [f"z{i}" for i in range(60)])
    k = 4096
    sig = N.dart_signatures(*N.regions(*N.elements([a, b])), 2, k)
    want = similarity(shingles(a), shingles(b))
    assert abs((sig[0] == sig[1]).mean() - want) < 4 * (want * (1 - want) / k) ** 0.5
    value = np.array([11, 22, 11, 22], np.uint64)
    weight, owner = np.array([0.5, 2.25, 1.5, 0.75]), np.array([0, 0, 1, 1])
    sig = N.dart_signatures(*N.regions(value, weight, owner), 2, k)
    want = (0.5 + 0.75) / (1.5 + 2.25)
    assert abs((sig[0] == sig[1]).mean() - want) < 4 * (want * (1 - want) / k) ** 0.5
    assert rng is not None


@pytest.mark.parametrize("one_task", [0, 10**6])
def test_components(spark, monkeypatch, one_task):
    monkeypatch.setattr(C, "ONE_TASK", one_task)
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(200)] + [(1000, i) for i in range(1001, 1200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    top = {}

    def root(x):
        while top.get(x, x) != x:
            x = top[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        top[y] = x
    assert got == {x: root(x) for x in {v for e in edges if e[0] != e[1] for v in e}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
