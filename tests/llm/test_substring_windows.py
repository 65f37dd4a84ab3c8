"""Passages that chunks alone miss: found by the registered settings of op1_substring_dedup."""

import random

from connlens.llm import substring_dedup as S
from connlens.llm import queries

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def plain(rng, n, least=1, most=9):
    return ["".join(rng.choices(LETTERS, k=rng.randrange(least, most))) for _ in range(n)]


def shared_words(a, b):
    """The most words of a in one run that b has too."""
    a, b, best = a.split(), f" {' '.join(b.split())} ", 0
    for i in range(len(a)):
        while i + best < len(a) and f" {' '.join(a[i:i + best + 1])} " in b:
            best += 1
    return best


def found(spark, tmp_path, rows):
    """The ids of op1's rows with their texts' (first) ids, over a table of these rows."""
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    return queries.op1_substring_dedup(spark, str(tmp_path)).collect()


def test_a_passage_whose_halves_were_met_apart_is_found(spark, tmp_path):
    rng, rows, want = random.Random(11), [], set()
    for k in range(60):
        p = plain(rng, 52)
        halves = p[:26], p[26:], p, p
        rows += [(4 * k + i, " ".join(plain(rng, 60) + h + plain(rng, 60))) for i, h in enumerate(halves)]
        want.add(4 * k + 3)
    got = found(spark, tmp_path, rows)
    assert want <= {r.doc_id for r in got}
    texts = dict(rows)
    assert all(r.shared_words >= 18 and shared_words(texts[r.doc_id], texts[r.first_doc_id]) >= 18 for r in got)


def test_every_passage_of_51_words_is_found(spark, tmp_path):
    rng, rows = random.Random(12), []
    for k in range(400):
        p, (least, most) = " ".join(plain(rng, 51 + k % 10, *rng.choice([(1, 9), (3, 6), (6, 12)]))), rng.choice([("", ""), ("“", "”"), ("(x", "é).")])
        rows += [(2 * k, f"{' '.join(plain(rng, rng.randrange(40)))} {p} {' '.join(plain(rng, rng.randrange(40)))}"),
                 (2 * k + 1, f"{' '.join(plain(rng, rng.randrange(40)))} {least}{p}{most} {' '.join(plain(rng, rng.randrange(40)))}")]
    got = found(spark, tmp_path, rows)
    texts = dict(rows)
    want = {(i, i - 1) for i in range(1, 800, 2)}
    assert all(shared_words(texts[i], texts[j]) >= 49 for i, j in want)
    assert {(r.doc_id, r.first_doc_id) for r in got} == want
    for r in got:
        span = texts[r.doc_id][r.start:r.end]
        assert r.words >= r.shared_words >= 18 and span in texts[r.first_doc_id]


def test_windows_match_a_plain_computation():
    rng = random.Random(13)
    texts = ["", "one two", " ".join(plain(rng, 300)), "same " * 300, "a b c d e " * 60, " ".join(plain(rng, 49)), "é\t" + "  ".join(plain(rng, 90)), " ".join(plain(rng, 48))]
    got = S.window_texts(texts, 18, 51)
    for i, t in enumerate(texts):
        own = got["text"] == i
        at = got["before"][own].tolist()
        words = t.split()
        for j, s, e in zip(at, got["start"][own], got["end"][own]):
            assert t[s:e].split() == words[j:j + 18] and t[s:e].strip() == t[s:e]
        for lo in range(len(words) - 48):  # each passage of 49 whole words has a window
            assert any(lo <= j <= lo + 31 for j in at)
        assert len(set(got["at"][own])) == len(at) <= max(0, len(words) - 48) // 6 + 2


def test_copies_of_text_without_blanks_are_found(spark, tmp_path):
    rng = random.Random(14)
    chinese, encoded, other = ("".join(rng.choices([chr(c) for c in range(0x4E00, 0x4F00)], k=400)), "".join(rng.choices(LETTERS, k=900)), "".join(rng.choices(LETTERS, k=900)))
    got = found(spark, tmp_path, [(0, chinese), (1, encoded), (2, other), (3, f"{chinese}。"), (4, encoded)])
    assert {(r.doc_id, r.first_doc_id) for r in got} == {(3, 0), (4, 1)}
    assert all(r.end - r.start >= 300 for r in got)


def test_the_least_id_keeps_a_passage_whatever_the_files(spark):
    rng = random.Random(12)
    shared = [" ".join(f"s{rng.randrange(10**6)}" for _ in range(60)) for _ in range(6)]
    rows = [(i, " ".join([f"w{rng.randrange(10**6)}" for _ in range(20)] + [rng.choice(shared)] + [f"w{rng.randrange(10**6)}" for _ in range(20)])) for i in range(120)]
    found = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(seed * 3 + 1)
        found.add(tuple(sorted(tuple(r) for r in S.spans(df, passage=S.PASSAGE).collect())))
    assert len(found) == 1
    firsts = {min(i for i, t in rows if p in t) for p in shared}
    rest = found.pop()
    # windows at a passage's torn edges may be kept by a later text; the passage itself is the first one's
    assert {r[4] for r in rest if r[5] >= 40} == firsts and {i for i, _ in rows} - firsts <= {r[0] for r in rest}
