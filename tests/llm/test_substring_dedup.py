import random
from collections import defaultdict
from hashlib import blake2b

import numpy as np

from connlens.llm import substring_dedup as S


def brute_chunks(text):
    """(start, end) in bytes, byte by byte."""
    raw, hits = text.encode(), []
    for i in range(len(raw)):
        h = sum(int(S.GEAR[raw[i - k]]) << k for k in range(min(S.WINDOW, i + 1))) & 0xFFFF
        if h >> (16 - S.CUT_BITS) == 0:
            hits.append(i + 1)
    cuts = [h for k, h in enumerate(hits) if k == 0 or h - hits[k - 1] >= S.LEAST]
    out, at = [], 0
    for c in sorted({*cuts, len(raw)} - {0}):
        while c - at > S.MOST:
            out.append((at, at + S.MOST))
            at += S.MOST
        if c > at:
            out.append((at, c))
        at = c
    return out


def random_text(rng, n, tag=""):
    return " ".join(f"{tag}{rng.choice('abcdefghé')}{rng.randrange(10**rng.randrange(1, 6))}" for _ in range(n))


def test_chunks_match_byte_by_byte_and_do_not_depend_on_the_batch():
    rng = random.Random(1)
    texts = ["", "x", random_text(rng, 300), "aaaa " * 200, "é" * 700, random_text(rng, 50), "\n\n", "same same same " * 30]
    together = S.chunk_texts(texts)
    for i, t in enumerate(texts):
        own = together["text"] == i
        want = brute_chunks(t)
        raw = t.encode()
        assert own.sum() == len(want)
        digests = [tuple(np.frombuffer(blake2b(raw[s:e], digest_size=16).digest(), "<i8")) for s, e in want]
        assert list(zip(together["high"][own], together["low"][own])) == digests
        assert together["at"][own].tolist() == list(range(len(want)))
        assert together["again"][own].tolist() == [d in digests[:k] for k, d in enumerate(digests)]
        assert together["words"][own].sum() == len(t.split())
        if len(want):
            assert together["start"][own][0] == 0 and together["end"][own][-1] == len(t)
            assert (together["start"][own][1:] == together["end"][own][:-1]).all()


def brute_spans(rows, words):
    """The spans by a plain pass over all chunks in reading order."""
    first, out = {}, []
    cut = []
    for i, (_, t) in enumerate(rows):
        raw = (t or "").encode()
        for s, e in brute_chunks(t or ""):
            n = sum(1 for k in range(s, e) if not raw[k:k + 1].isspace() and (k == 0 or raw[k - 1:k].isspace()))
            cut.append((i, s, e, n, raw[s:e]))
            first.setdefault(raw[s:e], i)
    run = []
    for c in [*cut, (None,) * 5]:
        repeat = c[0] is not None and first[c[4]] != c[0]
        if run and not (repeat and c[0] == run[-1][0] and c[1] == run[-1][2]):
            by = defaultdict(int)
            for r in run:
                by[first[r[4]]] += r[3]
            i, raw = run[0][0], (rows[run[0][0]][1]).encode()
            for f, n in by.items():
                if n >= words:
                    out.append((rows[i][0], len(raw[:run[0][1]].decode("utf-8", "ignore")), len(raw[:run[-1][2]].decode("utf-8", "ignore")), sum(r[3] for r in run), rows[f][0], n))
            run = []
        if repeat:
            run.append(c)
    return sorted(map(str, out))


def case():
    rng = random.Random(7)
    passages = [random_text(rng, 60, "p") for _ in range(4)]
    rows = [(i, random_text(rng, rng.randrange(0, 200))) for i in range(60)]
    planted = defaultdict(set)
    for k, p in enumerate(passages):
        for i in rng.sample(range(60), 8):
            words = rows[i][1].split(" ")
            at = rng.randrange(len(words) + 1)
            rows[i] = (i, " ".join([*words[:at], p, *words[at:]]))
            planted[k].add(i)
    return rows, passages, planted


def test_spans_match_brute_force_and_catch_planted_passages(spark, frame):
    rows, _, planted = case()
    df = frame(rows).coalesce(1)
    got = S.spans(df, words=10).collect()
    assert sorted(str(tuple(r)) for r in got) == brute_spans(rows, 10)
    hit = {r.doc_id for r in got} | {r.first_doc_id for r in got}
    want = set().union(*planted.values())
    assert hit <= want and len(hit & want) >= 0.9 * len(want)


def test_insertion_moves_only_nearby_chunks():
    rng = random.Random(3)
    text = random_text(rng, 2000)
    a, b = ({tuple(x) for x in zip(got["high"], got["low"])} for got in (S.chunk_texts([text]), S.chunk_texts([text[:5000] + " inserted words " + text[5000:]])))
    assert len(b - a) <= 4


def test_edge_rows(spark, frame):
    rng = random.Random(5)
    long = random_text(rng, 30000)
    rows = [(1, None), (2, ""), (None, long), (None, long), (3, long + " tail"), (3, "short"), (3, "short")]
    got = S.spans(frame(rows).coalesce(1)).collect()
    assert [(r.doc_id, r.first_doc_id) for r in sorted(got, key=lambda r: str(r.doc_id))] == [(3, None), (None, None)]
    assert all(r.words >= 29990 for r in got)
    assert S.spans(frame([])).count() == 0
    left = S.remove(frame(rows).coalesce(1))
    assert left.columns == ["doc_id", "text", "id", "__row", "group"] and left.count() == 7
    texts = [r.text for r in left.collect()]
    assert texts.count(long) == 1 and None in texts and texts.count("") == 2 and texts.count("short") == 2


def test_own_repetitions_count_only_on_request(frame):
    rng = random.Random(8)
    line = random_text(rng, 80)
    rows = [(1, f"{line} middle {line}")]
    assert S.spans(frame(rows)).count() == 0
    got = S.spans(frame(rows), within=True).collect()
    assert len(got) == 1 and got[0].start > len(line) and S.remove(frame(rows), within=True).first().text.startswith(line)
