import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from connlens.llm import packing as P
from connlens.llm import queries

WORDS = public_tokenizers.path("word_bpe_49k.json")


def check_placement(rows, most):
    seqs = defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
    for inside in seqs.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at and length > 0
            at += length
        assert at <= most
    return len(seqs)


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds_and_packing_is_tight(rule):
    rng = np.random.default_rng(1)
    lengths = np.minimum(100, rng.geometric(0.04, 3000))
    place, offset = P.best_fit(lengths, (100, 5, 10000), rule)
    for b in range(place.max() + 1):
        own = lengths[place == b]
        assert own.sum() <= 100 and len(own) <= 5 and (own**2).sum() <= 10000
    with pytest.raises(ValueError):
        P.best_fit(np.array([101]), (100, 5, 10**6))
    small = np.minimum(100, rng.geometric(0.05, 3000))
    place, _ = P.best_fit(small, (100, 1000, 10**6), rule)
    assert place.max() + 1 <= -(-small.sum() // 100) * 1.02 + 1


def test_capacities_of_documents_and_attention_bind():
    place, _ = P.best_fit(np.full(12, 10), (1000, 3, 10**6))
    assert place.max() + 1 == 4
    place, _ = P.best_fit(np.full(12, 10), (1000, 100, 200))
    assert place.max() + 1 == 6
    place, _ = P.best_fit(np.array([], int), (10, 10, 10))
    assert len(place) == 0


def test_rows(spark, frame):
    rows = [(1, "hello world"), (None, "x y"), (2, None), (3, ""), (1, "hello world"), (4, "word " * 9000)]
    library = Tokenizer.from_file(WORDS)
    parts = P.pack(P.pieces(frame(rows), WORDS, with_ids=True), group_rows=4)
    got = parts.collect()
    check_placement(got, 4096)
    assert sorted((str(r.doc_id), r.piece, r.start, r.length) for r in got if r.doc_id == 4) == [("4", 0, 0, 4096), ("4", 1, 4096, 4096), ("4", 2, 8192, 809)]
    assert sorted(r.length for r in got if r.doc_id != 4) == [1, 1, 3, 3, 3]
    want = np.array(library.encode("hello world", add_special_tokens=False).ids + [1], "<u4").tobytes()
    assert [r.ids_crc32 for r in got if r.doc_id == 1] == [zlib.crc32(want)] * 2
    whole = {r.sequence_id: bytes(r.ids) for r in P.sequences(parts).collect()}
    for r in got:
        assert whole[r.sequence_id][4 * r.offset:4 * (r.offset + r.length)] == bytes(r.ids)
    assert P.pack(P.pieces(frame([]), WORDS)).count() == 0


def test_query_against_library(spark):
    sf = "/root/testdata/sf0.001"
    library = Tokenizer.from_file(WORDS)
    want = set()
    for d in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = library.encode(d.text or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 4096):
            part = ids[k:k + 4096]
            want.add((d.doc_id, k // 4096, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    got = queries.op9_packing(spark, sf).collect()
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want)
    tokens = sum(r.length for r in got)
    assert check_placement(got, 4096) <= -(-tokens // 4096) * 1.02 + 1
