import hashlib
import random

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from connlens.llm import bpe, queries
from connlens.llm.word_bpe import WordCodec

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
CODEC, LIBRARY = bpe.BytePairCodec(BYTES), Tokenizer.from_file(BYTES)
ODD = list("ab Ab'st  \n\t  \x1c\x85é̀ΣςİŐ１二\U0001f600.,!9_漢字aaaa") + ["'re", "<|endoftext|>", "<|startoftext|>", "  ", "\r\n", "​", "<|end"]


def packed(ids):
    return np.array(ids, "<u4").tobytes()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(ODD), st.text(max_size=6)), max_size=30).map("".join))
def test_same_as_library(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    assert CODEC.encode(text) == packed(want)
    assert CODEC.decode(packed(want)) == LIBRARY.decode(want, skip_special_tokens=False)


def test_long_words_and_stale_entries():
    random.seed(3)
    for text in ("a" * 5000, "ab" * 3000, "".join(random.choices("abc", k=4000)), "漢字" * 2000, " " * 999 + "x"):
        assert CODEC.encode(text) == packed(LIBRARY.encode(text, add_special_tokens=False).ids)


def test_cache_turns_over(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_CHUNKS", 7)
    own = bpe.BytePairCodec(BYTES)
    text = " ".join(f"word{i % 13} x{i}" for i in range(300))
    assert own.encode(text) == packed(LIBRARY.encode(text, add_special_tokens=False).ids)
    assert len(own.new) <= 7


def test_rows(frame):
    rows = [(1, "hello world"), (None, "x"), (2, None), (3, ""), (1, "hello world"), (4, "é " * 60000)]
    got = bpe.encode(frame(rows), BYTES).select("doc_id", "n_tokens", "ids", bpe.decoded(F.col("ids"), BYTES).alias("t")).collect()
    want = [(i, t or "") for i, t in rows]
    assert sorted(((r.doc_id, r.t) for r in got), key=str) == sorted(want, key=str)
    for r in got:
        assert bytes(r.ids) == packed(LIBRARY.encode(r.t, add_special_tokens=False).ids) and r.n_tokens == len(r.ids) // 4
    assert bpe.encode(frame([]), BYTES).count() == 0


def test_query_against_library(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in queries.op5_bpe(spark, "/root/testdata/sf0.001").collect():
        ids = LIBRARY.encode(docs[r.doc_id], add_special_tokens=False).ids
        text = LIBRARY.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(packed(ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


WORD_CODEC, WORD_LIBRARY = WordCodec(WORDS), Tokenizer.from_file(WORDS)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.one_of(st.sampled_from(ODD), st.text(max_size=6)), max_size=30).map("".join), max_size=4))
def test_word_ids_same_as_library(texts):
    assert WORD_CODEC.encode_all(texts) == [packed(WORD_LIBRARY.encode(t, add_special_tokens=False).ids) for t in texts]
