"""Token counts against the tokenizers library on whole texts."""

import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from connlens.llm import token_counts as T

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
NASTY = ["don't", "it's", "''s", "x's1", "<|endoftext|>", "<|startoftext|>", "<|endof", "text|>", "a|b", "ﬁ", "é", "é", "İ", "ΣΑΣ", "日本語",
         "、", "1234", "½", "٣", "_", "...", " ", "\x1c", " ", "\t", "\n\n", " ", "  ", "🙂", "👩‍👩", "각", "가", "THE", "word", "≠"]


def texts():
    rng = random.Random(7)
    out = ["".join(rng.choice(NASTY) + rng.choice(["", " ", ""]) for _ in range(rng.randrange(1, 300))) for _ in range(60)]
    return [*out, "", None, " ", "a" * 700, "the quick " * 200, "日" * 500 + " x" + "本" * 90, "''" * 300, "<|endoftext|>" * 50, "7" * 400, "a" * 300 + "1" + "b" * 300]


@pytest.mark.parametrize("path", [WORD, BYTE])
@pytest.mark.parametrize("chunk,overlap", [(40, 3), (16, 16), (T.CHUNK, T.OVERLAP)])
def test_counts_equal_the_library(spark, frame, path, chunk, overlap):
    whole, rows = Tokenizer.from_file(path), list(enumerate(texts()))
    got = T.token_counts(frame(rows), path, chunk=chunk, overlap=overlap, limit=100).collect()
    want = {i: (len((t or "").encode()), n := len(whole.encode(t or "", add_special_tokens=False).ids), n > 100) for i, t in rows}
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == want and len(got) == len(rows)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(NASTY) | st.text(max_size=3), max_size=14).map("".join))
def test_tokens_on_each_side_of_a_cut_do_not_depend_on_the_other(text):
    for path in (WORD, BYTE):
        own = T.counter(path).library
        whole = own.encode(text, add_special_tokens=False).ids
        for p in T.cuts(text):
            assert own.encode(text[:p], add_special_tokens=False).ids + own.encode(text[p:], add_special_tokens=False).ids == whole


def test_a_long_text_is_spread_and_only_bad_seams_are_widened(spark, frame, monkeypatch):
    rounds = []
    plain = T._widened
    monkeypatch.setattr(T, "_widened", lambda *a: rounds.append(sorted((r["row"], r["left"]) for r in a[1].collect())) or plain(*a))
    run = "b" * 210  # spans the overlaps of the third chunk and the whole of the fourth
    text = "one two " * 25 + run + " three four" * 40
    got = T.token_counts(frame([(1, text), (2, "x y " * 100)]), WORD, chunk=100, overlap=20).collect()
    own = T.counter(WORD)
    assert {r["doc_id"]: r["n_tokens"] for r in got} == {1: own.counts([text])[0], 2: own.counts(["x y " * 100])[0]}
    assert len(rounds) > 2 and all(len(r) < 4 for r in rounds) and len({row for r in rounds for row, _ in r}) == 1


def test_a_widening_round_does_not_shuffle_the_texts_of_all_chunks(spark, frame, monkeypatch):
    class Seen(Exception):
        pass

    plain = T._widened

    def widened(*args):
        raise Seen(plain(*args)[0]._jdf.queryExecution().sparkPlan().toString())

    monkeypatch.setattr(T, "_widened", widened)
    rng = random.Random(3)
    others = [(i, " ".join("%x" % rng.getrandbits(32) for _ in range(300))) for i in range(2, 30)]  # 75 kB, hardly compressible
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16k")
    try:
        with pytest.raises(Seen) as plan:
            T.token_counts(frame([(1, "x" * 500), *others]), WORD, chunk=100, overlap=40).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    by_chunk = [line for line in str(plan.value).splitlines() if "Join [row" in line and ", b#" in line]
    assert len(by_chunk) == 1 and "BroadcastHashJoin" in by_chunk[0]


def test_null_and_repeated_ids_and_an_empty_table(spark, frame):
    rows = [(None, "a b"), (3, "c"), (3, "c"), (None, "d " * 200)]
    got = sorted(((r[0], r[2]) for r in T.token_counts(frame(rows), WORD, chunk=50, overlap=10).collect()), key=str)
    assert got == sorted([(None, 2), (3, 1), (3, 1), (None, 200)], key=str)
    assert T.token_counts(frame([]), WORD).collect() == []


def test_other_kinds_of_tokenizer_files_are_refused(tmp_path):
    import json

    spec = json.load(open(WORD))
    spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = r"\S+"
    (tmp_path / "t.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        T.Counter(str(tmp_path / "t.json"))
