import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline as C
from connlens.llm import toxicity
from connlens.session import materialize
from tests.llm.test_near_dedup import brute as similar
from tests.llm.test_packing import check_placement
from tests.llm.test_secrets import base

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in C.STAGES:
        out.append(materialize(stage(spark, out[-1], SF), name))
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns(stages):
    for df in stages[1:5]:
        assert df.dtypes == stages[0].dtypes


def test_toxicity(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scores = {r.doc_id: r.score for r in toxicity.report(stages[0], labels).collect()}
    before, after = rows(stages[0]), rows(stages[1])
    assert set(after) == {i for i, s in scores.items() if s < 0.5} and all(before[i] == r for i, r in after.items())
    assert 0 < len(before) - len(after) < 0.3 * len(before)


def test_exact_dedup(stages):
    before, after = rows(stages[1]), rows(stages[2])
    first = {}
    for i in sorted(before):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", before[i].text or ""), i)
    assert set(after) == set(first.values()) and all(before[i] == r for i, r in after.items())


def test_near_dedup(stages):
    before, after = rows(stages[2]), rows(stages[3])
    listed = [(i, r.text) for i, r in sorted(before.items())]
    assert set(after) == {min(listed[k][0] for k in group) for group in similar(listed)} and all(before[i] == r for i, r in after.items())


def test_secret_scan(stages):
    before, after = rows(stages[3]), rows(stages[4])
    assert set(before) == set(after)
    for i, r in after.items():
        spans = base(before[i].text)
        assert r.n_chars == len(r.text) and (r.lang, r.source) == (before[i].lang, before[i].source)
        assert all(before[i].text[s:e] not in r.text for s, _, e in spans)
        if not spans and not re.search(r"[A-Za-z0-9+/_-]{20}", before[i].text):
            assert r.text == before[i].text


def test_packing(stages):
    got, docs = stages[5].collect(), rows(stages[4])
    check_placement(got, 4096)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    total = {i: len(library.encode(r.text, add_special_tokens=False).ids) + 1 for i, r in docs.items()}
    by = {}
    for r in got:
        by[r.doc_id] = by.get(r.doc_id, 0) + r.length
    assert by == total


def test_registered_run(spark, stages):
    assert __spark_entry__.queries()["pipeline"] is C.run and "pipeline" not in __spark_entry__.oracle_sql()
    got = C.run(spark, SF)
    assert got.count() == stages[5].count()
    keys = [F.sum("length"), F.sum("ids_crc32")]
    assert got.agg(*keys).first() == stages[5].agg(*keys).first()
