import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from connlens.llm import queries
from connlens.llm import toxicity as T

WORDS = [f"word{i}" for i in range(300)]
BAD = ["vile", "foul", "grim"]


def corpus(n, seed):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        sentences = [" ".join(rng.choices(WORDS, k=8)) for _ in range(rng.randrange(1, 12))]
        toxic = rng.random() < 0.3
        if toxic:
            k = rng.randrange(len(sentences))
            sentences[k] += " " + rng.choice(BAD).title()
        docs.append((i, ". ".join(sentences) + "."))
        labels.append((i, 0, int(toxic)))
    return docs, labels


def test_learns_words_and_finds_the_sentence(spark, frame):
    docs, labels = corpus(800, 1)
    got = {r.doc_id: r for r in T.report(frame(docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert len(got) == 800
    for i, text in docs:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= got[i].score <= 1 and got[i].predicted == (got[i].score >= 0.5)
    held = [(i, t) for i, t in docs if got[i].held_out]
    assert sum(got[i].predicted == labels[i][2] for i, _ in held) >= 0.97 * len(held)
    for i, text in held:
        if got[i].predicted and labels[i][2]:
            assert any(b in text[got[i].worst_start:got[i].worst_end].lower() for b in BAD) and got[i].n_offending == 1


def test_noisy_or_matches_a_plain_computation():
    docs, labels = corpus(300, 2)
    texts = [t for _, t in docs]
    feature, sentence, text, start, end = T.featurise(texts)
    model = T.train(feature, sentence, text, np.array([y for *_, y in labels]) > 0)
    scores, found = model.score(texts)
    for k, t in enumerate(texts[:50]):
        p = 1.0
        for s in t.split("."):
            if s.strip():
                own, _ = model.score([s])
                p *= 1 - own[0]
        assert abs(scores[k] - (1 - p)) < 1e-9
        assert [t.encode()[s:e].decode() for s, e, _ in found[k]] == [s.strip() for s in t.split(".") if s.strip()]


def test_edge_rows_and_degenerate_labels(spark, frame):
    rows = [(1, None), (2, ""), (3, "..!!"), (None, "vile words"), (4, "vile " * 50000), (4, "vile " * 50000), (5, "é vile")]
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for labels in (none, spark.createDataFrame([(1, 0, 1), (7, 1, None), (1, 0, 0)], "doc_id long, quality int, toxic int")):
        got = T.report(frame(rows), labels).collect()
        assert len(got) == 7 and len({r.score for r in got}) == 1
    docs, labels = corpus(300, 3)
    table = spark.createDataFrame(labels + labels[:20], "doc_id long, quality int, toxic int")
    got = T.score(frame(rows), T.fit(frame(docs), table)).collect()
    by = {(r.doc_id, r.n_sentences): r for r in got}
    assert [by[i, 0].score for i in (1, 2, 3)] == [0, 0, 0] and by[1, 0].worst_start is None
    assert by[None, 1].predicted == by[4, 1].predicted == by[5, 1].predicted == 1
    kept = T.drop_toxic(frame(rows + [(9, "word1 word2.")]), frame(docs).limit(0).select("doc_id").withColumn("toxic", F.lit(1)))
    assert kept.count() == 0 or kept.columns == ["doc_id", "text", "id", "__row", "group"]
    assert T.report(frame([]), none).count() == 0


def test_training_is_bounded_and_repeats(spark, frame):
    docs, labels = corpus(200, 4)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert T.training_rows(frame(docs), table, "doc_id", "text", 50).count() == 50
    a, b = (T.fit(frame(docs).repartition(n), table) for n in (1, 7))
    assert np.array_equal(a.weights, b.weights) and a.bias == b.bias


def test_held_out_accuracy_on_the_table(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op8_toxicity(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    n, right = got.agg(F.count("*"), F.sum((F.col("predicted") == F.col("toxic")).cast("int"))).first()
    assert n > 500 and right >= 0.93 * n


def test_long_clean_texts_stay_and_an_offending_sentence_in_them_is_found(spark, frame):
    docs, labels = corpus(800, 3)
    rng = random.Random(9)
    clean = [" ".join(rng.choices(WORDS, k=8)) for _ in range(30_000)]
    long = [(5000 + n, ". ".join(clean[:n]) + ".") for n in (400, 3000, 10_000, 30_000)]
    toxic = [(6000 + n, ". ".join([*clean[:n // 2], clean[0] + " vile foul", *clean[n // 2:n]]) + ".") for n in (400, 10_000)]
    model = T.fit(frame(docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {r.doc_id: r for r in T.score(frame(long + toxic), model).collect()}
    assert [got[i].predicted for i, _ in long] == [0] * 4
    assert [got[i].predicted for i, _ in toxic] == [1] * 2 and all("vile foul" in t[got[i].worst_start:got[i].worst_end] for i, t in toxic)
    assert got[35_000].score == got[15_000].score or abs(got[35_000].score - got[15_000].score) < 0.02  # length alone adds nothing
    kept = T.drop_toxic(frame(long + toxic + docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert {i for i, _ in long} <= {r.doc_id for r in kept.select("doc_id").collect()}
