"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  A sentence's score is a logistic function of the words in it (lower-cased,
hashed), and a document's is the noisy-or of its sentences' scores: 1 - prod(1 - p).  The weights are learned
from document labels alone, by descending the noisy-or likelihood; so single sentences come out as the reason
for a document's score, and are reported.

Every sentence, the most harmless too, has a score above 0, so the plain noisy-or of a text grows with its length
alone.  Sentences below 0.5 therefore count as ``MOST_SENTENCES`` at most: in a text of n > MOST_SENTENCES their
factors (1 - p) are taken to the power MOST_SENTENCES / n.  Offending sentences, of 0.5 or more, count in full.

Training uses at most ``train_rows`` labelled documents (those with the smallest md5 of the id): the bound is
the only sampling here.  Scoring covers every whole text.

Defined results: a null or empty text, or one without words, has no sentence and the score 0; a null id is held
out; repeated rows score alike; a null label is no label, of several labels of one id the largest counts; with
labels of one class only, or none, every text has the score k / (n + 1), k of the n labels being toxic (so nothing
is toxic without labels); an empty table gives an empty result; labels, ids and other columns are no inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from connlens.llm.bpe import slices, tidy
from connlens.llm.bytetext import joined, span_hashes, words
from connlens.session import ship_package

BITS = 20
TRAIN_ROWS = 8000
#: A word needs this many training documents to get a weight.
LEAST_DOCUMENTS = 3
STEPS, RATE, DECAY = 150, 0.1, 1.0
BATCH_BYTES = 2 << 20
MOST_SENTENCES = 500

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_WORD = np.zeros(256, bool)
_WORD[list(b"abcdefghijklmnopqrstuvwxyz0123456789'")] = True
_WORD[128:] = True
_STOP = np.zeros(256, np.int64)
_STOP[list(b".!?\n")] = 1


def featurise(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each word: its feature, its sentence (0, 1, ... over all texts).  For each sentence: its text, and its
    first and last byte in that text (end exclusive)."""
    data, begin = joined(texts)
    data = _LOWER[data]
    found = words(data, begin, _WORD)
    feature = (span_hashes(data, found.start, found.end) >> np.uint64(64 - BITS)).astype(np.int64)
    number = np.cumsum(_STOP[data])[found.start]
    first = np.flatnonzero(np.diff(number, prepend=-1))
    sentence = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(number))))
    last = np.append(first[1:], len(number)) - 1
    text = found.text[first]
    return feature, sentence, text, found.start[first] - begin[text], (found.end[last] - begin[text]) if len(first) else first


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


@dataclass
class NoisyOr:
    weights: np.ndarray
    bias: float
    constant: float | None = None  # the score of every text when there was nothing to learn from

    def sentence_logits(self, feature: np.ndarray, sentence: np.ndarray, count: int) -> np.ndarray:
        return self.bias + np.bincount(sentence, self.weights[feature], count)

    def score(self, texts: list[str]) -> tuple[np.ndarray, list[list[tuple[int, int, float]]]]:
        """The score of each text, and its sentences as (first byte, end, score)."""
        feature, sentence, text, start, end = featurise(texts)
        z = self.sentence_logits(feature, sentence, len(text))
        share = np.minimum(1.0, MOST_SENTENCES / np.maximum(np.bincount(text, minlength=len(texts)), 1))[text]
        score = -np.expm1(-np.bincount(text, softplus(z) * np.where(z < 0, share, 1.0), len(texts)))
        sentences: list[list[tuple[int, int, float]]] = [[] for _ in texts]
        for i, s, e, p in zip(text.tolist(), start.tolist(), end.tolist(), np.exp(-softplus(-z)).tolist()):
            sentences[i].append((s, e, p))
        if self.constant is not None:
            score = np.full(len(texts), self.constant)
        return score, sentences


def train(feature: np.ndarray, sentence: np.ndarray, document: np.ndarray, label: np.ndarray, steps: int = STEPS,
          rate: float = RATE, decay: float = DECAY) -> NoisyOr:
    """Fit the noisy-or by proximal Adam steps: first with the L1 penalty ``decay`` (in units of one document's
    loss), which picks the words, then the picked words again with a small penalty.  ``document``: of each
    sentence; ``label``: of each document."""
    n = len(label)
    if not label.any() or label.all():
        return NoisyOr(np.zeros(1 << BITS), 0.0, float(label.sum()) / (n + 1))
    pairs = np.unique(document[sentence] << BITS | feature)
    known = np.flatnonzero(np.bincount(pairs & ((1 << BITS) - 1), minlength=1 << BITS) >= LEAST_DOCUMENTS)
    positive, count = label[document] > 0, len(document)
    bias = float(np.log(label.mean() / max(1.0, count / n)) - 1)
    w = np.zeros(len(known))
    for penalty in (decay, decay / 20):
        number = np.full(1 << BITS, -1)
        number[known] = np.arange(len(known))
        use = number[feature] >= 0
        x, s = number[feature[use]], sentence[use]
        m, v, mb, vb = np.zeros(len(known)), np.zeros(len(known)), 0.0, 0.0
        for t in range(1, steps + 1):
            z = bias + np.bincount(s, w[x], count)
            p = np.exp(-softplus(-z))
            miss = np.exp(-np.bincount(document, softplus(z), n))[document]
            slope = np.where(positive, -p * miss / np.maximum(1 - miss, 1e-9), p)
            g, gb = np.bincount(x, slope[s], len(known)), slope.sum()
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
            size = rate / (np.sqrt(v / (1 - 0.99**t)) + 1.0)
            w = w - size * m / (1 - 0.9**t)
            w = np.sign(w) * np.maximum(np.abs(w) - size * penalty, 0)
            bias -= rate * mb / (1 - 0.9**t) / (np.sqrt(vb / (1 - 0.99**t)) + 1e-9)
        known, w = known[w != 0], w[w != 0]
    full = np.zeros(1 << BITS)
    full[known] = w
    return NoisyOr(full, bias)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, most: int) -> DataFrame:
    """At most ``most`` rows (text, toxic) of labelled documents that are not held out."""
    known = labels.where(F.col("toxic").isNotNull() & ~held_out(F.col(id_col))).groupBy(F.col(id_col).alias("i")).agg(F.max("toxic").alias("toxic"))
    chosen = (known.join(docs.select(F.col(f"`{id_col}`").alias("i")).distinct(), "i", "left_semi")
              .orderBy(F.md5(F.col("i").cast("string"))).limit(most))
    return docs.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_col}`").alias("text")).join(F.broadcast(chosen), "i").select("text", "toxic")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS) -> NoisyOr:
    """Learn from ``labels`` (id, toxic 0/1; null labels are none).  Tasks hash the texts; one task gets the hashed
    words of ``train_rows`` documents at most and runs the descent; the driver gets the weights that are not 0."""
    ship_package(docs.sparkSession)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 0, BATCH_BYTES):
                texts = [t or "" for t in batch.column(0).to_pylist()]
                feature, sentence, text, _, _ = featurise(texts)
                of = text[sentence] if len(sentence) else sentence
                cut = np.searchsorted(of, np.arange(len(texts) + 1))
                inner = [sentence[a:b] for a, b in zip(cut, cut[1:])]
                yield pa.RecordBatch.from_arrays([pa.array([feature[a:b].astype("<i4").tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
                                                  pa.array([(s - s[:1]).astype("<i4").tobytes() if len(s) else b"" for s in inner], pa.binary()), batch.column(1)],
                                                 ["feature", "sentence", "toxic"])

    @tidy
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((f, s, y) for batch in batches for f, s, y in zip(*(c.to_pylist() for c in batch.columns)))
        feature, sentence, document, at = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        for k, (f, s, _) in enumerate(rows):  # in a fixed order, so that the sums and with them the model repeat exactly
            own = np.frombuffer(s, "<i4").astype(np.int64)
            count = int(own[-1]) + 1 if len(own) else 0
            feature.append(np.frombuffer(f, "<i4").astype(np.int64))
            sentence.append(own + at)
            document.append(np.full(count, k))
            at += count
        label = np.array([y > 0 for *_, y in rows], bool)
        model = train(np.concatenate(feature), np.concatenate(sentence), np.concatenate(document), label)
        known = np.flatnonzero(model.weights)
        yield pa.RecordBatch.from_pydict({"known": [known.astype("<i4").tobytes()], "weight": [model.weights[known].astype("<f8").tobytes()],
                                          "bias": [model.bias], "constant": pa.array([model.constant], pa.float64())})

    rows = training_rows(docs, labels, id_col, text_col, train_rows)
    hashed = rows.select("text", F.col("toxic").cast("int")).mapInArrow(run, "feature binary, sentence binary, toxic int")
    out = hashed.repartition(1).mapInArrow(learn, "known binary, weight binary, bias double, constant double").first()
    weights = np.zeros(1 << BITS)
    if out is None:  # no rows, no task
        return NoisyOr(weights, 0.0, 0.0)
    weights[np.frombuffer(out["known"], "<i4")] = np.frombuffer(out["weight"], "<f8")
    return NoisyOr(weights, out["bias"], out["constant"])


def score(docs: DataFrame, model: NoisyOr, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, score, predicted (1 from 0.5 on), n_sentences, n_offending (sentences of 0.5 or
    more), and worst_start, worst_end (code points) and worst_score of the sentence with the highest score."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)  # 2**BITS weights

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for whole in batches:
            for batch in slices(whole, 1, BATCH_BYTES):
                texts = [t or "" for t in batch.column(1).to_pylist()]
                scores, sentences = own.score(texts)
                rows = []
                for t, p, found in zip(texts, scores.tolist(), sentences):
                    s, e, worst = max(found, key=lambda x: (x[2], -x[0]), default=(None, None, None))
                    if s is not None and not t.isascii():
                        raw = t.encode()
                        s, e = len(raw[:s].decode()), len(raw[:e].decode())
                    rows.append((p, int(p >= 0.5), len(found), sum(x[2] >= 0.5 for x in found), s, e, worst))
                kinds = (pa.float64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
                yield pa.RecordBatch.from_arrays([batch.column(0)] + [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                 ["id", "score", "predicted", "n_sentences", "n_offending", "worst_start", "worst_end", "worst_score"])

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, score double, predicted int, n_sentences long, n_offending long, worst_start long, "
                                "worst_end long, worst_score double").withColumnRenamed("id", id_col)


def report(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``score`` of a model fitted to ``labels``, and held_out."""
    out = score(docs, fit(docs, labels, id_col, text_col, train_rows), id_col, text_col)
    return out.select(id_col, held_out(F.col(id_col)).alias("held_out"), "score", "predicted", "n_sentences", "n_offending",
                      "worst_start", "worst_end", "worst_score")


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows, all columns unchanged, whose text scores below 0.5."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col, train_rows))
    at = docs.columns.index(text_col)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, at, BATCH_BYTES):
                scores, _ = model.value.score([t or "" for t in batch.column(at).to_pylist()])
                yield batch.filter(pa.array(scores < 0.5))

    return docs.mapInArrow(run, docs.schema)
