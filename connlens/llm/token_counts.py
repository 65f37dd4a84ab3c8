"""Token counts of whole texts, huge ones by overlapping chunks that are resynchronised.

A text of at most two chunks is encoded whole (a word-level file's by this package's codec, whose ids are the
library's).  A longer one is cut into chunks of
``chunk`` characters, each followed by ``overlap`` characters of the next, which are encoded with offsets wherever
Spark puts them.  Neighbours are spliced where both have a boundary in the overlap that is proven stable:

* A *cut* is a place between two characters of different class (letter, digit, mark, and white space on the right)
  that no word of the tokenizer's pattern can span, whatever comes before or after, that no special string spans,
  and whose right character never composes with the left one.  This follows from the two characters alone, so
  the tokens before a cut do not depend on the text behind it, nor those behind it on the text before.
* The left chunk's tokens up to the cut and the right chunk's tokens from it on are then the whole text's.  The
  right chunk begins anywhere, so its first tokens may be wrong; they lie before its first cut.

If two neighbours share no cut in their overlap, the overlap is doubled, and the two are encoded anew; an overlap
that would exceed a chunk joins them into one.  Only chunks at such seams are encoded again.

Defined results: a null text counts as empty (0 bytes, 0 tokens); special strings in a text are special tokens, as
the library has it; rows are counted one by one, so null and repeated ids are kept; an empty table gives an empty
result; other columns, whatever their names, do not matter.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from connlens.llm.bpe import slices, tidy
from connlens.llm.word_bpe import codec
from connlens.session import materialize, ship_package

CHUNK, OVERLAP, LIMIT = 16_384, 512, 2048
BATCH_BYTES = 1 << 20

#: Patterns whose words the cuts below cannot lie in (fixed values of the tokenizer files).
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LETTER, DIGIT, MARK, BLANK = 1, 2, 3, 4
_CLASS = np.zeros(0xA000, np.uint8)
for _first, _last, _kind in ((0x21, 0x7E, MARK), (0x30, 0x39, DIGIT), (0x41, 0x5A, LETTER), (0x61, 0x7A, LETTER), (0xC0, 0xD6, LETTER),
                             (0xD8, 0xF6, LETTER), (0xF8, 0x12F, LETTER), (0x131, 0x17F, LETTER), (0x410, 0x44F, LETTER), (0x4E00, 0x9FA5, LETTER),
                             (0x20, 0x20, BLANK), (0x09, 0x0A, BLANK), (0x0D, 0x0D, BLANK)):
    _CLASS[_first:_last + 1] = _kind


def cuts(text: str) -> np.ndarray:
    """The places p (0 < p < length) between text[p - 1] and text[p] that are cuts.

    Letters end before a digit, mark or blank, digits before any other class, marks before a letter, digit or blank.
    Not counted: U+0130, whose lower case ends in a mark, an apostrophe before a letter (contractions) and a bar beside one (special strings)."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    kind = np.where(code < len(_CLASS), _CLASS[np.minimum(code, len(_CLASS) - 1)], 0)
    left, right = kind[:-1], kind[1:]
    fine = (left != right) & (left > 0) & (right > 0) & (left != BLANK)
    fine &= ~((right == LETTER) & ((code[:-1] == ord("'")) | (code[:-1] == ord("|"))))
    fine &= ~((left == LETTER) & (code[1:] == ord("|")))
    return np.flatnonzero(fine) + 1


class Counter:
    """The library's tokenizer for a .json file whose words the cuts respect."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        before = spec["pre_tokenizer"]
        steps = before.get("pretokenizers", [before])
        by_word = [s["pattern"].get("Regex") for s in steps if s["type"] == "Split"]
        plain = steps[0]["type"] == "ByteLevel" and steps[0]["use_regex"] and not steps[0]["add_prefix_space"]
        norm = spec["normalizer"] or {"normalizers": []}
        kinds = [n["type"] for n in norm.get("normalizers", [norm])]
        if not (by_word == [WORD_PATTERN] or (plain and not by_word)) or set(kinds) - {"NFC", "Replace", "Lowercase"} or spec["post_processor"] and spec["post_processor"]["type"] != "ByteLevel":
            raise ValueError("no stable cuts are proven for this kind of tokenizer file")
        if any(len(cuts(t["content"])) or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("a special string spans a cut")
        self.codec = codec(path) if by_word else None
        self.own = None if by_word else Tokenizer.from_file(path)
        if self.own is not None:
            self.own.no_truncation()
            self.own.no_padding()

    @property
    def library(self) -> Tokenizer:
        return self.own if self.codec is None else self.codec.whole_library()

    def counts(self, texts: list[str]) -> list[int]:
        if self.codec is not None:
            return self.codec.count_all(texts)
        return [len(e) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def boundaries(self, text: str) -> tuple[int, np.ndarray, np.ndarray]:
        """The number of tokens, the cuts that are token boundaries, and how many tokens begin before each."""
        offsets = np.fromiter(chain.from_iterable(self.library.encode(text, add_special_tokens=False).offsets), np.int64).reshape(-1, 2)
        at = cuts(text)
        before = np.searchsorted(offsets[:, 0], at)
        ends = np.concatenate(([0], np.maximum.accumulate(offsets[:, 1])))
        whole = ends[before] <= at
        return len(offsets), at[whole], before[whole]


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def _counted(rows: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """``rows`` (row, id, text): one row per text of at most two chunks with its n_tokens, and one per chunk k of a
    longer text with the chunk's text, the overlap included."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for whole in batches:
            for batch in slices(whole, 2, BATCH_BYTES):
                texts = [t or "" for t in batch.column(2).to_pylist()]
                short = [i for i, t in enumerate(texts) if len(t) <= 2 * chunk]
                found = own.counts([texts[i] for i in short])
                yield part(batch, texts, short, found, [None] * len(short), [None] * len(short))
                for i in (i for i, t in enumerate(texts) if len(t) > 2 * chunk):
                    ks = range(-(-len(texts[i]) // chunk))
                    for some in (ks[j:j + 64] for j in range(0, len(ks), 64)):
                        yield part(batch, texts, [i] * len(some), [None] * len(some), list(some), [texts[i][k * chunk:(k + 1) * chunk + overlap] for k in some])

    def part(batch, texts, at, found, ks, pieces):
        take = pa.array(at, pa.int64())
        sizes = {i: len(texts[i].encode()) for i in set(at)}
        return pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array([sizes[i] for i in at], pa.int64()),
                                           pa.array(found, pa.int64()), pa.array(ks, pa.int64()), pa.array(pieces, pa.string())],
                                          ["row", "id", "n_bytes", "n_tokens", "k", "text"])

    return rows.mapInArrow(run, f"row long, id {rows.schema['id'].dataType.simpleString()}, n_bytes long, n_tokens long, k long, text string")


RESULT = "row long, k long, last long, n long, over long, head_at array<long>, head_n array<long>, tail_at array<long>, tail_n array<long>"


def _encoded(pieces: DataFrame, path: str, chunk: int) -> DataFrame:
    """``pieces`` (row, k, last: their first and last chunk, over, over_left, text): the number of tokens, and the cuts
    in the overlap with the left neighbour (head) and with the right one (tail) with the tokens before them."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for whole in batches:
            for batch in slices(whole, 5, BATCH_BYTES):
                out = []
                for row, k, last, over, over_left, text in zip(*[c.to_pylist() for c in batch.columns]):
                    n, at, before = own.boundaries(text)
                    head, tail = at < over_left, at > (last - k + 1) * chunk
                    out.append((row, k, last, n, over, (at[head] + k * chunk).tolist(), before[head].tolist(), (at[tail] + k * chunk).tolist(), before[tail].tolist()))
                kinds = [pa.int64()] * 5 + [pa.list_(pa.int64())] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], [f.split()[0] for f in RESULT.split(", ")])

    return pieces.select("row", "k", "last", "over", "over_left", "text").mapInArrow(run, RESULT)


def _seams(found: DataFrame) -> DataFrame:
    """One row per pair of neighbours: row, k of the left and right, over, and the cut ``at`` both have (null: none)
    with the tokens before it in the left and in the right piece."""
    left = found.select("row", (F.col("last") + 1).alias("k"), F.col("k").alias("left"), "over", "tail_at", "tail_n")
    both = left.join(found.select("row", "k", "head_at", "head_n"), ["row", "k"])
    both = both.withColumn("at", F.array_min(F.array_intersect("tail_at", "head_at")))

    def at_cut(place: str, n: str):
        return F.element_at(n, F.array_position(place, F.col("at")).cast("int"))

    return both.select("row", "left", "k", "over", "at", F.when(F.col("at").isNotNull(), at_cut("tail_at", "tail_n")).alias("in_left"),
                       F.when(F.col("at").isNotNull(), at_cut("head_at", "head_n")).alias("in_right"))


def _widened(found: DataFrame, open_: DataFrame, chunks: DataFrame, chunk: int) -> tuple[DataFrame, DataFrame]:
    """The pieces that replace those beside the open seams: overlaps doubled, or, past a chunk, the two joined.
    Returns (pieces with text, and row and k of the replaced ones)."""
    rows = found.select("row", "k", "last", "over").join(open_.select("row").distinct(), "row", "left_semi")
    marks = open_.select("row", F.col("left").alias("k"), F.lit(True).alias("after"))
    rows = rows.join(marks, ["row", "k"], "left")
    order = Window.partitionBy("row").orderBy("k")
    rows = rows.withColumn("before", F.lag("after").over(order)).withColumn("over_before", F.lag("over").over(order))
    touched = rows.where("after or before")
    # an overlap that can grow no more joins its two pieces: a piece begins a new one unless its left seam does so
    joins = F.coalesce(F.col("before"), F.lit(False)) & (F.col("over_before") >= chunk)
    named = rows.withColumn("piece", F.sum(F.when(joins, 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    grown = F.when(F.col("after"), F.least(F.col("over") * 2, F.lit(chunk))).otherwise(F.col("over"))
    whole = named.groupBy("row", "piece").agg(F.min("k").alias("k"), F.max("last").alias("last"), F.max_by(grown, "k").alias("over"),
                                              F.max(F.coalesce("after", F.lit(False)) | F.coalesce("before", F.lit(False))).alias("again"))
    whole = whole.withColumn("over_left", F.coalesce(F.lag("over").over(order), F.lit(0))).where("again").drop("again", "piece")
    # written, so that the few rows that most rounds want are known to be few before the join: the texts of all other
    # chunks then stay where they are
    inside = materialize(whole.withColumn("b", F.explode(F.sequence(F.col("k"), F.col("last") + 1))), "widened-pieces")
    body = chunks.select("row", F.col("k").alias("b"), F.substring("text", 1, chunk).alias("body"))
    part = F.when(F.col("b") <= F.col("last"), F.col("body")).otherwise(F.expr("substring(body, 1, cast(over as int))"))
    texts = (inside.join(body, ["row", "b"]).groupBy("row", "k", "last", "over", "over_left")
             .agg(F.array_sort(F.collect_list(F.struct("b", part.alias("part")))).alias("parts")))
    return texts.select("row", "k", "last", "over", "over_left", F.array_join("parts.part", "").alias("text")), touched.select("row", "k")


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT,
                 chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row per input row: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit)."""
    if not 0 < overlap <= chunk:
        raise ValueError("the overlap must be positive and at most a chunk")
    ship_package(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    counted = materialize(_counted(rows, path, chunk, overlap), "counted-texts")
    chunks = counted.where("k is not null")
    first = chunks.select("row", "k", F.col("k").alias("last"), F.lit(overlap).cast("long").alias("over"), F.lit(overlap).cast("long").alias("over_left"), "text")
    found = materialize(_encoded(first.repartition("row", "k"), path, chunk), "chunk-tokens")
    while True:
        seams = materialize(_seams(found), "seams")
        open_ = seams.where("at is null")
        if open_.isEmpty():
            break
        pieces, replaced = _widened(found, open_, chunks, chunk)
        found = materialize(found.join(replaced, ["row", "k"], "left_anti").unionByName(_encoded(pieces, path, chunk)), "chunk-tokens")
    ends = found.groupBy("row").agg(F.max_by("n", "k").alias("n"))
    spliced = seams.groupBy("row").agg(F.sum(F.col("in_left") - F.col("in_right")).alias("more"))
    totals = ends.join(spliced, "row", "left").select("row", (F.col("n") + F.coalesce("more", F.lit(0))).alias("n_tokens"))
    long_ones = chunks.where("k = 0").select("row", "id", "n_bytes").join(totals, "row")
    out = counted.where("k is null").select("id", "n_bytes", "n_tokens").unionByName(long_ones.select("id", "n_bytes", "n_tokens"))
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
