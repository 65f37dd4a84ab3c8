"""Repeated passages by content-defined chunking.

Each text is cut where a gear hash of its last 16 bytes says so (the hash shifts left by one a byte and adds the
byte's random number, so that older bytes fall out), unless another such place lies within the last ``LEAST``
bytes; chunks over ``MOST`` bytes are cut at that length.  A cut depends on nothing but the bytes just before
it, so an insertion moves only the chunks it touches, and a passage that occurs in two texts is cut alike in
both but for its edges.  A chunk's digest (128 bits) is counted over the whole corpus.  Of the texts
that have a chunk, the one with the least id keeps it (without distinct whole-number ids, the first in reading
order, which then stands for "earlier" below); in the others it is a repeat.  Adjacent repeats are one span; a span of
which some earlier text keeps at least ``words`` words, or ``WORD_BYTES`` times as many bytes of chunks, is reported, with that text, and can be removed.

Chunks alone can miss a passage: one cut into few whole chunks, or one whose chunks were first met in different
earlier texts, none of which keeps ``words`` words.  So with ``passage`` each text also gives windows of ``words``
whole words, looked up like chunks: of any ``passage`` - 1 - ``words`` successive windows the one with the least
hash (winnowing).  A passage of ``passage`` words, the first and last of which may be torn, holds all these windows
once; so every text that shares it with an earlier one has a window in common with it, and the first text that has
the window keeps ``words`` words by itself.  This holds for every such passage, whatever its cuts.  Windows of a
short period that follow each other closely are thinned out, but never so that a passage has none.

Words are what stands between ASCII white space; text without it (Chinese, Japanese, Thai, long encoded lines) has
few, is found by the bytes of its chunks, and has no windows, so only its chunks' runs count.

Defined results: a null or empty text has no chunk; every row is a text of its own, whatever its id, so of
repeated rows and of rows with null ids all but the first are repeats; text that only repeats a short period is
cut at phases of its own, so only its windows are found; an empty table gives an empty result; other columns are ignored (``spans``) or carried (``remove``).
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from connlens.llm.bpe import slices, tidy
from connlens.llm.bytetext import mixed, span_hashes
from connlens.llm.common import lookup_skew_safe
from connlens.session import materialize, ship_package

WINDOW, CUT_BITS, LEAST, MOST = 16, 5, 16, 256
WORDS = 18
#: Bytes that count as a word, for text without blanks.
WORD_BYTES = 12
#: Passages of so many words are found without exception where ``passage`` is given so.
PASSAGE = 51
BATCH_BYTES = 4 << 20
#: One random 16-bit number a byte.
GEAR = (mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.uint16)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def chunk_texts(texts: list[str]) -> dict[str, np.ndarray]:
    """All chunks of the texts in order: text (its number), at (number in the text), start and end (code points),
    before and words (that begin before and in it), bytes, high and low (the digest), again (whether the text has had the
    digest before)."""
    raw = [t.encode() for t in texts]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    data = np.frombuffer(b"".join([b + b"\n" * WINDOW for b in raw]), np.uint8)
    begin = np.cumsum(sizes + WINDOW) - (sizes + WINDOW)
    gap = np.ones(len(data), bool)  # the bytes between texts
    edges = np.zeros(len(data) + 1, np.int64)
    np.add.at(edges, begin, 1)
    np.add.at(edges, begin + sizes, -1)
    gap[np.cumsum(edges[:-1]) > 0] = False
    h = GEAR[data]
    h[gap] = 0
    for k in (1, 2, 4, 8):  # the hash over 2k bytes from that over k
        older = np.zeros_like(h)
        older[k:] = h[:-k] << np.uint16(k)
        h = h + older
    hit = np.flatnonzero((h >> np.uint16(16 - CUT_BITS) == 0) & ~gap) + 1
    hit = hit[np.diff(hit, prepend=-LEAST) >= LEAST]
    full = sizes > 0
    ends = np.unique(np.concatenate((hit, (begin + sizes)[full])))
    text = np.searchsorted(begin, ends - 1, side="right") - 1
    starts = np.maximum(np.concatenate(([0], ends[:-1])), begin[text]) if len(ends) else ends
    parts = -(-(ends - starts) // MOST)
    index = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
    text = np.repeat(text, parts)
    starts, stop = np.repeat(starts, parts) + index * MOST, np.repeat(ends, parts)
    ends = np.minimum(starts + MOST, stop)
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    space = _SPACE[data] | gap
    begun = np.concatenate(([0], np.cumsum(~space & np.concatenate(([True], space[:-1])))))
    blob = data.tobytes()
    digest = np.frombuffer(b"".join([blake2b(blob[s:e], digest_size=16).digest() for s, e in zip(starts.tolist(), ends.tolist())]), "<i8").reshape(-1, 2)
    order = np.lexsort((np.arange(len(text)), digest[:, 1], digest[:, 0], text))
    again = np.zeros(len(text), bool)
    a, b = order[1:], order[:-1]
    again[a] = (text[a] == text[b]) & (digest[a] == digest[b]).all(1)
    first = np.searchsorted(text, text, side="left")
    zero = points[begin[text]]
    return {"text": text, "at": np.arange(len(text)) - first, "start": points[starts] - zero, "end": points[ends] - zero,
            "before": begun[starts] - begun[begin[text]], "words": begun[ends] - begun[starts], "bytes": ends - starts, "high": digest[:, 0], "low": digest[:, 1], "again": again}


def window_texts(texts: list[str], words: int, passage: int) -> dict[str, np.ndarray]:
    """The chosen windows of ``words`` words, with the columns of ``chunk_texts``; at is -1, -2, ... in a text, and bytes 0."""
    run = passage - 1 - words
    if run < 1:
        raise ValueError("a passage must be at least two words longer than a window")
    raw = [t.encode() for t in texts]
    begin = np.cumsum([0, *(len(b) + 1 for b in raw)])
    data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
    space = _SPACE[data]
    edges = np.diff(np.concatenate(([0], (~space).view(np.int8), [0])))
    start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    owner = np.searchsorted(begin, start, side="right") - 1
    count = max(0, len(start) - words + 1)
    h = span_hashes(data, start[:count], end[words - 1:]) if count else np.zeros(0, np.uint64)
    best, least, width = np.arange(count), h, 1  # of ``width`` windows from each on, the first with the least hash

    def joined(step: int) -> tuple[np.ndarray, np.ndarray]:
        right = least[step:] < least[:-step]
        return np.where(right, best[step:], best[:-step]), np.where(right, least[step:], least[:-step])

    while width < run and len(least):
        step = min(width, run - width)
        if step >= len(least):
            best, least = best[:0], least[:0]
            break
        best, least = joined(step)
        width += step
    whole = owner[:len(best)] == owner[words + run - 2:][:len(best)]
    pick = np.unique(best[whole])
    if len(pick):
        same = np.concatenate(([False], (h[pick[1:]] == h[pick[:-1]]) & (np.diff(pick) <= run) & (owner[pick[1:]] == owner[pick[:-1]])))
        keep, last = np.ones(len(pick), bool), 0
        for i in np.flatnonzero(same[:-1] & same[1:]).tolist():  # drop a pick between equal ones no further apart than a run
            last = last if same[i - 1] else i - 1
            keep[i] = pick[i + 1] - pick[last] > run
            last = i if keep[i] else last
        pick = pick[keep]
    text, starts, ends = owner[pick], start[pick], end[pick + words - 1] if len(pick) else pick
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    zero = points[begin[text]]
    blob = data.tobytes()
    digest = np.frombuffer(b"".join([blake2b(blob[s:e], digest_size=16).digest() for s, e in zip(starts.tolist(), ends.tolist())]), "<i8").reshape(-1, 2)
    order = np.lexsort((np.arange(len(text)), digest[:, 1], digest[:, 0], text))
    again = np.zeros(len(text), bool)
    a, b = order[1:], order[:-1]
    again[a] = (text[a] == text[b]) & (digest[a] == digest[b]).all(1)
    return {"text": text, "at": np.searchsorted(text, text, side="left") - np.arange(len(text)) - 1, "start": points[starts] - zero, "end": points[ends] - zero,
            "before": pick - np.searchsorted(owner, text, side="left"), "words": np.full(len(text), words), "bytes": np.zeros(len(text), int), "high": digest[:, 0], "low": digest[:, 1], "again": again}


def _row(docs: DataFrame, id_col: str) -> Column:
    """The number of a row, by which the first of equal passages is chosen: the id where ids are distinct whole numbers (so
    the choice does not depend on the files' layout), else the row's place in the input."""
    if docs.schema[id_col].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint"):
        ids = docs.select(F.col(f"`{id_col}`").alias("id"))
        rows, some = ids.agg(F.count("*"), F.count("id")).first()
        if rows == some == ids.distinct().count():
            return F.col(f"`{id_col}`").cast("long")
    return F.monotonically_increasing_id()


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(_row(docs, id_col).alias("row"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))


def chunks(rows: DataFrame, words: int = WORDS, passage: int | None = None) -> DataFrame:
    """``rows`` (row, id, text), one row per chunk and, with ``passage``, per window, written: row, id (of chunk 0,
    else null), at, start, end, before, words, bytes, digest, again."""
    ship_package(rows.sparkSession)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 2, BATCH_BYTES):
                texts = [t or "" for t in batch.column(2).to_pylist()]
                for got in [chunk_texts(texts)] + ([window_texts(texts, words, passage)] if passage else []):
                    owner, at = pa.array(got["text"]), got["at"]
                    digest = pa.Array.from_buffers(pa.binary(16), len(at), [None, pa.py_buffer(np.stack([got["high"], got["low"]], 1).astype("<i8").tobytes())])
                    kinds = {"at": pa.int32(), "start": pa.int32(), "end": pa.int32(), "before": pa.int32(), "words": pa.int32(), "bytes": pa.int32()}
                    named = batch.column(1).take(pa.array(got["text"], mask=at != 0))
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(owner), named, *(pa.array(got[k], t) for k, t in kinds.items()), digest.cast(pa.binary()), pa.array(got["again"])],
                                                     ["row", "id", *kinds, "digest", "again"])

    kind = rows.schema["id"].dataType.simpleString()
    return materialize(rows.mapInArrow(run, f"row long, id {kind}, at int, start int, end int, before int, words int, bytes int, digest binary, again boolean"), "chunks")


def row_spans(cut: DataFrame, words: int = WORDS, within: bool = False) -> DataFrame:
    """One row per repeated span of the ``chunks``: row, start, end (code points), words, and keepers, an array of
    the rows (``first``) that keep chunks or windows of it and the number of words and chunk bytes of these (``words`` words or ``WORD_BYTES`` times as many bytes, or more).  A
    text's own repetitions count only with ``within``."""
    met = cut.groupBy("digest").agg(F.min("row").alias("first"), F.count("*").alias("n")).where("n > 1")
    met = materialize(met, "repeated-chunks")
    found = lookup_skew_safe(cut, "digest", met, ["first"], "n", F.concat_ws(":", F.lit("hot"), "row", "at").cast("binary"), keep="inner")
    repeats = found.where(F.col("row") != F.col("first") if not within else (F.col("row") != F.col("first")) | F.col("again"))
    repeats = repeats.select("row", "start", "end", "before", (F.col("before") + F.col("words")).alias("after"), "bytes", "first")
    past = Window.partitionBy("row").orderBy("start", "end", "first")
    apart = F.col("start") > F.coalesce(F.max("end").over(past.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1))
    runs = repeats.withColumn("apart", apart.cast("int")).withColumn("run", F.sum("apart").over(past.rowsBetween(Window.unboundedPreceding, 0)))
    met_before = F.max("after").over(Window.partitionBy("row", "run", "first").orderBy("before", "after").rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("after") - F.greatest(F.col("before"), F.coalesce(met_before, F.lit(0))))  # words that no earlier piece counted
    each = (runs.withColumn("fresh", fresh).groupBy("row", "run", "first")
            .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("before").alias("before"), F.max("after").alias("after"), F.sum("fresh").alias("words"), F.sum("bytes").alias("bytes")))
    whole = each.groupBy("row", "run").agg(F.min("start").cast("long").alias("start"), F.max("end").cast("long").alias("end"), (F.max("after") - F.min("before")).cast("long").alias("words"),
                                           F.array_sort(F.collect_list(F.struct("first", "words", "bytes"))).alias("keepers"))
    return whole.withColumn("keepers", F.filter("keepers", lambda k: (k["words"] >= words) | (k["bytes"] >= words * WORD_BYTES))).where(F.size("keepers") > 0).drop("run")


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, within: bool = False, passage: int | None = None) -> DataFrame:
    """One row per repeated span and earlier text that keeps enough of it (see ``row_spans``): id, start, end, words,
    first_<id> and shared_words.  Without ``passage`` by chunks alone."""
    cut = chunks(_numbered(docs, id_col, text_col), words, passage)
    each = row_spans(cut, words, within).withColumn("k", F.explode("keepers")).select(F.col("row").alias("own"), "start", "end", "words", F.col("k.first").alias("row"), F.col("k.words").alias("shared_words"))
    names = cut.where("at = 0")
    first, own = names.select("row", F.col("id").alias("first_id")), names.select(F.col("row").alias("own"), "id")
    return each.join(first, "row").join(own, "own").select(F.col("id").alias(id_col), "start", "end", "words", F.col("first_id").alias(f"first_{id_col}"), "shared_words")


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, within: bool = False,
           passage: int | None = PASSAGE) -> DataFrame:
    """The input rows, all columns, without the repeated spans in their text."""
    numbered = materialize(docs.select(_row(docs, id_col).alias("__row"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc")), "numbered")
    cut = chunks(numbered.select(F.col("__row").alias("row"), F.col("__doc").getField(id_col).alias("id"), F.col("__doc").getField(text_col).alias("text")), words, passage)
    gone = row_spans(cut, words, within).groupBy(F.col("row").alias("__row")).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("__gone"))
    joined = numbered.join(gone, "__row", "left")
    text, zero = F.col("__doc").getField(text_col), F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    left = F.aggregate("__gone", zero, lambda a, s: F.struct(F.concat(a["out"], F.substr(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int"))).alias("out"), s["end"].alias("at")),
                       lambda a: F.concat(a["out"], F.substr(text, (a["at"] + 1).cast("int"))))
    new = F.when(F.col("__gone").isNull(), text).otherwise(left)
    return joined.select(*[new.alias(c) if c == text_col else F.col("__doc").getField(c).alias(c) for c in docs.columns])
