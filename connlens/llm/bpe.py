"""Byte-level BPE encoding and decoding of whole texts.

The vocabulary is read from a tokenizer file (its path is a parameter and must be readable on the executors;
nothing is trained).  A word's symbols form a doubly linked list; a priority queue holds the merge rank of every
adjacent pair that has one, leftmost first among equal ranks.  The lowest entry is popped, skipped when stale
(a symbol has gone or the pair has changed since), else merged, and the new symbol's two pairs are pushed.  So a
word of n bytes costs O(n log n) however long it is.  Decoding concatenates the vocabulary strings.

Texts are cut before each run of white space: no word of the vocabulary's pattern crosses such a cut, so the ids
of a chunk can be kept in a bounded cache.  Special tokens in a text become their ids, as in the file's library.
Letters and numbers differ between versions of Unicode; chunks with characters from U+0530 on are cut into words
by the library's own pattern, the others by the same pattern here.

Defined results: a null text counts as empty, an empty text has no ids; ids of null id rows are returned as
they are; equal rows give equal results; further columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import json
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

from connlens.session import ship_package

#: The pattern of byte-level BPE words, with Unicode's own White_Space.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: From here on, which characters are letters or numbers depends on the version of Unicode.
FAR = regex.compile("[\u0530-\U0010ffff]")
CACHED_CHUNKS = 400_000
CACHED_CHARS = 64
BATCH_BYTES = 8 << 20


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + hidden.index(b)) for b in range(256)]


class BytePairCodec:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, words = spec["model"], spec["pre_tokenizer"]
        if (model["type"] != "BPE" or spec["normalizer"] or model["end_of_word_suffix"] or model["ignore_merges"]
                or words["type"] != "ByteLevel" or words["add_prefix_space"] or not words["use_regex"]):
            raise ValueError("not a plain byte-level BPE file")
        vocab, alphabet = model["vocab"], byte_alphabet()
        self.byte_ids = [vocab[c] for c in alphabet]
        self.ranks, self.merged = {}, []
        for rank, (a, b) in enumerate(model["merges"]):
            self.ranks[vocab[a] << 20 | vocab[b]] = rank
            self.merged.append(vocab[a + b])
        to_byte = {c: b for b, c in enumerate(alphabet)}
        self.strings = {i: bytes(to_byte[c] for c in s) for s, i in vocab.items() if all(c in to_byte for c in s)}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = {s: array("I", [i]).tobytes() for s, i in special.items()}
        self.strings |= {i: s.encode() for s, i in special.items()}
        self.at_special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.words = regex.compile(PATTERN)
        self.library_words = ByteLevel(add_prefix_space=False, use_regex=True)
        self.chunks = regex.compile(r"[\p{White_Space}]*[^\p{White_Space}]+|[\p{White_Space}]+")
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def merge(self, word: bytes) -> list[int]:
        """The ids of one word."""
        ids = [self.byte_ids[b] for b in word]
        n, rank_of, merged = len(ids), self.ranks.get, self.merged
        queue = []
        for i in range(n - 1):
            rank = rank_of(ids[i] << 20 | ids[i + 1])
            if rank is not None:
                queue.append(rank << 32 | i)
        if not queue:
            return ids
        heapify(queue)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while queue:
            entry = heappop(queue)
            i, rank = entry & 0xFFFFFFFF, entry >> 32
            j = after[i]
            if ids[i] < 0 or j >= n or rank_of(ids[i] << 20 | ids[j]) != rank:
                continue  # stale
            ids[i] = left = merged[rank]
            ids[j] = -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                rank = rank_of(left << 20 | ids[k])
                if rank is not None:
                    heappush(queue, rank << 32 | i)
            p = before[i]
            if p >= 0:
                rank = rank_of(ids[p] << 20 | left)
                if rank is not None:
                    heappush(queue, rank << 32 | p)
        return [x for x in ids if x >= 0]

    def _keep(self, chunk: str, ids: bytes) -> None:
        if len(chunk) <= CACHED_CHARS:
            if len(self.new) >= CACHED_CHUNKS:
                self.old, self.new = self.new, {}
            self.new[chunk] = ids

    def _chunk(self, chunk: str) -> bytes:
        ids = self.new.get(chunk)
        if ids is None:
            ids = self.old.get(chunk)
            if ids is None:
                if FAR.search(chunk):
                    words = [chunk[a:b] for _, (a, b) in self.library_words.pre_tokenize_str(chunk)]
                else:
                    words = self.words.findall(chunk)
                if len(words) == 1:
                    ids = array("I", self.merge(chunk.encode())).tobytes()
                else:
                    ids = b"".join([self._word(w) for w in words])
            self._keep(chunk, ids)
        return ids

    def _word(self, word: str) -> bytes:
        ids = self.new.get(word) or self.old.get(word)
        if ids is None:
            ids = array("I", self.merge(word.encode())).tobytes()
            self._keep(word, ids)
        return ids

    def _plain(self, text: str) -> bytes:
        get, chunks = self.new.get, self.chunks.findall(text)
        parts = [get(c) for c in chunks]
        if None in parts:
            parts = [self._chunk(c) if p is None else p for c, p in zip(chunks, parts)]
        return b"".join(parts)

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if self.at_special is None or not self.at_special.search(text):
            return self._plain(text)
        out, at = [], 0
        for m in self.at_special.finditer(text):
            out += [self._plain(text[at:m.start()]), self.special[m.group()]]
            at = m.end()
        return b"".join([*out, self._plain(text[at:])])

    def decode(self, ids: bytes) -> str:
        return b"".join([self.strings[i] for i in memoryview(ids).cast("I")]).decode("utf-8", "replace")


_CODECS: dict[str, BytePairCodec] = {}


def codec(path: str) -> BytePairCodec:
    """One codec, with its cache, per worker process and file."""
    if path not in _CODECS:
        _CODECS[path] = BytePairCodec(path)
    return _CODECS[path]


def slices(batch: pa.RecordBatch, column: int, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose ``column`` holds about ``most`` bytes (one row at least)."""
    sizes, start, held = pc.binary_length(batch.column(column)).fill_null(0).to_pylist(), 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def tidy(run):
    """A task function that, when its input ends, gives freed memory back to the system: Python workers live on
    from task to task, and what one stage's peak left in the allocators would count against the next."""

    @functools.wraps(run)
    def wrapped(batches):
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # no glibc
            ctypes.CDLL("libc.so.6").malloc_trim(0)

    return wrapped


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens and ids (binary: little-endian unsigned 32-bit) of every row's whole text."""
    ship_package(df.sparkSession)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for whole in batches:
            for batch in slices(whole, 1):
                ids = [own.encode(t or "") for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], ["id", "n_tokens", "ids"])

    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_tokens long, ids binary").withColumnRenamed("id", id_col)


def decoded(ids: Column, path: str) -> Column:
    """The text of a binary column of ids, special tokens included; null gives an empty text."""

    @F.pandas_udf("string")
    def run(column):
        own = codec(path)
        return column.map(lambda x: own.decode(x or b""))

    return run(ids)
