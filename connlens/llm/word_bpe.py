"""Exact, fast ids for a lower-casing word-level BPE file (words end in a suffix, white space is dropped).

No word crosses white space, so the ids of a white-space-separated chunk are kept in a bounded cache.  The words
that a batch brings anew are merged together, array-wise: in each pass every word merges all its pairs of the
lowest rank.  That equals merging one at a time because a merge's result occurs only in merges of higher rank,
which the constructor verifies.  Texts with special tokens or the separators U+001C to U+001F, and chunks with
characters from U+0530 on (their classes depend on the version of Unicode), go through the tokenizers library.
"""

from __future__ import annotations

import json
import unicodedata
from itertools import compress
from operator import not_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from connlens.llm.bpe import FAR, byte_alphabet

CACHE_BYTES = 48 << 20  # of each of the cache's two generations, about
ENTRY_BYTES = 200  # of an entry beside its characters and ids
NONE = np.int32(2**31 - 1)


class WordCodec:
    def __init__(self, path: str):
        self.path, self.library = path, None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or not model["end_of_word_suffix"]:
            raise ValueError("not a lower-casing BPE file with word ends")
        vocab, alphabet, end = model["vocab"], byte_alphabet(), model["end_of_word_suffix"]
        self.inner = np.array([vocab[c] for c in alphabet], np.int64)
        self.final = np.array([vocab[c + end] for c in alphabet], np.int64)
        made, keys, merged = {}, [], []
        for rank, (a, b) in enumerate(model["merges"]):
            whole = vocab[a + b]
            if whole in made or max(made.get(vocab[a], -1), made.get(vocab[b], -1)) >= rank:
                raise ValueError("merges must make each symbol once, before it is used")
            made[whole] = rank
            keys.append(vocab[a] << 20 | vocab[b])
            merged.append(whole)
        self.merged = np.array(merged, np.int64)
        self.bits = max(4, int(np.ceil(np.log2(len(keys) * 5))))
        self.slots, self.slot_rank = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, NONE, np.int32)
        for rank, (key, at) in enumerate(zip(keys, self._slot(np.array(keys, np.int64)).tolist())):
            while self.slots[at] >= 0:
                at = (at + 1) & ((1 << self.bits) - 1)
            self.slots[at], self.slot_rank[at] = key, rank
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(r"\n|" + pattern.replace(r"\s", r"\p{White_Space}"))
        self.odd = "|".join([*(regex.escape(t["content"]) for t in spec["added_tokens"]), "[\x1c-\x1f]"])
        self.new: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}
        self.word_ids: dict[str, bytes] = {}
        self.held = 0

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _rank(self, keys: np.ndarray) -> np.ndarray:
        """The merge rank of each pair key, NONE if it has none."""
        at = self._slot(keys)
        found = self.slots[at]
        out = np.where(found == keys, self.slot_rank[at], NONE)
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            found = self.slots[at[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.slot_rank[at[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out

    def _merge(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word (none empty)."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(lengths) - 1
        symbols = self.inner[raw]
        symbols[ends] = self.final[raw[ends]]
        word = np.repeat(np.arange(len(words)), lengths)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            rank = np.full(len(symbols), NONE, np.int32)
            inside = np.flatnonzero(word[:-1] == word[1:])
            rank[inside] = self._rank(symbols[inside] << 20 | symbols[inside + 1])
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            least = np.minimum.reduceat(rank, first)
            least = np.repeat(least, np.diff(np.r_[first, len(symbols)]))
            ready = least == NONE
            done.append((word[ready], symbols[ready]))
            take = (rank == least) & ~ready
            # of a run of overlapping pairs, as in "aaa", every second one from the left
            at = np.flatnonzero(take)
            if len(at):
                begins = np.r_[True, np.diff(at) > 1]
                start = np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - start) % 2 == 0]
            symbols[at] = self.merged[rank[at]]
            stay = ~ready
            stay[at + 1] = False
            symbols, word = symbols[stay], word[stay]
        word, symbols = np.concatenate([w for w, _ in done]), np.concatenate([s for _, s in done])
        order = np.argsort(word, kind="stable")
        blob = symbols[order].astype("<u4").tobytes()
        cuts = (np.cumsum(np.bincount(word, minlength=len(words))) * 4).tolist()
        return [blob[a:b] for a, b in zip([0, *cuts], cuts)]

    def _learn(self, chunks: list[str]) -> None:
        """Put the ids of chunks without white space into the cache."""
        whole = "\n".join(chunks)
        if FAR.search(whole):
            far = {c: self._library_ids(c) for c in chunks if FAR.search(c)}
            self.new.update(far)
            chunks = [c for c in chunks if c not in far]
            whole = "\n".join(chunks)
        if not whole.isascii():
            if "Σ" in (whole := unicodedata.normalize("NFC", whole)):  # each character on its own: no final sigma
                whole = "".join([x.lower() for x in whole])
        lowered = whole.lower().split("\n")
        plain = list(map(str.isalpha, lowered))  # a chunk of letters is one word
        odd = list(map(not_, plain))
        found = self.words.findall("\n".join(compress(lowered, odd)))  # the words of the others, and a newline between chunks
        ids = self.word_ids
        distinct = list(({*compress(lowered, plain), *found} - {"\n"}).difference(ids))
        if distinct:
            ids.update(zip(distinct, self._merge([w.encode() for w in distinct])))
            self.held += ENTRY_BYTES // 2 * len(distinct)
        self.new.update(zip(compress(chunks, plain), map(ids.__getitem__, compress(lowered, plain))))
        ends = [i for i, w in enumerate(found) if w == "\n"]
        for chunk, at, end in zip(compress(chunks, odd), [0, *[e + 1 for e in ends]], [*ends, len(found)]):
            self.new[chunk] = ids[found[at]] if end == at + 1 else b"".join([ids[w] for w in found[at:end]])

    def whole_library(self):
        """The file in the tokenizers library, loaded when first needed."""
        if self.library is None:
            from tokenizers import Tokenizer
            self.library = Tokenizer.from_file(self.path)
            self.library.no_truncation()
            self.library.no_padding()
        return self.library

    def _library_ids(self, text: str) -> bytes:
        return np.array(self.whole_library().encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode_all(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        """The ids of each text (null: empty) as little-endian unsigned 32-bit integers."""
        counts, parts, words, odd = self._words(texts)
        lengths = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        flat, ends = np.frombuffer(b"".join(parts), "<u4"), np.cumsum(lengths)
        size = lengths[words]
        at = np.concatenate(([0], np.cumsum(size)))
        ids = flat[np.repeat((ends - lengths)[words] - at[:-1], size) + np.arange(at[-1])]
        cuts = np.concatenate(([0], np.cumsum(counts)))
        return [odd[i] if i in odd else ids[a:b].tobytes() for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist()))]

    def count_all(self, texts: pa.Array | list[str | None]) -> list[int]:
        """How many ids each text has."""
        counts, _, _, odd = self._words(texts)
        counts = counts.tolist()
        for i, ids in odd.items():
            counts[i] = len(ids) // 4
        return counts

    def _words(self, texts: pa.Array | list[str | None]) -> tuple[np.ndarray, list[bytes], np.ndarray, dict[int, bytes]]:
        """The number of ids of each text, the ids of the batch's distinct chunks, the chunks of all texts as numbers of
        those, and the ids of the texts that go through the library (which have no chunks)."""
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        strange = pc.match_substring_regex(texts, self.odd)
        odd = {}
        if pc.any(strange).as_py():
            odd = {i: self._library_ids(texts[i].as_py()) for i in np.flatnonzero(strange.to_numpy(zero_copy_only=False)).tolist()}
            texts = pc.if_else(strange, "", texts)
        split = pc.utf8_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        parts = self._ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        words = coded.indices.to_numpy()
        before = np.concatenate(([0], np.cumsum((np.fromiter(map(len, parts), np.int64, len(parts)) // 4)[words])))
        offsets = split.offsets.to_numpy()
        offsets = offsets - offsets[0]
        return before[offsets[1:]] - before[offsets[:-1]], parts, words, odd

    def _ids(self, chunks: list[str]) -> list[bytes]:
        """The ids of distinct chunks.  A full generation of the cache becomes the old one, whose chunks come back as
        they are met again, so common chunks are never merged anew."""
        if self.held > CACHE_BYTES:
            self.old, self.new, self.word_ids, self.held = self.new, {"": b""}, {}, 0
        new, old, missing = self.new, self.old.get, []
        parts = list(map(new.get, chunks))
        for i in [i for i, x in enumerate(parts) if x is None]:
            chunk = chunks[i]
            parts[i] = ids = old(chunk)
            if ids is None:
                missing.append(i)
            else:
                new[chunk] = ids
                self.held += ENTRY_BYTES + 2 * len(chunk)
        if missing:
            fresh = [chunks[i] for i in missing]
            self.held += ENTRY_BYTES * len(fresh) + 2 * sum(map(len, fresh))
            self._learn(fresh)
            for i, chunk in zip(missing, fresh):
                parts[i] = new[chunk]
        return parts


_CODECS: dict[str, WordCodec] = {}


def codec(path: str) -> WordCodec:
    if path not in _CODECS:
        _CODECS[path] = WordCodec(path)
    return _CODECS[path]
