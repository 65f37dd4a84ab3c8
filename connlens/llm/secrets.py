"""Secret scan: fixed patterns, and a battery of randomness tests for strings that no pattern knows.

Base spans are the leftmost non-overlapping matches of three patterns (assignments, access keys, hex strings).
Beside them, every run of 20 or more letters, digits and ``+/_-`` that mixes letters and digits and overlaps no
base span is a candidate.  From its characters an encoding is inferred (hex, base32, base36, base62, base64),
and with it the null hypothesis "each symbol is drawn evenly from this alphabet".  Three tests give p-values:
chi-squared uniformity over equal slices of the alphabet, runs above and below the alphabet's middle, and serial
correlation; Fisher's method combines them.  Ordinary identifiers, paths and words are rejected as random.

False discoveries (random strings rejected) are controlled over all candidates of the corpus by the weighted
Benjamini-Hochberg rule: p is divided by a weight in inverse proportion to length (mean one), as short strings
give the tests less power.  Candidates that are not rejected are added as spans of kind ``random``.  The rule
needs only a histogram of log p, whose bins are fixed, so nothing of unbounded size reaches the driver.

Defined results: a null text counts as empty and gives no spans; each row is scanned on its own, so repeated
rows and null ids give one result a row; offsets count code points, ends are exclusive; an empty table gives an
empty result; other columns do not matter (``redact`` carries them).
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from connlens.llm.bpe import slices, tidy
from connlens.session import materialize, ship_package

KINDS = ["assign", "access", "hex", "random"]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX_LEAST, CANDIDATE_LEAST = 24, 20
FDR = 0.05
#: log p is kept in bins of this width, down to FLOOR.
BIN, FLOOR = 0.01, -700.0
MARK = "[SECRET]"

_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdef")] = True
_RUN = np.zeros(256, bool)
_RUN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")] = True
_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
ENCODINGS = [("hex", _DIGITS + "abcdef"), ("hex", _DIGITS + "ABCDEF"), ("base32", _UPPER + "234567"), ("base36", _DIGITS + _LOWER),
             ("base36", _DIGITS + _UPPER), ("base62", _UPPER + _LOWER + _DIGITS), ("base64", _UPPER + _LOWER + _DIGITS + "+/"),
             ("base64url", _UPPER + _LOWER + _DIGITS + "-_"), ("any", _UPPER + _LOWER + _DIGITS + "+/-_")]
_SETS = [(name, set(a), {c: i for i, c in enumerate(a)}) for name, a in ENCODINGS]


def chi2_tail(x: float, df: int) -> float:
    """P(chi-squared with an even number of degrees of freedom > x)."""
    term = total = 1.0
    for k in range(1, df // 2):
        term *= x / 2 / k
        total += term
    return min(1.0, math.exp(-x / 2) * total)


def infer(string: str) -> tuple[str, dict[str, int]]:
    """The name and the symbol numbers of the smallest encoding with all the string's characters."""
    seen = set(string)
    return next((name, number) for name, have, number in _SETS if seen <= have)


def log_p(string: str) -> float:
    """The natural logarithm of the combined p-value of randomness, at least FLOOR."""
    _, number = infer(string)
    size, x = len(number), np.array([number[c] for c in string])
    n = len(x)
    slices_ = min(15, max(3, n // 5)) // 2 * 2 + 1
    slices_ -= 2 * (slices_ > 15)
    owner = np.arange(size) * slices_ // size
    expected = np.bincount(owner, minlength=slices_) * n / size
    uniform = chi2_tail(float(((np.bincount(owner[x], minlength=slices_) - expected) ** 2 / expected).sum()), slices_ - 1)
    above = x >= size / 2
    n1 = int(above.sum())
    n0 = n - n1
    if n1 and n0 and n > 2:
        mean = 2 * n1 * n0 / n + 1
        var = max((mean - 1) * (mean - 2) / (n - 1), 1e-9)
        z = (1 + int((above[1:] != above[:-1]).sum()) - mean) / math.sqrt(var)
        runs = math.erfc(abs(z) / math.sqrt(2))
    else:
        runs = 2.0 ** (1 - n)
    y = x - x.mean()
    power = float((y * y).sum())
    r = float((y[1:] * y[:-1]).sum()) / power if power else 1.0
    serial = math.erfc(abs(r + 1 / n) * math.sqrt(n / 2))
    total = sum(-math.log(max(p, 1e-100)) for p in (uniform, runs, serial))
    tail = chi2_tail(2 * total, 6)
    return max(FLOOR, math.log(tail)) if tail > 0 else max(FLOOR, -total + math.log(1 + total + total * total / 2))


def _long_runs(inside: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    edges = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    long = ends - starts >= least
    return starts[long], ends[long]


def scan_texts(texts: list[str]) -> list[tuple[list[tuple[int, int, int]], list[tuple[int, int, float]]]]:
    """For each text its base spans (start, number of the kind, end) in order, and its candidates (start, end, log p)."""
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"\n".join(raw), np.uint8)
    begin = np.concatenate(([0], np.cumsum([len(b) + 1 for b in raw]))).tolist()
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]

    def place(start: int, end: int) -> tuple[int, int, int]:
        i = bisect_right(begin, start) - 1
        s, e = start - begin[i], end - begin[i]
        if not texts[i].isascii():
            head = len(raw[i][:s].decode())
            s, e = head, head + e - s  # the characters of a run are one byte each
        return i, s, e

    for i, t in enumerate(texts):
        low = t.lower()
        if any(k in low for k in KEYWORDS):
            found[i] += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
        if "AKIA" in t:
            found[i] += [(m.start(), 1, m.end()) for m in ACCESS.finditer(t)]
    for start, end in zip(*(x.tolist() for x in _long_runs(_HEX[data], HEX_LEAST))):
        i, s, e = place(start, end)
        found[i].append((s, 2, e))
    more: list[list[tuple[int, int, float]]] = [[] for _ in texts]
    for start, end in zip(*(x.tolist() for x in _long_runs(_RUN[data], CANDIDATE_LEAST))):
        string = data[start:end].tobytes().decode()
        if any(c in _DIGITS for c in string) and any(c.isalpha() for c in string):
            i, s, e = place(start, end)
            if not any(a < e and s < b for a, _, b in found[i]):
                more[i].append((s, e, log_p(string)))
    return [(sorted(f), m) for f, m in zip(found, more)]


def scan(docs: DataFrame, id_col: str | None = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id (null without ``id_col``), base (array of start, kind number, end) and candidates (start, end, log_p),
    written to the shared folder; texts are not."""
    ship_package(docs.sparkSession)
    span = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
    maybe = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("log_p", pa.float64())]))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                out = scan_texts([t or "" for t in batch.column(1).to_pylist()])
                base = [[dict(zip(("start", "kind", "end"), x)) for x in f] for f, _ in out]
                more = [[dict(zip(("start", "end", "log_p"), x)) for x in m] for _, m in out]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, span), pa.array(more, maybe)], ["id", "base", "candidates"])

    key = F.col(f"`{id_col}`") if id_col else F.lit(None).cast("long")
    rows = docs.select(key.alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return materialize(rows.mapInArrow(run, f"id {kind}, base array<struct<start:long,kind:int,end:long>>, "
                                            "candidates array<struct<start:long,end:long,log_p:double>>"), "secret-scan")


def rejection_bound(scanned: DataFrame, fdr: float = FDR) -> tuple[float, float]:
    """(scale, bound): a candidate is rejected as random when log_p + log(length * scale) <= bound.

    With m candidates and weights w = 1 / (length * scale) of mean one, the bound is the largest bin edge t
    with exp(t) * m <= fdr * (number of candidates whose log(p / w) is at most t); -inf if there is none.
    """
    c = scanned.select(F.explode("candidates").alias("c")).select(F.col("c.log_p").alias("p"), (F.col("c.end") - F.col("c.start")).alias("n"))
    total, inverse = c.agg(F.count("*"), F.sum(1 / F.col("n"))).first()
    if not total:
        return 1.0, -math.inf
    scale = inverse / total
    edge = F.ceil((F.col("p") + F.log(F.col("n") * F.lit(scale))) / BIN)
    below, bound = 0, -math.inf
    for e, n in sorted(c.groupBy(F.greatest(edge, F.lit(int(FLOOR / BIN))).alias("e")).count().collect()):
        below += n
        if e * BIN + math.log(total) <= math.log(fdr * below):
            bound = e * BIN
    return scale, bound


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = FDR) -> DataFrame:
    """One row per input row: id, base and spans, both arrays of (start, kind number, end) in that order; ``spans``
    has the base spans and those the randomness tests add."""
    scanned = scan(docs, id_col, text_col)
    scale, bound = rejection_bound(scanned, fdr)
    kept = F.filter("candidates", lambda c: F.ceil((c["log_p"] + F.log((c["end"] - c["start"]) * F.lit(scale))) / BIN) * BIN > F.lit(bound))
    added = F.transform(kept, lambda c: F.struct(c["start"].alias("start"), F.lit(3).alias("kind"), c["end"].alias("end")))
    return scanned.select(F.col("id").alias(id_col), "base", F.array_sort(F.concat("base", added)).alias("spans"))


def as_text(column: str):
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = FDR) -> DataFrame:
    """One row per input row: id, n_assign, n_access, n_hex, base_sha256, spans and n_random."""
    def count(number: int):
        return F.size(F.filter("spans", lambda s: s["kind"] == number)).cast("long")
    found = spans(docs, id_col, text_col, fdr)
    return found.select(id_col, count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(as_text("base"), 256).alias("base_sha256"), as_text("spans").alias("spans"), count(3).alias("n_random"))


def masked(text: str, hit: list[tuple[int, int]], mark: str = MARK) -> str:
    """The text with the union of the spans replaced by the mark."""
    out, at = [], 0
    for start, end in sorted(hit):
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], mark]
        at = end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text", fdr: float = FDR, mark: str = MARK, length_col: str | None = None) -> DataFrame:
    """The input rows with every span of their text replaced by ``mark``; no row is dropped and no other column
    changes, but ``length_col``, if given, holds the new length."""
    ship_package(docs.sparkSession)
    scale, bound = rejection_bound(scan(docs, None, text_col), fdr)
    at = docs.columns.index(text_col)

    def kept(c: tuple[int, int, float]) -> bool:
        return math.ceil((c[2] + math.log((c[1] - c[0]) * scale)) / BIN) * BIN > bound

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, at):
                column = batch.column(at).to_pylist()
                found = scan_texts([t or "" for t in column])
                new = [t and masked(t, [(s, e) for s, _, e in f] + [c[:2] for c in m if kept(c)], mark) for t, (f, m) in zip(column, found)]
                yield batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn(length_col, F.length(text_col).cast(docs.schema[length_col].dataType)) if length_col else out
