"""Vector best-fit packing of tokenised documents into training sequences.

A document is its ids and an end id.  Only documents longer than a sequence are cut, into pieces of exactly one
sequence; the last piece may be shorter.  Every piece is a vector: its tokens, one document, and the square of
its length (the cost of attention within it).  A sequence has a capacity in each.  In order of falling length,
a piece goes to the open sequence that fits it in every capacity and is best by one of two rules:

* ``norm``: the smallest weighted norm of what remains after placing it;
* ``dot``: the largest weighted dot-product of the piece and what remains;

and opens a new sequence only if it fits in none.  The pieces are dealt evenly by row number into groups of
about ``group_rows`` (bounded memory, one task each); each group may waste at most its last few sequences.

Defined results: a null or empty text is the end id alone; null and repeated ids are packed row by row; an empty
table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from connlens.llm.bpe import slices, tidy
from connlens.llm.word_bpe import codec
from connlens.session import materialize, ship_package

SEQUENCE_TOKENS = 4096
END_ID = 1
GROUP_ROWS = 20_000
BATCH_BYTES = 4 << 20
#: Weights of tokens, documents and attention cost, each as a share of its capacity.
WEIGHTS = (1.0, 0.02, 0.02)
PIECES = "piece int, start long, length long, ids_crc32 long, ids binary"


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", most: int = SEQUENCE_TOKENS,
           end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32 and, with ``with_ids``, ids (binary, little-endian
    unsigned 32-bit; else null)."""
    ship_package(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for whole in batches:
            for batch in slices(whole, 1, BATCH_BYTES):
                row, cols = [], ([], [], [], [], [])
                for i, ids in enumerate(own.encode_all(batch.column(1))):
                    ids += end
                    for k in range(0, len(ids), 4 * most):
                        part = ids[k:k + 4 * most]
                        row.append(i)
                        for col, value in zip(cols, (k // (4 * most), k // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None)):
                            col.append(value)
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64()))] + [pa.array(c, k) for c, k in zip(cols, kinds)],
                                                 ["id", "piece", "start", "length", "ids_crc32", "ids"])

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    out = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, {PIECES}").withColumnRenamed("id", id_col)
    return out if with_ids else out.drop("ids")


def best_fit(lengths: np.ndarray, capacities: tuple[float, float, float], rule: str = "norm",
             weights: tuple[float, float, float] = WEIGHTS) -> tuple[np.ndarray, np.ndarray]:
    """The sequence of each piece, and the piece's offset there."""
    size, cap, w = len(lengths), np.array(capacities, float), np.array(weights, float)
    need = np.stack([lengths, np.ones(size), lengths.astype(float) ** 2], 1) / cap
    if (need > 1).any():
        raise ValueError("a piece exceeds a capacity of an empty sequence")
    if rule not in ("norm", "dot"):
        raise ValueError("rule is 'norm' or 'dot'")
    order = np.argsort(-lengths, kind="stable")
    left, name, count = np.empty((size, 3)), np.empty(size, np.int64), 0  # the open sequences, the first ``count`` rows
    used, place, offset = np.zeros(size, np.int64), np.empty(size, np.int64), np.empty(size, np.int64)
    least, made = need.min(0) if size else cap, 0
    for step, i in enumerate(order):
        if step % 256 == 0 and count:  # forget sequences that can take no piece any more
            stay = np.flatnonzero((left[:count] >= least - 1e-12).all(1))
            left[:len(stay)], name[:len(stay)], count = left[stay], name[stay], len(stay)
        rest = left[:count] - need[i]
        fits = np.flatnonzero((rest >= -1e-12).all(1))
        if len(fits):
            if rule == "norm":
                at = fits[np.argmin((rest[fits] ** 2) @ w)]
            else:
                at = fits[np.argmax(left[fits] @ (w * need[i]))]
        else:
            at, count, made = count, count + 1, made + 1
            left[at], name[at] = 1.0, made - 1
        left[at] -= need[i]
        place[i] = name[at]
        offset[i] = used[place[i]]
        used[place[i]] += lengths[i]
    return place, offset


def pack(parts: DataFrame, most: int = SEQUENCE_TOKENS, documents: int = SEQUENCE_TOKENS, attention: int = SEQUENCE_TOKENS**2,
         rule: str = "norm", weights: tuple[float, float, float] = WEIGHTS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``parts`` (with a length column; no column __row, __group) and sequence_id and offset of each row."""
    ship_package(parts.sparkSession)
    kept = materialize(parts.withColumn("__row", F.monotonically_increasing_id()), "pieces")
    groups = max(1, -(-kept.count() // group_rows))
    dealt = kept.withColumn("__group", F.pmod(F.xxhash64("__row"), F.lit(groups)))
    names = parts.columns

    def run(table: pa.Table) -> pa.Table:
        place, offset = best_fit(table["length"].to_numpy(), (most, documents, attention), rule, weights)
        group = table["__group"][0].as_py()
        return table.select(names).append_column("sequence_id", pa.array((group << 32) + place)).append_column("offset", pa.array(offset))

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema.fields]
    return dealt.groupBy("__group").applyInArrow(run, ", ".join([*fields, "sequence_id long", "offset long"]))


def sequences(packed: DataFrame) -> DataFrame:
    """The token ids (binary) of each sequence, from packed pieces made ``with_ids``.  A sequence has at most
    ``most`` tokens, so a group is bounded."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(inside.alias("p")).select("sequence_id", F.expr("aggregate(p, X'', (a, x) -> concat(a, x.ids))").alias("ids"))
