"""Hard negatives from Hilbert-ordered candidate blocks with zone maps.

Candidates are sorted by label and by their place on a Hilbert curve through the ``DIMS`` dimensions of largest
spread, cut into blocks of ``BLOCK`` rows, and written as Parquet: a row a block, its vectors in one binary column,
beside them the block's zone map (least and largest value of every dimension, its labels, its least id).  Interval
arithmetic on a zone map bounds the inner product of an anchor with every row of the block from above and below,
from narrow columns only.

An anchor has a same-label search (its positives) and, for each positive, a window of scores in which it wants the
best rows of other labels.  Every search first reads the one block that its bounds favour; the k-th score found there
is then a threshold, and the second reading takes every block whose bounds reach into the window at or above it
(at it, only if the block has a lesser id than the k-th row).  So results are exact, however well the bounds prune.

Scale.  Bounds are computed chunk of anchors by chunk of zone maps; anchors go to the blocks they must read, and each
block streams past its anchors, so a task holds one block and a batch of anchors.  Equal vectors, labels with most
of the rows, or anchors that read every block make more blocks or rows, never a larger task.  In data without
clusters bounds in many dimensions are loose, and an anchor reads most blocks of its labels: then the work is that
of all stated anchors against all rows, in blocks.

Defined results: rows with a null label, a null vector, or a null or non-finite component take no part; shorter
vectors count as filled up with zeros; repeated rows are rows of their own (an anchor's other copies can be its
positives, and each copy of an anchor has its own results); ties go by id, null ids last; an empty table gives an
empty result; other columns, whatever their names, do not matter.  Inner products must stay below 2**53.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from connlens.llm.bpe import tidy
from connlens.session import materialize, ship_package

BLOCK, CHUNK = 1024, 1024
DIMS, BITS = 15, 4
POSITIVES, NEGATIVES = 5, 10
SCALE = 256
NO_ID = 2**63 - 1


def hilbert(levels: np.ndarray, bits: int) -> np.ndarray:
    """The place on the Hilbert curve (long) of each row of ``levels`` (n x d, values below 2**bits, d * bits < 64)."""
    x = [c.astype(np.int64) for c in levels.T]
    d = len(x)
    for low in (1 << b for b in range(bits - 1, 0, -1)):  # undo the turns of the finer levels
        mask = low - 1
        for i in range(d):
            set_ = (x[i] & low) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & mask)
            x[0] = np.where(set_, x[0] ^ mask, x[0]) ^ swap
            if i:
                x[i] = x[i] ^ swap
    for i in range(1, d):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    for low in (1 << b for b in range(bits - 1, 0, -1)):
        turn = np.where(x[-1] & low, turn ^ (low - 1), turn)
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for c in x:
            out = out << 1 | ((c ^ turn) >> b & 1)
    return out


def quantised(vectors: DataFrame, id_col: str, vec_col: str, label: Column, scale: int = SCALE) -> DataFrame:
    """row, id, label and vec (floor(scale * x)) of the rows that take part."""
    vec = F.col(f"`{vec_col}`")
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(label.isNotNull() & vec.isNotNull() & fine)
    return rows.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("long").alias("label"),
                       F.transform(vec, lambda x: F.floor(x.cast("double") * scale)).alias("vec"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """An array<long> column as a matrix, short rows filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == dims).all():
        return flat.reshape(len(sizes), dims).astype(float)
    out = np.zeros((len(sizes), dims))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def spreads(rows: DataFrame) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """The number of rows, and each dimension's mean, standard deviation and largest size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(k, 4096) for k in range(0, batch.num_rows, 4096)):
                column = part.column(0)
                x = _matrix(column, int(np.diff(column.offsets.to_numpy()).max(initial=0)))
                cols = np.arange(x.shape[1]), np.full(x.shape[1], len(x)), x.sum(0), (x * x).sum(0), np.abs(x).max(0, initial=0)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), *[pa.float64()] * 3))], ["dim", "n", "s", "q", "m"])

    parts = rows.select("vec").mapInArrow(run, "dim long, n long, s double, q double, m double")
    found = parts.groupBy("dim").agg(F.sum("s").alias("s"), F.sum("q").alias("q"), F.max("m").alias("m")).orderBy("dim").collect()  # one row a dimension
    n = rows.count()
    mean = np.array([r["s"] for r in found]) / max(n, 1)
    square = np.array([r["q"] for r in found]) / max(n, 1)
    return n, mean, np.sqrt(np.maximum(square - mean**2, 0)), np.array([r["m"] for r in found])


BLOCKS = "block long, n long, least_id long, label_lo long, label_hi long, lo array<long>, hi array<long>, rows binary, ids binary, labels binary, vectors binary"


def write_blocks(rows: DataFrame, n: int, mean: np.ndarray, spread: np.ndarray, largest: np.ndarray, size: int = BLOCK) -> DataFrame:
    """The candidate blocks, written as Parquet (columns ``BLOCKS``); rows of a block are in the order of their ids."""
    dims = len(mean)
    chosen = np.sort(np.argsort(-spread, kind="stable")[:DIMS])
    narrow = np.int16 if largest.max(initial=0) < 2**15 else np.int64

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(3), dims)[:, chosen]
            levels = np.floor((x - mean[chosen] + 2 * spread[chosen]) / np.maximum(4 * spread[chosen], 1e-300) * 2**BITS)
            place = hilbert(np.clip(levels, 0, 2**BITS - 1).astype(np.int64), BITS) if dims else np.zeros(batch.num_rows, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], [*batch.schema.names, "place"])

    @tidy
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, made = [], 0, 0
        first = TaskContext.get().partitionId() << 32
        for batch in batches:
            while batch.num_rows:
                some = batch.slice(0, size - count)
                held.append(some)
                count, batch = count + some.num_rows, batch.slice(some.num_rows)
                if count == size:
                    yield block(pa.Table.from_batches(held), first + made)
                    held, count, made = [], 0, made + 1
        if held:
            yield block(pa.Table.from_batches(held), first + made)

    def block(table: pa.Table, name: int) -> pa.RecordBatch:
        ids = table["id"].fill_null(NO_ID).to_numpy()
        order = np.argsort(ids, kind="stable")
        x, labels = _matrix(table["vec"], dims)[order], table["label"].to_numpy()[order]
        lo, hi = x.min(0).astype(np.int64).tolist(), x.max(0).astype(np.int64).tolist()
        one = [name, len(x), int(ids.min()), int(labels.min()), int(labels.max()), lo, hi, table["row"].to_numpy()[order].astype(np.int64).tobytes(),
               ids[order].astype(np.int64).tobytes(), labels.astype(np.int64).tobytes(), x.astype(narrow).tobytes()]
        kinds = [*[pa.int64()] * 5, *[pa.list_(pa.int64())] * 2, *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(one, kinds)], [f.split()[0] for f in BLOCKS.split(", ")])

    placed = rows.select("row", "id", "label", "vec").mapInArrow(keys, "row long, id long, label long, vec array<long>, place long")
    dealt = placed.repartitionByRange(max(1, -(-n // (size * 16))), "label", "place", F.xxhash64("row")).sortWithinPartitions("label", "place")
    return materialize(dealt.mapInArrow(pack, BLOCKS), "candidate-blocks")


def bounds(anchors: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest inner product (anchors x zones) that interval arithmetic allows."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return up @ lo.T + down @ hi.T, up @ hi.T + down @ lo.T


def _chosen(searches: DataFrame, zones: DataFrame, dims: int, same: bool, sizes: tuple[int, int], first: bool) -> DataFrame:
    """(row, j, block, rate): with ``first``, of a chunk of zone maps the block that each search favours; else
    every block that it must read (j is then 0).  ``searches``: row, label, vec, and arrays over the searches j of lo,
    hi, least (the k-th score so far, or null), least_id (the k-th id), had (the block read first)."""
    chunks = [max(1, -(-s // CHUNK)) for s in sizes]

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    left = searches.withColumn("p", F.pmod(F.xxhash64("row"), F.lit(chunks[0]))).withColumn("q", every(chunks[1]))
    right = zones.withColumn("q", F.pmod(F.xxhash64("block"), F.lit(chunks[1]))).withColumn("p", every(chunks[0]))

    def run(own: pa.Table, maps: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, float]] = []
        if own.num_rows and maps.num_rows:
            low, high = bounds(_matrix(own["vec"], dims), _matrix(maps["lo"], dims), _matrix(maps["hi"], dims))
            label, names = own["label"].to_numpy()[:, None], maps["block"].to_numpy()
            label_lo, label_hi, ids = (maps[c].to_numpy() for c in ("label_lo", "label_hi", "least_id"))
            able = (label_lo <= label) & (label <= label_hi) if same else ~((label_lo == label) & (label_hi == label))
            wants = zip(own["row"].to_pylist(), *(own[c].to_pylist() for c in ("lo", "hi", "least", "least_id", "had")))
            for i, (row, los, his, least, least_ids, had) in enumerate(wants):
                wanted = np.zeros(len(names), bool)
                for j, (a, b, t, t_id, h) in enumerate(zip(los, his, least, least_ids, had)):
                    reach = able[i] & (high[i] >= a) & (low[i] <= b)
                    if first:
                        at = np.flatnonzero(reach)
                        if len(at):  # the block whose middle is nearest to the window's upper end
                            rate = -np.abs(np.minimum(b, high[i][at]) - (low[i][at] + high[i][at]) / 2) if b < 2**60 else high[i][at]
                            best = int(np.argmax(rate))
                            out.append((row, j, int(names[at[best]]), float(rate[best])))
                    else:
                        if t is not None:
                            reach &= (high[i] > t) | ((high[i] == t) & (ids < t_id))
                        wanted |= reach & (names != (-1 if h is None else h))
                out += [(row, 0, int(b), 0.0) for b in names[wanted]] if not first else []
        cols = list(zip(*out)) or [[]] * 4
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("row", "j", "block", "rate"), cols, (pa.int64(), pa.int64(), pa.int64(), pa.float64()))})

    return left.groupBy("p", "q").cogroup(right.groupBy("p", "q")).applyInArrow(run, "row long, j long, block long, rate double")


def _read(pairs: DataFrame, searches: DataFrame, blocks: DataFrame, dims: int, same: bool, k: int) -> DataFrame:
    """The best k rows (row, j, score, id, other, block) of every search in the blocks ``pairs`` (row, block) names."""
    tasks = pairs.join(searches.select("row", "label", "vec", "lo", "hi"), "row")
    fields = ["rows", "ids", "labels", "vectors"]
    tasks = tasks.select("block", F.lit(True).alias("anchor"), "row", "label", "vec", "lo", "hi", *[F.lit(None).cast("binary").alias(f) for f in fields])
    none = {"row": "long", "label": "long", "vec": "array<long>", "lo": "array<long>", "hi": "array<long>"}
    wanted = blocks.join(pairs.select("block").distinct(), "block", "left_semi")
    wanted = wanted.select("block", F.lit(False).alias("anchor"), *[F.lit(None).cast(t).alias(c) for c, t in none.items()], *fields)
    dealt = tasks.unionByName(wanted).repartition("block").sortWithinPartitions("block", "anchor")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for whole in batches:
            names, is_anchor = whole.column(0).to_numpy(), whole.column(1).to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((names[1:] != names[:-1]) | (is_anchor[1:] != is_anchor[:-1])) + 1
            for a, b in zip([0, *edges], [*edges, len(names)]):
                if not is_anchor[a]:
                    rows, ids, labels = (np.frombuffer(whole.column(c)[a].as_py(), np.int64) for c in (7, 8, 9))
                    raw = whole.column(10)[a].as_py()
                    kind = np.int16 if len(raw) == 2 * len(rows) * dims else np.int64
                    held = rows, ids, labels, np.frombuffer(raw, kind).reshape(len(rows), dims).astype(float)
                    continue
                for start in range(a, b, 256):
                    yield scored(whole.slice(start, min(256, b - start)), held, int(names[a]))

    def scored(part: pa.RecordBatch, held, block: int) -> pa.RecordBatch:
        rows, ids, labels, vectors = held
        score = _matrix(part.column(4), dims) @ vectors.T
        order = np.argsort(-score, axis=1, kind="stable")  # rows lie in the order of ids
        out = []
        for i, (row, label, los, his) in enumerate(zip(*(part.column(c).to_pylist() for c in (2, 3, 5, 6)))):
            at = order[i]
            fine = (labels[at] == label) & (rows[at] != row) if same else labels[at] != label
            at = at[fine]
            value = score[i][at]
            for j, (low, high) in enumerate(zip(los, his)):
                for p in at[np.flatnonzero((value >= low) & (value <= high))[:k]]:
                    out.append((row, j, int(score[i][p]), int(ids[p]) if ids[p] != NO_ID else None, int(rows[p]), block))
        cols = list(zip(*out)) or [[]] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["row", "j", "score", "id", "other", "block"])

    return dealt.mapInArrow(run, "row long, j long, score long, id long, other long, block long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("row", "j").orderBy(F.desc("score"), F.asc_nulls_last("id"), "other")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(searches: DataFrame, blocks: DataFrame, dims: int, same: bool, k: int, sizes: tuple[int, int]) -> DataFrame:
    """The best k rows of each search: row, j, rank, score, id, other.  ``searches``: row, label, vec, lo, hi (arrays
    with an inclusive score window for each j); ``same``: rows of the anchor's label, else of any other."""
    zones = blocks.select("block", "least_id", "label_lo", "label_hi", "lo", "hi")
    fresh = searches.select("*", *[F.transform("lo", lambda x: F.lit(None).cast("long")).alias(c) for c in ("least", "least_id", "had")])
    one = _chosen(fresh, zones, dims, same, sizes, True).groupBy("row", "j").agg(F.max_by("block", F.struct("rate", "block")).alias("block"))
    one = materialize(one, "first-blocks")
    seen = materialize(_read(one.select("row", "block").distinct(), searches, blocks, dims, same, k), "first-rows")
    kth = _best(seen, k).groupBy("row", "j").agg(F.count("*").alias("n"), F.min("score").alias("score"), F.max_by(F.coalesce("id", F.lit(NO_ID)), "rank").alias("id"))
    state = one.join(kth, ["row", "j"], "left").select("row", F.struct("j", F.when(F.col("n") == k, F.col("score")).alias("t"), F.when(F.col("n") == k, F.col("id")).alias("i"), "block").alias("s"))
    state = state.groupBy("row").agg(F.array_sort(F.collect_list("s")).alias("s"))  # one entry a search of the anchor
    known = searches.join(state, "row").withColumn("m", F.map_from_arrays("s.j", "s"))

    def by_search(name: str) -> Column:
        return F.transform("lo", lambda x, j: F.try_element_at("m", j.cast("long")).getField(name))

    above = F.transform("lo", lambda x, j: F.greatest(x, F.try_element_at("m", j.cast("long")).getField("t")))  # rows below the k-th are not wanted
    known = materialize(known.select("row", "label", "vec", above.alias("lo"), "hi", by_search("t").alias("least"), by_search("i").alias("least_id"), by_search("block").alias("had")), "searches")
    more = materialize(_chosen(known, zones, dims, same, sizes, False).select("row", "block"), "more-blocks")
    rest = _read(more, known, blocks, dims, same, k)
    return _best(seen.unionByName(rest).dropDuplicates(["row", "j", "other"]), k).select("row", "j", "rank", "score", "id", "other")


def mine(vectors: DataFrame, anchor: Column, label: Column, id_col: str = "vec_id", vec_col: str = "embedding", positives: int = POSITIVES,
         negatives: int = NEGATIVES, window: tuple[int, int] = (30, 90), size: int = BLOCK) -> DataFrame:
    """Of each anchor (a row for which ``anchor``, over its id as column ``id``, holds) and each of its best ``positives``
    rows of the same label, the best ``negatives`` rows of other labels whose score lies between window[0] and
    window[1] per cent of the positive's: anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    ship_package(vectors.sparkSession)
    rows = materialize(quantised(vectors, id_col, vec_col, label), "quantised")
    n, mean, spread, largest = spreads(rows)
    if (largest**2).sum() >= 2**53:
        raise ValueError("components too large for exact scores")
    blocks = write_blocks(rows, n, mean, spread, largest, size)
    anchors = materialize(rows.where(anchor), "anchors")
    dims, sizes = len(mean), (anchors.count(), blocks.count())
    everything = [F.array(F.lit(x).cast("long")).alias(c) for c, x in (("lo", -(2**62)), ("hi", 2**62))]
    best = materialize(search(anchors.select("row", "label", "vec", *everything), blocks, dims, True, positives, sizes), "positives")
    least, most = window
    fits = best.where("score >= 0").select("row", F.struct("rank", F.expr(f"({least} * score + 99) div 100").alias("lo"), F.expr(f"{most} * score div 100").alias("hi"), "id", "score").alias("w"))
    windows = anchors.join(fits.groupBy("row").agg(F.array_sort(F.collect_list("w")).alias("w")), "row")
    windows = materialize(windows.select("row", "label", "vec", F.col("w.lo").alias("lo"), F.col("w.hi").alias("hi"), F.col("id").alias("anchor_id"), "w"), "windows")
    found = search(windows.select("row", "label", "vec", "lo", "hi"), blocks, dims, False, negatives, sizes)
    own = windows.select("row", "anchor_id", F.posexplode("w").alias("j", "w")).select("row", "anchor_id", F.col("j").cast("long").alias("j"), F.col("w.id").alias("positive_id"), F.col("w.score").alias("positive_score"))
    return found.join(own, ["row", "j"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def report(vectors: DataFrame) -> DataFrame:
    """Anchors: ids divisible by 100.  Where the id is divisible by 7, the label is the next one modulo 10."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors, F.col("id") % 100 == 0, label)


REPORT_SQL = """
WITH own AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS s
  FROM own a JOIN own b ON a.r <> b.r WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT a, b, vec_id, s FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, vec_id NULLS LAST, b) <= 5)
SELECT n.anchor_id, p.vec_id AS positive_id, row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.s DESC, n.vec_id NULLS LAST, n.b)::INT AS rank,
       n.vec_id AS negative_id, p.s AS positive_score, n.s AS negative_score
FROM positives p JOIN scored n ON n.a = p.a AND NOT n.same AND 30 * p.s <= 100 * n.s AND 100 * n.s <= 90 * p.s
QUALIFY row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.s DESC, n.vec_id NULLS LAST, n.b) <= 10
"""
