"""Near-duplicate documents by dart-throwing weighted MinHash.

A text's elements are its five-word shingles (words between ASCII white space; a shorter text is one shingle),
weighted by how often they occur.  Two texts are linked when their weighted Jaccard similarity, the sum of the
smaller weights over the sum of the larger, is at least 0.8.

Signature.  Every unit of weight of an element is a region; hashed darts land in it one after another, at ranks
whose gaps are exponential, each aimed at one of ``k`` coordinates.  A text gets the darts that hit its regions
up to the rank by which k ln k + 2k darts are expected (doubled while a coordinate is still empty), and keeps
the earliest at each coordinate.  So the work is one hash an element and a few hundred darts a text, however
large the text, and two texts agree at a coordinate with the probability of their similarity.

Joining.  Coordinates are banded by ``ROWS``; at similarity 0.8 a pair shares no band with probability
(1 - 0.8**4)**24 < 4e-6.  Copies of a text are one node.  Every text is compared with the least text of all its
buckets, so n near copies cost n comparisons, whatever buckets they share; then with the least texts of those
buckets in which it is still in another component.  Buckets whose texts are then still in several components are
finished exactly: the texts outside the least one's component against all, in blocks of bounded size spread over
tasks; within a block, components already linked are not linked again.  Every
comparison is exact, on the shingles themselves.  Classes are the connected components of the links.

Defined results: a null text counts as empty; texts without words form a class with their exact copies only;
equal rows are copies; the class id is the least id in the class, null ids last; an empty table gives an empty
result; further columns, whatever their names, are ignored or carried (``kept_rows``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from connlens.llm.bpe import slices, tidy
from connlens.llm.bytetext import joined, mixed, span_hashes, words
from connlens.llm.common import field, lookup_skew_safe, packed
from connlens.llm.components import components
from connlens.session import materialize, ship_package

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 24, 4
BLOCK = 250_000  # units of a block of rows in the exact finish
CENTER_ROWS = 256
BATCH_BYTES = 1 << 20

_INSIDE = np.ones(256, bool)
_INSIDE[[32, *range(9, 14)]] = False
_ODD = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F], np.uint64)
_U = np.uint64


def elements(texts: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct shingles' hashes, their weights (occurrences) and the text of each, sorted by text and hash."""
    data, begin = joined(texts)
    found = words(data, begin, _INSIDE)
    hashes = span_hashes(data, found.start, found.end)
    count = np.bincount(found.text, minlength=len(texts))
    first = np.cumsum(count) - count
    shingles = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    owner = np.repeat(np.arange(len(texts)), shingles)
    at = first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    value = np.zeros(len(owner), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(size):
            inside = j < count[owner]
            value[inside] += hashes[at[inside] + j] * (_ODD[j % len(_ODD)] + _U(2 * (j // len(_ODD))))
    value = mixed(value)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    start = np.flatnonzero(new)
    return value[start], np.diff(np.append(start, len(value))).astype(float), owner[start]


def regions(value: np.ndarray, weight: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A hash for every started unit of weight, the filled part of that unit (1 but for the last), and its text."""
    units = np.ceil(weight).astype(np.int64)
    at = np.repeat(np.arange(len(value)), units)
    unit = np.arange(len(at)) - np.repeat(np.cumsum(units) - units, units)
    with np.errstate(over="ignore"):
        name = mixed(value[at] + unit.astype(np.uint64) * _ODD[0])
    return name, np.minimum(1.0, weight[at] - unit), owner[at]


def _share(x: np.ndarray) -> np.ndarray:
    """Numbers spread evenly over (0, 1]."""
    return ((x >> _U(11)).astype(float) + 1) * 2.0**-53


def dart_signatures(name: np.ndarray, filled: np.ndarray, owner: np.ndarray, texts: int, k: int = BANDS * ROWS) -> np.ndarray:
    """For each text and coordinate the earliest dart (its 64-bit name; 0 throughout for a text without weight)."""
    total = np.bincount(owner, filled, texts)
    limit = np.divide(k * np.log(k) + 2 * k, total, out=np.zeros(texts), where=total > 0)
    out = np.zeros((texts, k), np.uint64)
    todo = total > 0
    while todo.any():
        at = np.flatnonzero(todo[owner])
        rank, turn = np.zeros(len(at)), 0
        darts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(at):  # the next dart in every region that is not past its text's limit
            turn += 1
            with np.errstate(over="ignore"):
                dart = mixed(name[at] ^ (_ODD[1] * _U(turn)))
            rank = rank - np.log(_share(dart))
            near = rank <= limit[owner[at]]
            at, rank, dart = at[near], rank[near], dart[near]
            part = filled[at]
            hit = (part >= 1) | (_share(mixed(dart ^ _ODD[2])) <= part)
            darts.append((at[hit], rank[hit], dart[hit]))
        at, rank, dart = (np.concatenate(x) for x in zip(*darts))
        cell = owner[at] * k + (mixed(dart ^ _ODD[3]) % _U(k)).astype(np.int64)
        order = np.lexsort((rank, cell))
        cell, dart = cell[order], dart[order]
        first = np.flatnonzero(np.diff(cell, prepend=-1))
        flat = np.zeros(texts * k, np.uint64)
        flat[cell[first]] = mixed(dart[first]) | _U(1)
        full = todo & (np.bincount(cell[first] // k, minlength=texts) == k)
        out[full] = flat.reshape(texts, k)[full]
        todo &= ~full
        limit[todo] *= 2
    return out


def band_hashes(signatures: np.ndarray, rows: int = ROWS) -> np.ndarray:
    bands = signatures.shape[1] // rows
    with np.errstate(over="ignore"):
        parts = signatures.reshape(len(signatures), bands, rows) * _ODD[:rows] + np.arange(rows, dtype=np.uint64)
        return mixed(parts.sum(2, dtype=np.uint64) + (np.arange(bands, dtype=np.uint64) + _U(1)) * _ODD[5])


def _lists(value: np.ndarray, owner: np.ndarray, texts: int) -> pa.ListArray:
    cuts = np.searchsorted(owner, np.arange(texts + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(cuts), pa.array(value.view(np.int64)))


def signatures(rows: DataFrame) -> DataFrame:
    """``rows`` (id, text): id, digest (binary) and bands (array of longs, empty for a text without words)."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1, BATCH_BYTES):
                texts = [t or "" for t in batch.column(1).to_pylist()]
                n = len(texts)
                name, filled, owner = regions(*elements(texts))
                bands = band_hashes(dart_signatures(name, filled, owner, n))
                some = np.bincount(owner, minlength=n) > 0
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), _lists(bands[some].ravel(), np.repeat(np.flatnonzero(some), BANDS), n)], ["id", "digest", "bands"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.withColumn("digest", _digest(F.col("text"))).mapInArrow(run, f"id {kind}, digest binary, bands array<long>")


def _digest(text):
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def shingle_sets(rows: DataFrame) -> DataFrame:
    """``rows`` (row, text): row and units, the hashes of the text's units of weight, whose plain Jaccard
    similarity is the weighted one of the texts."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1, BATCH_BYTES):
                texts = [t or "" for t in batch.column(1).to_pylist()]
                name, _, owner = regions(*elements(texts))
                order = np.lexsort((name, owner))
                yield pa.RecordBatch.from_arrays([batch.column(0), _lists(name[order], owner[order], len(texts))], ["row", "units"])

    return rows.mapInArrow(run, "row long, units array<long>")


def _shared(units: np.ndarray, lists: pa.Array) -> np.ndarray:
    """How many of ``units`` (sorted) each list of distinct numbers holds."""
    flat, cuts = lists.flatten().to_numpy(), lists.offsets.to_numpy()
    at = np.searchsorted(units, flat)
    hit = np.concatenate(([0], np.cumsum(units[np.minimum(at, len(units) - 1)] == flat))) if len(units) else np.zeros(len(flat) + 1, int)
    cuts = cuts - cuts[0]
    return hit[cuts[1:]] - hit[cuts[:-1]]


def _close(units: int, sizes: np.ndarray, both: np.ndarray, least: float) -> np.ndarray:
    return (both > 0) & (both >= least * (units + sizes - both))


def _linked(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a: center, b: row) of ``pairs`` (row, center) whose texts are similar.  A center's set is sent once to
    every ``CENTER_ROWS`` of its rows, a row's set once a pair; a task holds one center's set and a batch of rows."""
    counts = materialize(pairs.groupBy(F.col("center").cast("string").alias("k")).agg(F.count("*").alias("n")), "center-sizes")
    chunks = F.ceil(F.col("n") / CENTER_ROWS).alias("chunks")
    dealt = lookup_skew_safe(pairs.withColumn("k", F.col("center").cast("string")), "k", counts, ["n"], "n", F.concat_ws(":", F.lit("hot"), "row", "center"))
    members = dealt.select("center", "row", F.pmod(F.xxhash64("row"), chunks).alias("chunk")).join(sets, "row").withColumn("member", F.lit(True))
    heads = counts.select(F.col("k").cast("long").alias("center"), chunks).join(sets.withColumnRenamed("row", "center"), "center")
    heads = heads.select("center", F.col("center").alias("row"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), "units", F.lit(False).alias("member"))
    both = members.select("center", "row", "chunk", "units", "member").unionByName(heads)
    ready = both.repartition("center", "chunk").sortWithinPartitions("center", "chunk", "member")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = None
        for whole in batches:
            center, member, row = (whole.column(c).to_numpy(zero_copy_only=False) for c in (0, 4, 1))
            starts = np.flatnonzero(~member)  # every head begins its own group
            a, b = [], []
            for at, end in zip([0, *starts], [*starts, len(row)]):
                if at < end and not member[at]:
                    units, at = np.sort(whole.column(3)[int(at)].values.to_numpy()), at + 1
                if at < end:
                    lists = whole.column(3).slice(int(at), int(end - at))
                    hit = _close(len(units), np.diff(lists.offsets.to_numpy()), _shared(units, lists), least)
                    a.append(center[at:end][hit])
                    b.append(row[at:end][hit])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else [], pa.int64()) for x in (a, b)], ["a", "b"])

    return ready.select("center", "row", "chunk", "units", "member").mapInArrow(run, "a long, b long")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (row, center) whose texts lie in different components."""
    centers = pairs.groupBy("center").agg(F.count("*").alias("n")).join(roots, F.col("center") == F.col("node"), "left")
    centers = materialize(centers.select(F.col("center").cast("string").alias("k"), "n", F.coalesce("root", "center").alias("its")), "center-roots")
    own = pairs.join(roots, F.col("row") == F.col("node"), "left").select("row", "center", F.coalesce("root", "row").alias("own"), F.col("center").cast("string").alias("k"))
    named = lookup_skew_safe(own, "k", centers, ["its"], "n", F.concat_ws(":", F.lit("hot"), "row", "center"))
    return named.where("own <> its").select("row", "center")


def _finish(inside: DataFrame, roots: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Links (a, b) between different components within buckets: ``inside`` has bucket, row, center and n."""
    named = inside.where("n > 2").join(roots, F.col("row") == F.col("node"), "left").withColumn("label", F.coalesce("root", "row")).select("bucket", "row", "center", "label")
    named = materialize(named, "labelled-buckets")
    per = (named.groupBy("bucket").agg(F.count("*").alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi"),
                                       F.max(F.when(F.col("row") == F.col("center"), F.col("label"))).alias("main"),
                                       F.bit_xor(F.xxhash64("row")).alias("x"), F.bit_xor(F.xxhash64("row", F.lit(1))).alias("y")).where("lo < hi"))
    one = per.groupBy("n", "x", "y").agg(F.min(F.struct("bucket", "main")).alias("b")).select("b.bucket", "b.main", "n")  # equal buckets count once
    one = materialize(one.withColumn("k", F.col("bucket").cast("string")).drop("bucket"), "open-buckets")
    if one.isEmpty():
        return inside.sparkSession.createDataFrame([], "a long, b long")
    spread = F.concat_ws(":", F.lit("hot"), "row", "bucket")
    left = lookup_skew_safe(named.withColumn("k", F.col("bucket").cast("string")), "k", one, ["main"], "n", spread, keep="inner")
    left = materialize(left.join(sets.select("row", F.size("units").alias("size")), "row"), "open-bucket-rows")
    # blocks of about BLOCK units, however many rows that is
    weight = F.sum("size")
    sizes = left.groupBy("k").agg(F.count("*").alias("n"), F.ceil(weight / BLOCK).alias("of_all"), F.ceil(F.sum(F.when(F.col("label") != F.col("main"), F.col("size")).otherwise(0)) / BLOCK).alias("of_out"))
    rows = lookup_skew_safe(left, "k", materialize(sizes, "open-sizes"), ["of_all", "of_out"], "n", spread).drop("k")

    def block(of: str):
        return F.pmod(F.xxhash64("row"), F.col(of))

    def every(of: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(of) - 1))

    # a row's set joins once per row; the copies are made after that
    places = rows.where("of_out > 0").select("row", F.struct("bucket", "label", "main", "of_all", "of_out").alias("p"))
    placed = places.join(sets, "row").select("row", "units", "p.*")
    same = ["bucket", "row", "label", "units"]
    alls = placed.select(*same, F.lit(False).alias("out"), block("of_all").alias("i"), every("of_out").alias("j"))
    outs = placed.where("label <> main").select(*same, F.lit(True).alias("out"), every("of_all").alias("i"), block("of_out").alias("j"))

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        row, label, out = (table[c].to_numpy() for c in ("row", "label", "out"))
        units = table["units"].chunk(0)
        sizes = np.diff(units.offsets.to_numpy())
        values, place = np.unique(units.flatten().to_numpy(), return_inverse=True)
        begin = np.concatenate(([0], np.cumsum(sizes)))
        other = np.flatnonzero(~out)
        flat = np.concatenate([place[begin[k]:begin[k + 1]] for k in other]) if len(other) else place[:0]
        cuts = np.concatenate(([0], np.cumsum(sizes[other])))
        top: dict[int, int] = {}

        def root(x: int) -> int:
            while top.get(x, x) != x:
                x = top[x]
            return x

        a, b = [], []
        mark = np.zeros(len(values), np.int64)
        for k in np.flatnonzero(out):
            own = place[begin[k]:begin[k + 1]]
            mark[own] = 1
            held = np.concatenate(([0], np.cumsum(mark[flat])))
            mark[own] = 0
            for m in other[_close(sizes[k], sizes[other], held[cuts[1:]] - held[cuts[:-1]], least)]:
                if root(label[k]) != root(label[m]):
                    a.append(row[k])
                    b.append(row[m])
                    top[root(label[k])] = root(label[m])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return alls.unionByName(outs).groupBy("bucket", "i", "j").applyInArrow(run, "a long, b long")


def _classes(docs: DataFrame, id_col: str, text_col: str, least: float) -> tuple[DataFrame, DataFrame]:
    """(members, reps).  members: one row per input row with row, id, rep (row number of its text's node), class
    (least id in the class), class_size and first (row number of the row that stays).  reps: rep, id, digest."""
    ship_package(docs.sparkSession)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    signed = materialize(signatures(texts).withColumn("row", F.monotonically_increasing_id()), "signatures")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    reps = materialize(signed.groupBy("digest").agg(F.min(order).alias("m"), F.count("*").alias("n"))
                       .select("digest", F.col("m.row").alias("rep"), F.col("m.id").alias("id"), "n"), "texts")
    banded = signed.join(reps.select(F.col("rep").alias("row")), "row", "left_semi").select("row", F.explode("bands").alias("bucket"))
    banded = materialize(banded, "bands")
    buckets = materialize(banded.groupBy("bucket").agg(F.min("row").alias("center"), F.count("*").alias("n")).where("n > 1"), "buckets")
    keyed = banded.withColumn("k", F.col("bucket").cast("string"))
    inside = lookup_skew_safe(keyed, "k", buckets.withColumn("k", F.col("bucket").cast("string")).drop("bucket"), ["center", "n"], "n",
                              F.concat_ws(":", F.lit("hot"), "row", "bucket"), keep="inner").drop("k")
    inside = materialize(inside, "bucket-rows")
    pairs = materialize(inside.where("row <> center").select(F.col("center").alias("a"), F.col("row").alias("b")).distinct(), "pairs")
    wanted = inside.select("row").distinct().join(reps.select(F.col("rep").alias("row"), "id", "digest"), "row")
    keys = [F.col("w.digest") == F.col("t.digest"), F.col("w.id").eqNullSafe(F.col("t.id"))]
    chosen = (texts.withColumn("digest", _digest(F.col("text"))).alias("t").join(wanted.alias("w"), keys[0] & keys[1])
              .select("w.row", "t.text").dropDuplicates(["row"]))
    sets = materialize(shingle_sets(chosen), "shingles")
    nearest = pairs.groupBy(F.col("b").alias("row")).agg(F.min("a").alias("center"))
    links = materialize(_linked(materialize(nearest, "least-centers"), sets, least), "center-links")
    roots = materialize(components(links), "roots")
    apart = materialize(_apart(pairs.select(F.col("b").alias("row"), F.col("a").alias("center")), roots), "pairs-apart")
    if not apart.isEmpty():
        links = materialize(links.unionByName(_linked(apart, sets, least)), "center-links")
        roots = materialize(components(links), "roots")
    more = materialize(_finish(inside, roots, sets, least), "more-links")
    if not more.isEmpty():
        roots = materialize(components(links.unionByName(more)), "roots")
    of = materialize(reps.join(roots, F.col("rep") == F.col("node"), "left").withColumn("root", F.coalesce("root", "rep")).select("digest", "rep", "id", "n", "root"), "text-classes")
    best = of.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", F.col("rep").alias("row"))).alias("m"), F.sum("n").alias("size"), F.count("*").alias("texts"))
    best = materialize(best.select(F.col("root").cast("string").alias("k"), F.col("m.id").alias("class"), F.col("m.row").alias("first"), "size", "texts"), "classes")
    named = lookup_skew_safe(of.withColumn("k", F.col("root").cast("string")), "k", best, ["class", "first", "size"], "texts", F.concat_ws(":", F.lit("hot"), "rep"))
    named = materialize(named.select(F.hex("digest").alias("k"), "rep", "class", "first", "size", "n"), "text-verdicts")
    members = lookup_skew_safe(signed.select("row", "id", F.hex("digest").alias("k")), "k", named, ["rep", "class", "first", "size"], "n", F.concat_ws(":", F.lit("hot"), "row"))
    return members, reps


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """One row per input row: id, class_id, class_size (rows) and kept (this row is the one of its class to keep)."""
    members, _ = _classes(docs, id_col, text_col, least)
    return members.select(F.col("id").alias(id_col), F.col("class").alias("class_id"), F.col("size").alias("class_size"), (F.col("row") == F.col("first")).alias("kept"))


def kept_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """The input rows that stay, one per class, all columns unchanged."""
    members, reps = _classes(docs, id_col, text_col, least)
    first = members.where("row = first").select(F.col("first").alias("rep")).join(reps, "rep").select(F.col("id").alias("__id"), F.col("digest").alias("__d"))
    rows = packed(docs).withColumn("__digest", _digest(field(text_col)))
    kept = rows.join(first, (F.col("__digest") == F.col("__d")) & field(id_col).eqNullSafe(F.col("__id")))
    return kept.dropDuplicates(["__digest"]).select("__row.*")
