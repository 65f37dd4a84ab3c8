"""Distributed ordered operations: prefix sums, ranks and exact quantiles.

A window without ``partitionBy`` sends every row to one task.  Here global order is
obtained the scalable way:

1. bucket ids monotone in the order key, from approximate-quantile bounds computed
   once and applied with ``Bucketizer`` -- deterministic on every recomputation;
2. running sums inside each (group, bucket) -- one hash shuffle, balanced buckets;
3. per-(group, bucket) totals -> exclusive prefix over buckets.  That table has at
   most ``#groups x #buckets`` rows (a proven bound), so it is broadcast back.

Callers pre-aggregate to distinct order keys first (``groupBy(score).count()``), so a
hot key is one row and cannot overload a task.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from connlens.session import materialize


def _parts(df: DataFrame, n: int | None) -> int:
    return n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def bucketize(df: DataFrame, order: Column, num_buckets: int, out: str = "_pid",
              bounds: Sequence[float] | None = None) -> DataFrame:
    """Add a deterministic bucket id monotone in ``order`` (numeric).

    Bucket bounds are approximate quantiles of ``order`` computed once (at most
    ``num_buckets - 1`` numbers reach the driver) and applied with the JVM
    ``Bucketizer`` (binary search), so every recomputation -- a second branch of the
    same plan or a retried task after executor loss -- assigns the same bucket."""
    from pyspark.ml.feature import Bucketizer

    tmp = df.withColumn("_ord", order.cast("double"))
    probs = [i / num_buckets for i in range(1, num_buckets)]
    if bounds is None:
        bounds = tmp.approxQuantile("_ord", probs, 1.0 / (10 * num_buckets)) if probs else []
    splits = [float("-inf")] + sorted({b for b in bounds if b == b}) + [float("inf")]
    bk = Bucketizer(splits=splits, inputCol="_ord", outputCol=out, handleInvalid="keep")
    return bk.transform(tmp).withColumn(out, F.col(out).cast("int")).drop("_ord")


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Broadcast join with a table of bounded size (one row per group, or group and
    bucket); null keys match null keys, so no row of a null group is lost."""
    renamed = right.select(*[F.col(c).alias(f"_k_{c}") if c in keys else F.col(c) for c in right.columns])
    if not keys:
        return left.crossJoin(F.broadcast(renamed))
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in keys]
    return left.join(F.broadcast(renamed), functools.reduce(lambda a, b: a & b, same), how).drop(*[f"_k_{c}" for c in keys])


def prefix_sums(df: DataFrame, order: Column, sum_cols: Sequence[str], group_cols: Sequence[str] = (),
                prefix: str = "cum_", tiebreak: Sequence = (), num_buckets: int | None = None,
                bounds: Sequence[float] | None = None) -> DataFrame:
    """Add ``cum_<c>`` = sum of ``c`` over rows of the same group whose (order,
    tiebreak) key is <= the current row's (peers included).

    ``order`` is a numeric Column, ascending (negate it for descending order);
    ``tiebreak`` columns refine the order inside equal ``order`` values.  Group
    columns must be low-cardinality (the offsets table has #groups x #buckets rows)."""
    group_cols = list(group_cols)
    tiebreak = [F.col(t) if isinstance(t, str) else t for t in tiebreak]
    b = bucketize(df.withColumn("_o", order.cast("double")), F.col("_o"), _parts(df, num_buckets), bounds=bounds)
    w = (Window.partitionBy(*group_cols, "_pid").orderBy(F.col("_o"), *tiebreak)
         .rangeBetween(Window.unboundedPreceding, Window.currentRow) if not tiebreak else
         Window.partitionBy(*group_cols, "_pid").orderBy(F.col("_o"), *tiebreak)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = b.select("*", *[F.sum(c).over(w).alias(f"_loc_{c}") for c in sum_cols])
    totals = b.groupBy(*group_cols, "_pid").agg(*[F.sum(c).alias(f"_tot_{c}") for c in sum_cols])
    wo = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*group_cols, "_pid", *[
        F.coalesce(F.sum(f"_tot_{c}").over(wo), F.lit(0)).alias(f"_off_{c}") for c in sum_cols])
    out = join_null_safe(local, offsets, [*group_cols, "_pid"])  # <= #groups x #buckets rows
    return out.select(*df.columns, *[(F.col(f"_loc_{c}") + F.col(f"_off_{c}")).alias(f"{prefix}{c}")
                                     for c in sum_cols])


def hash_order(h: Column) -> Column:
    """Numeric, order-preserving proxy of a lowercase hex hash (first 48 bits)."""
    return F.conv(F.substring(h, 1, 12), 16, 10).cast("double")


RANK_BUCKETS = 8  # buckets of a rank's order per shuffle partition


def row_rank(df: DataFrame, hash_col: str, group_cols: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """1-based row number within each group in order of a UNIQUE hash column, of hex digits or of their bytes."""
    digits = F.hex(F.substring(hash_col, 1, 6)) if df.schema[hash_col].dataType.typeName() == "binary" else F.col(hash_col)
    one = df.withColumn("_one", F.lit(1).cast("long"))
    # a window's task holds whole buckets: several a partition, so that one holding more than its share stays small
    n = RANK_BUCKETS * _parts(df, None)
    # md5 is uniform: equal-width bounds over the 48-bit proxy are balanced, no sampling job
    uniform = [float(i * (2 ** 48) // n) for i in range(1, n)]
    ranked = prefix_sums(one, hash_order(digits), ["_one"], group_cols, prefix="_r", tiebreak=[hash_col],
                         num_buckets=n, bounds=uniform)
    return ranked.withColumnRenamed("_r_one", name).drop("_one")


def unpivot_numeric(df: DataFrame, cols: Sequence[str], name: str = "column",
                    value: str = "value") -> DataFrame:
    """Long (column, value) view of numeric columns as double."""
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias(value)) for c in cols])).alias("_kv")
    ).select(f"_kv.{name}", f"_kv.{value}")


QUANTILE_BUCKETS = 1024    # histogram rows per open interval and pass
QUANTILE_CANDIDATES = 2_000  # distinct values of an interval that are looked at one by one


def _place(x: Column, lo: float, hi: float) -> Column:
    """The bucket of a value between ``lo`` < ``hi``: the ends have their own, so every pass makes an interval
    smaller.  Widths are equal on a linear scale for narrow intervals, else on one that keeps apart values of
    very different size."""
    a, b = max(lo, -1e300), min(hi, 1e300)
    if b - a <= 1e-3 * max(abs(a), abs(b)):
        share = F.try_divide(x - F.lit(a), F.lit(b - a))
    else:
        unit = max(abs(a), abs(b)) * 1e-12
        base, top = (math.copysign(math.log1p(abs(e) / unit), e) for e in (a, b))
        share = F.try_divide(F.signum(x) * F.log1p(F.abs(x) / unit) - F.lit(base), F.lit(top - base))
    inner = F.least(F.greatest(F.coalesce(share, F.lit(0.0)), F.lit(0.0)), F.lit(1.0)) * (QUANTILE_BUCKETS - 3)
    return F.when(x == lo, 0).when(x == hi, QUANTILE_BUCKETS - 1).otherwise(1 + F.floor(inner).cast("int"))


def _interval_values(df: DataFrame, open_: list[dict], place) -> DataFrame:
    """(t, b, x) for every value of a column that lies in its open interval t; ``place`` gives its bucket b.  The
    intervals of a column do not overlap, so a row yields at most one entry per column."""
    entries = []
    for c in dict.fromkeys(o["column"] for o in open_):
        x, entry = F.col(f"`{c}`"), F.lit(None)
        for t, o in enumerate(open_):
            if o["column"] == c:
                inside = F.struct(F.lit(t).alias("t"), place(x, o).alias("b"), x.alias("x"))
                entry = F.when(x.between(o["lo"], o["hi"]), inside).otherwise(entry)
        entries.append(entry)
    return df.select(F.explode(F.array(*entries)).alias("e")).where("e is not null").select("e.*")


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Exact linearly-interpolated quantiles (numpy / pandas / DuckDB ``quantile_cont``)
    of several numeric columns, nulls and NaN ignored.

    No row is shuffled.  The wanted ranks of all columns are found together by histogram
    refinement: each pass counts values per bucket of the intervals that hold a rank (a
    partial aggregate of at most #intervals x 1024 rows a task; ranks of one interval share
    its histogram) and goes on with the buckets that hold one, between their least and
    largest value.  A rank is settled when these are equal, or from the distinct values of
    an interval of few rows.  The columns are written once, so the input plan runs once.

    Returns (column, q, value); a column without values has no rows."""
    spark = df.sparkSession
    numeric = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(c) for c in cols]
    kept = materialize(df.select(*numeric), "quantile-columns")
    ends = kept.agg(*[f(F.col(f"`{c}`")).alias(f"{k}_{i}") for i, c in enumerate(cols) for k, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]).first()
    found: dict[tuple[str, int], float] = {}
    open_, spots = [], []
    for i, c in enumerate(cols):
        n = ends[f"n_{i}"]
        for q in probs if n else ():
            h = float(q) * (n - 1)
            lo = min(int(h), n - 1)
            spots.append((c, float(q), lo, min(lo + 1, n - 1), h - lo))
        ranks = sorted({r for s in spots if s[0] == c for r in s[2:4]})
        if ranks:
            open_.append({"column": c, "ranks": ranks, "before": 0, "n": n, "lo": ends[f"lo_{i}"], "hi": ends[f"hi_{i}"]})
    while open_:
        found |= {(o["column"], r): o["lo"] for o in open_ if o["lo"] == o["hi"] for r in o["ranks"]}
        open_ = [o for o in open_ if o["lo"] < o["hi"]]
        wide = [o for o in open_ if o["n"] > QUANTILE_CANDIDATES]
        few = [o for o in open_ if o["n"] <= QUANTILE_CANDIDATES]
        if not wide:
            break
        hist = (_interval_values(kept, wide, lambda x, o: _place(x, o["lo"], o["hi"])).groupBy("t", "b")
                .agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect())
        open_ = few + [part for t, o in enumerate(wide) for part in _holding(o, sorted((r for r in hist if r["t"] == t), key=lambda r: r["b"]))]
    if open_:
        values = (_interval_values(kept, open_, lambda x, o: F.lit(0)).groupBy("t", "x").agg(F.count(F.lit(1)).alias("n"))
                  .select("t", F.col("x").alias("lo"), F.col("x").alias("hi"), "n").collect())
        for t, o in enumerate(open_):
            for part in _holding(o, sorted((r for r in values if r["t"] == t), key=lambda r: r["lo"])):
                found |= {(o["column"], r): part["lo"] for r in part["ranks"]}
    rows = [(c, q, found[c, lo] + frac * (found[c, hi] - found[c, lo]) if frac else found[c, lo]) for c, q, lo, hi, frac in spots]
    return spark.createDataFrame(rows, "`column` string, q double, value double")


def _holding(interval: dict, buckets: list) -> list[dict]:
    """The buckets (in order, with n, lo and hi) of an interval that hold one of its ranks."""
    out, before = [], interval["before"]
    for b in buckets:
        ranks = [r for r in interval["ranks"] if before <= r < before + b["n"]]
        if ranks:
            out.append({"column": interval["column"], "ranks": ranks, "before": before, "n": b["n"], "lo": b["lo"], "hi": b["hi"]})
        before += b["n"]
    return out


def quantile_table(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                   exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """(column, q, value); ``exact=False`` uses one ``percentile_approx`` pass instead."""
    if exact:
        return exact_quantiles(df, cols, probs)
    kv = unpivot_numeric(df, cols)
    arr = kv.groupBy("column").agg(F.percentile_approx("value", list(probs), accuracy).alias("v"))
    return arr.select("column", F.posexplode("v").alias("i", "value")).select(
        "column", F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("i") + 1).alias("q"), "value")


# ---------------------------------------------------------------------------
# rank cut-offs: "first q rows of each group in hash order" without moving rows
# ---------------------------------------------------------------------------

HEX_DIGITS_PER_PASS = 4       # 16-bit histogram per pass: <= #groups x 65536 rows
MAX_FINAL_CANDIDATES = 200_000  # rows per group ranked exactly in the last step
ALL_ROWS = "g"  # sorts after every lowercase hex string
NO_ROWS = ""    # sorts before every hex string


def rank_cutoffs(df: DataFrame, hash_col: str, group_cols: Sequence[str],
                 quota: DataFrame | Callable[[DataFrame], DataFrame], quota_col: str = "_q") -> DataFrame:
    """Per group, the hash of the ``quota``-th row in ascending ``hash_col`` order.

    ``hash_col`` is a UNIQUE lowercase hex hash (md5 of a unique row key), so
    ``rank <= quota`` is the same as ``hash_col <= cutoff``: choosing the first q rows
    of a stratum then needs no shuffle of the rows at all, only a filter.

    The cut-off is found by histogram refinement on hex-digit prefixes.  Each pass
    is a partial (map-side) aggregate of (group, next 4 hex digits) -> count over the
    rows whose prefix still matches: at most #groups x 65536 rows leave a task, and
    one row per group (the chosen digits and the remaining rank) reaches the driver.
    When the chosen prefix holds <= MAX_FINAL_CANDIDATES rows of its group, those
    candidates are ranked exactly.  md5 is uniform, so the candidate set shrinks by
    ~65536x per pass: one pass up to ~10^10 rows per group, two up to ~10^14.

    The passes read only the narrow (group, hash) projection; it is written once to the
    shared folder, so an expensive input plan runs once for all passes.

    ``quota`` is a table with one row per group and ``quota_col``, or a function of
    the group sizes (group..., n_c) returning that table -- then the sizes come from
    the same pass and the input is not read again for them.  Returns
    (group..., _cut), with ``_cut`` = "g" (all rows) when quota >= group size and ""
    when quota <= 0.
    """
    group_cols = list(group_cols)
    spark = df.sparkSession
    keys = materialize(df.select(*group_cols, F.col(hash_col).alias("_h")), "rank-keys")
    return _rank_cutoffs(spark, df, keys, group_cols, quota, quota_col)


def _rank_cutoffs(spark, df, keys, group_cols, quota, quota_col):
    sizes = keys.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("n_c"))
    qdf = quota(sizes) if callable(quota) else quota
    plan = join_null_safe(sizes, qdf.select(*group_cols, quota_col), group_cols, "left")  # one row per group
    rows = plan.select(*group_cols, F.col("n_c").alias("_n"),
                       F.coalesce(F.col(quota_col), F.lit(0)).cast("long").alias("_q")).collect()
    fixed, open_ = [], []  # one row per group: bounded by the group count
    for r in rows:
        g = tuple(r[c] for c in group_cols)
        if r["_q"] <= 0:
            fixed.append((*g, NO_ROWS))
        elif r["_q"] >= r["_n"]:
            fixed.append((*g, ALL_ROWS))
        else:
            open_.append((g, "", int(r["_q"]), int(r["_n"])))  # (group, prefix, rank within prefix, rows)
    out_schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in group_cols)
    out_schema = (out_schema + ", " if out_schema else "") + "_cut string"
    level = 0
    while open_:
        sel_schema = (", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in group_cols)
                      + (", " if group_cols else "") + "_prefix string, _need long")
        sel = spark.createDataFrame([(*g, p, k) for g, p, k, _ in open_], sel_schema)
        start = level * HEX_DIGITS_PER_PASS
        cand = join_null_safe(keys, sel, group_cols)
        cand = cand.where(F.substring("_h", 1, start) == F.col("_prefix")) if start else cand
        exact = [o for o in open_ if o[3] <= MAX_FINAL_CANDIDATES]
        if len(exact) == len(open_) or start + HEX_DIGITS_PER_PASS >= 32:
            # the candidates of every open group are few: rank them exactly by the full hash
            w = Window.partitionBy(*group_cols).orderBy("_h") if group_cols else Window.orderBy("_h")
            got = (cand.select(*group_cols, "_h", "_need", F.row_number().over(w).alias("_r"))
                   .where(F.col("_r") == F.col("_need")).select(*group_cols, "_h").collect())
            fixed += [(*(r[c] for c in group_cols), r["_h"]) for r in got]
            break
        digits = F.substring("_h", start + 1, HEX_DIGITS_PER_PASS)
        hist = cand.groupBy(*group_cols, "_prefix", "_need", digits.alias("_d")).agg(F.count(F.lit(1)).alias("_c"))
        w = (Window.partitionBy(*group_cols).orderBy("_d").rowsBetween(Window.unboundedPreceding, 0)
             if group_cols else Window.orderBy("_d").rowsBetween(Window.unboundedPreceding, 0))
        cum = hist.withColumn("_cum", F.sum("_c").over(w))  # <= 65536 histogram rows per group
        pick = cum.where((F.col("_cum") - F.col("_c") < F.col("_need")) & (F.col("_need") <= F.col("_cum")))
        open_ = [(tuple(r[c] for c in group_cols), r["_prefix"] + r["_d"], int(r["_need"] - (r["_cum"] - r["_c"])),
                  int(r["_c"])) for r in pick.collect()]
        level += 1
    return spark.createDataFrame(fixed, out_schema)


def first_in_hash_order(df: DataFrame, hash_col: str, group_cols: Sequence[str],
                        quota: DataFrame | Callable[[DataFrame], DataFrame], quota_col: str = "_q",
                        out: str = "_in") -> DataFrame:
    """Add boolean ``out``: the row is among the first ``quota`` rows of its group in
    ``hash_col`` order.  The cut-off table has one row per group and is broadcast."""
    cuts = rank_cutoffs(df, hash_col, group_cols, quota, quota_col)
    if not group_cols:
        cut = cuts.first()["_cut"] if cuts.count() else NO_ROWS
        return df.withColumn(out, F.col(hash_col) <= F.lit(cut))
    j = join_null_safe(df, cuts, group_cols, "left")
    return j.withColumn(out, F.coalesce(F.col(hash_col) <= F.col("_cut"), F.lit(False))).drop("_cut")
