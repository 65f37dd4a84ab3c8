"""Data-quality and profiling operators.

Every per-column statistic is folded into ONE aggregate over the table (one scan,
partial aggregation in each task) and unpivoted afterwards; nothing loops
``count()`` per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from connlens.functions.core import r6, safe_div
from connlens.operators.ordered import exact_quantiles


class ValidationException(Exception):
    """A data-contract check failed."""


NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def is_numeric(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, NUMERIC)


def columns_of_type(df: DataFrame, kind: str) -> list[str]:
    """Column names by kind: 'string', 'numeric', 'timestamp' or anything else."""
    out = []
    for f in df.schema.fields:
        dt = f.dataType
        k = ("string" if isinstance(dt, T.StringType) else "numeric" if isinstance(dt, NUMERIC)
             else "timestamp" if isinstance(dt, (T.TimestampType, T.TimestampNTZType)) else "other")
        if k == kind:
            out.append(f.name)
    return out


def columns_except(expected: Sequence[str], actual: Sequence[str]) -> list[str]:
    """Expected columns absent from ``actual`` (order of ``expected`` kept)."""
    have = set(actual)
    return [c for c in expected if c not in have]


def duplicate_count(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Rows that repeat an earlier row on ``subset`` (nulls compare equal).
    One shuffle on the subset with map-side combine; hot keys collapse to one row per task."""
    g = df.groupBy(*subset).agg(F.count(F.lit(1)).alias("_c"))
    return g.agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("long").alias("duplicate_count"))


def contract_report(df: DataFrame, expected: Sequence[str], target: str,
                    categoricals: Sequence[str]) -> DataFrame:
    """One report row: num_samples, num_features, duplicate_count, null_targets, status.

    Schema-level failures (missing columns, numeric categoricals) are decided from
    metadata; data-level ones (empty table, null targets) inside the same aggregate."""
    missing = columns_except(expected, df.columns)
    if missing:
        raise ValidationException(f"Missing columns, expected but not in the table: {missing}")
    for c in categoricals:
        if c in df.columns and is_numeric(df, c):
            raise ValidationException(
                f"Type inconsistency: {c!r} should hold category names but has a numeric type")
    feats = [c for c in expected if c != target]
    has_target = target in df.columns
    g = df.groupBy(*feats).agg(
        F.count(F.lit(1)).alias("_c"),
        (F.count_if(F.col(target).isNull()) if has_target else F.lit(0)).alias("_nt"))
    rep = g.agg(F.coalesce(F.sum("_c"), F.lit(0)).cast("long").alias("num_samples"),
                F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("long").alias("duplicate_count"),
                F.coalesce(F.sum("_nt"), F.lit(0)).cast("long").alias("null_targets"))
    status = (F.when(F.col("num_samples") == 0, "fail: empty")
              .when(F.col("null_targets") > 0, "fail: null target")
              .otherwise("success"))
    return rep.select("num_samples", F.lit(len(df.columns)).cast("long").alias("num_features"),
                      "duplicate_count", "null_targets", status.alias("status"))


def validate(df: DataFrame, expected: Sequence[str], target: str, categoricals: Sequence[str]) -> dict:
    """Run the contract and raise ``ValidationException`` on failure (one small collect)."""
    if not df.columns:
        raise ValidationException("the table is completely empty")
    row = contract_report(df, expected, target, categoricals).first().asDict()
    if row["num_samples"] == 0:
        raise ValidationException("the table is completely empty")
    if row["null_targets"] > 0:
        raise ValidationException("some rows have no target label")
    return row


def missing_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, nulls) for every column plus a '__total__' row."""
    cols = list(cols or df.columns)
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("long").alias("nulls")) for c in cols]
    total = F.struct(F.lit("__total__").alias("column"),
                     sum((F.col(c) for c in cols), F.lit(0)).cast("long").alias("nulls"))
    return one.select(F.explode(F.array(*pairs, total)).alias("p")).select("p.column", "p.nulls")


def row_col_counts(df: DataFrame) -> DataFrame:
    """Shape and dtype counts in one row."""
    return df.agg(F.count(F.lit(1)).cast("long").alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).cast("long").alias("n_cols"),
        F.lit(len(columns_of_type(df, "string"))).cast("long").alias("n_string_cols"),
        F.lit(len(columns_of_type(df, "numeric"))).cast("long").alias("n_numeric_cols"),
        F.lit(len(columns_of_type(df, "timestamp"))).cast("long").alias("n_timestamp_cols"))


def nunique(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """(column, nunique) -- nulls excluded.  ``approx`` uses HyperLogLog++ (no shuffle
    of distinct values, one pass)."""
    f = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.count_distinct(c))
    one = df.agg(*[f(c).alias(c) for c in cols])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("long").alias("nunique")) for c in cols])).alias("p")
    ).select("p.column", "p.nunique")


def value_counts(df: DataFrame, c: str) -> DataFrame:
    """(value, n, share) sorted by n desc; share over non-null rows.  The total is a
    scalar subquery over the grouped table (no join, no single-partition window)."""
    g = df.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    tot = g.agg(F.sum("n")).scalar()
    return (g.select("value", F.col("n").cast("long").alias("n"), r6(safe_div(F.col("n"), tot)).alias("share"))
            .orderBy(F.col("n").desc(), F.col("value")))


def share_of_total(df: DataFrame, n_col: str = "n", group_cols: Sequence[str] = ()) -> DataFrame:
    """Add share = n / sum(n) over an already grouped table (per group if given,
    otherwise over a scalar-subquery total)."""
    if group_cols:
        tot = F.sum(n_col).over(Window.partitionBy(*group_cols))
    else:
        tot = df.agg(F.sum(n_col)).scalar()
    return df.withColumn("share", r6(safe_div(F.col(n_col), tot)))


def describe_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, count, mean, std, min, q25, q50, q75, max) -- std with n-1."""
    moments = df.agg(*[F.struct(F.count(c).alias("count"), F.avg(c).alias("mean"),
                                F.stddev_samp(c).alias("std"), F.min(F.col(c).cast("double")).alias("min"),
                                F.max(F.col(c).cast("double")).alias("max")).alias(c) for c in cols])
    long = moments.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"{c}.*")) for c in cols])).alias("m")).select("m.*")
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    qw = q.groupBy("column").pivot("q", [0.25, 0.5, 0.75]).agg(F.first("value"))
    qw = qw.toDF("column", "q25", "q50", "q75")
    return long.join(qw, "column", "left").select(
        "column", F.col("count").cast("long").alias("count"), r6("mean").alias("mean"), r6("std").alias("std"),
        r6("min").alias("min"), r6("q25").alias("q25"), r6("q50").alias("q50"), r6("q75").alias("q75"),
        r6("max").alias("max"))


def skewness_g1(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Bias-corrected sample skewness G1 (the pandas ``.skew()`` definition)."""
    one = df.agg(*[F.struct(F.skewness(c).alias("g1"), F.count(c).alias("n")).alias(c) for c in cols])
    long = one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"{c}.*")) for c in cols])).alias("m")).select("m.*")
    n = F.col("n").cast("double")
    g = F.when(n > 2, F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2))
    return long.select("column", r6(g).alias("skewness"))


def histogram(df: DataFrame, c: str, bins: int = 50) -> DataFrame:
    """Equal-width histogram over [min, max]; last bin closed.  (bin, lo, hi, n) with
    empty bins included.  min/max are scalar subqueries; the counts one grouped pass."""
    x = F.col(c).cast("double")
    lo = df.agg(F.min(x)).scalar()
    hi = df.agg(F.max(x)).scalar()
    width = (hi - lo) / bins
    b = F.when(hi == lo, F.lit(0)).otherwise(F.least(F.floor((x - lo) / width).cast("int"), F.lit(bins - 1)))
    counts = df.where(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (grid.join(counts, "bin", "left")
            .select("bin", r6(lo + F.col("bin") * (hi - lo) / bins).alias("lo"),
                    r6(lo + (F.col("bin") + 1) * (hi - lo) / bins).alias("hi"),
                    F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def crosstab(df: DataFrame, row: str, colname: str, values: Sequence[str]) -> DataFrame:
    """Counts of ``row`` x ``colname`` with the column values given up front (no extra
    distinct-values job), zero-filled."""
    return (df.groupBy(row).pivot(colname, list(values)).agg(F.count(F.lit(1)))
            .na.fill(0, subset=list(values))
            .select(row, *[F.col(v).cast("long").alias(v) for v in values]))


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson r for every pair a < b (lower triangle), all pairs in one aggregate."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}") for a, b in pairs])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"{a}__{b}").alias("r")) for a, b in pairs])
    ).alias("p")).select("p.a", "p.b", r6("p.r").alias("r"))


def zero_variance(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, constant): min <=> max over non-null values (all-null counts as constant)."""
    one = df.agg(*[F.struct(F.min(c).cast("string").alias("mn"), F.max(c).cast("string").alias("mx")).alias(c)
                   for c in cols])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"{c}.mn").eqNullSafe(F.col(f"{c}.mx")).alias("constant"))
        for c in cols])).alias("p")).select("p.column", "p.constant")


def class_distribution(df: DataFrame, binary_col: str, family_col: str) -> DataFrame:
    """Binary and 5-family histogram of a split in one row."""
    return df.agg(F.count(F.lit(1)).cast("long").alias("n"),
                  *[F.count_if(F.col(binary_col) == v).cast("long").alias(f"binary_{v}") for v in (0, 1)],
                  *[F.count_if(F.col(family_col) == v).cast("long").alias(f"family_{v}") for v in range(5)])


def rollup_counts(df: DataFrame, dims: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    """Per-segment + grand-total metrics (``rollup``)."""
    return df.rollup(*dims).agg(*[v.alias(k) for k, v in measures.items()])
