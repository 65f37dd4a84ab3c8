"""Feature transforms as fit/transform pairs.

Fitting is one aggregate job whose result is tiny and bounded by construction
(frequent categories: at most 1/threshold values per column; quantiles: three
numbers per column), so the fitted state is brought to the driver and compiled into
a single ``select`` of built-in expressions.  Transforming never shuffles.
"""

from __future__ import annotations

import dataclasses
import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from connlens import config
from connlens.operators.ordered import exact_quantiles, quantile_table


# ---------------------------------------------------------------------------
# rare-category consolidation
# ---------------------------------------------------------------------------

def frequency_fit_table(df: DataFrame, cols: Sequence[str], threshold: float = config.RARE_THRESHOLD) -> DataFrame:
    """(column, value, share) of categories whose share of non-null rows is >= threshold."""
    kv = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])).alias("kv")
    ).select("kv.*").where(F.col("value").isNotNull())
    g = kv.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    tot = g.groupBy("column").agg(F.sum("n").alias("tot"))  # one row per column
    return (g.join(F.broadcast(tot), "column")
            .select("column", "value", (F.col("n") / F.col("tot")).alias("share"))
            .where(F.col("share") >= threshold))


@dataclass
class FrequencyEncoder:
    threshold: float = config.RARE_THRESHOLD
    fill_value: str = config.FILL_VALUE
    frequent: dict[str, list[str]] = field(default_factory=dict)

    def fit(self, df: DataFrame, cols: Sequence[str]) -> FrequencyEncoder:
        rows = frequency_fit_table(df, cols, self.threshold).select("column", "value").collect()
        self.frequent = {c: [] for c in cols}
        for r in rows:  # bounded: <= len(cols) / threshold rows
            self.frequent[r["column"]].append(r["value"])
        for c in self.frequent:
            self.frequent[c].sort()
        return self

    def expr(self, c: str) -> Column:
        vals = self.frequent.get(c)
        if vals is None:  # column unseen at fit -> all fill
            return F.lit(self.fill_value)
        s = F.col(c).cast("string")
        return F.when(s.isin(vals), s).otherwise(F.lit(self.fill_value))

    def transform(self, df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
        cols = list(cols or self.frequent)
        return df.withColumns({c: self.expr(c) for c in cols})

    def to_json(self) -> str:
        return json.dumps({"threshold": self.threshold, "fill_value": self.fill_value, "frequent": self.frequent})

    @classmethod
    def from_json(cls, s: str) -> FrequencyEncoder:
        d = json.loads(s)
        return cls(d["threshold"], d["fill_value"], d["frequent"])


# ---------------------------------------------------------------------------
# one-hot (full width, sorted categories, unknown -> all zeros)
# ---------------------------------------------------------------------------

@dataclass
class OneHot:
    categories: dict[str, list[str]] = field(default_factory=dict)
    prefix: str = "cat__"

    def fit(self, df: DataFrame, cols: Sequence[str]) -> OneHot:
        # distinct values of already-consolidated columns: bounded by 1/threshold + 1
        kv = df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])).alias("kv")
        ).select("kv.*").where(F.col("value").isNotNull()).distinct()
        self.categories = {c: [] for c in cols}
        for r in kv.collect():
            self.categories[r["column"]].append(r["value"])
        for c in self.categories:
            self.categories[c].sort()  # code-point order, like sorted() on str
        return self

    def names(self) -> list[str]:
        return [f"{self.prefix}{c}_{v}" for c, vs in self.categories.items() for v in vs]

    def exprs(self) -> list[Column]:
        return [(F.col(c).cast("string") == F.lit(v)).cast("double").alias(f"{self.prefix}{c}_{v}")
                for c, vs in self.categories.items() for v in vs]

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        return df.select(*keep, *[F.coalesce(e, F.lit(0.0)).alias(n) for e, n in zip(self.exprs(), self.names())])


# ---------------------------------------------------------------------------
# log1p (negative anywhere -> error) and robust scaling
# ---------------------------------------------------------------------------

def log1p_expr(c: str | Column, name: str | None = None) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    out = F.when(x < 0, F.raise_error(F.lit("log1p needs counts of zero or more: negative values in the input"))
                 ).otherwise(F.log1p(x.cast("double")))
    return out.alias(name or (c if isinstance(c, str) else "log1p"))


def quantile_fit(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """(column, q25, q50, q75) -- exact, linearly interpolated, nulls ignored."""
    q = quantile_table(df, cols, [0.25, 0.5, 0.75], exact=exact)
    return (q.groupBy("column").pivot("q", [0.25, 0.5, 0.75]).agg(F.first("value"))
            .toDF("column", "q25", "q50", "q75"))


@dataclass
class RobustScaler:
    center: dict[str, float] = field(default_factory=dict)
    scale: dict[str, float] = field(default_factory=dict)

    def fit(self, df: DataFrame, cols: Sequence[str], exact: bool = True) -> RobustScaler:
        for r in quantile_fit(df, cols, exact).collect():  # 3 numbers per column
            c = r["column"]
            self.center[c] = r["q50"]
            iqr = (r["q75"] - r["q25"]) if r["q75"] is not None else None
            self.scale[c] = 1.0 if not iqr else iqr  # zero IQR -> divide by 1
        return self

    def expr(self, c: str, src: Column | None = None, name: str | None = None) -> Column:
        x = (src if src is not None else F.col(c)).cast("double")
        return ((x - F.lit(self.center[c])) / F.lit(self.scale[c])).alias(name or c)


def impute_expr(c: str, fill) -> Column:
    return F.coalesce(F.col(c), F.lit(fill)).alias(c)


def fit_impute(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> dict:
    """Median for numeric columns, mode (ties -> smallest value) for categorical ones."""
    fills = {}
    if numeric:
        for r in exact_quantiles(df, numeric, [0.5]).collect():
            fills[r["column"]] = r["value"]
    for c in categorical:
        top = (df.where(F.col(c).isNotNull()).groupBy(c).count()
               .orderBy(F.col("count").desc(), F.col(c)).limit(1).collect())
        if top:
            fills[c] = top[0][c]
    return fills


# ---------------------------------------------------------------------------
# the whole 5-group preprocessor
# ---------------------------------------------------------------------------

@dataclass
class Preprocessor:
    categorical: Sequence[str]
    log: Sequence[str]
    robust: Sequence[str]
    rate: Sequence[str]
    binary: Sequence[str]
    threshold: float = config.RARE_THRESHOLD
    freq: FrequencyEncoder | None = None
    onehot: OneHot | None = None
    log_scaler: RobustScaler | None = None
    robust_scaler: RobustScaler | None = None

    def fit(self, train: DataFrame) -> Preprocessor:
        self.freq = FrequencyEncoder(self.threshold).fit(train, self.categorical)
        consolidated = self.freq.transform(train.select(*self.categorical), self.categorical)
        self.onehot = OneHot().fit(consolidated, self.categorical)
        # quantiles of log1p(x): interpolation is not invariant under log, so fit after it.
        # Both scalers share ONE exact-quantile pass over the log and the raw columns.
        both = train.select(*[log1p_expr(c, f"__log__{c}") for c in self.log], *self.robust)
        joint = RobustScaler().fit(both, [f"__log__{c}" for c in self.log] + list(self.robust))
        self.log_scaler = RobustScaler({c: joint.center[f"__log__{c}"] for c in self.log},
                                       {c: joint.scale[f"__log__{c}"] for c in self.log})
        self.robust_scaler = RobustScaler({c: joint.center[c] for c in self.robust},
                                          {c: joint.scale[c] for c in self.robust})
        return self

    def feature_names(self) -> list[str]:
        return (self.onehot.names() + [f"log__{c}" for c in self.log] + [f"robust__{c}" for c in self.robust]
                + [f"rate__{c}" for c in self.rate] + [f"binary__{c}" for c in self.binary])

    def exprs(self) -> list[Column]:
        cat = []
        for c, vs in self.onehot.categories.items():
            src = self.freq.expr(c)
            cat += [(src == F.lit(v)).cast("double").alias(f"cat__{c}_{v}") for v in vs]
        logs = [self.log_scaler.expr(c, log1p_expr(c), f"log__{c}") for c in self.log]
        rob = [self.robust_scaler.expr(c, None, f"robust__{c}") for c in self.robust]
        rate = [F.col(c).cast("double").alias(f"rate__{c}") for c in self.rate]
        binary = [F.col(c).cast("double").alias(f"binary__{c}") for c in self.binary]
        return cat + logs + rob + rate + binary

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """ONE projection: undeclared columns are dropped (remainder = drop)."""
        return df.select(*keep, *self.exprs())

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the fitted state and the ordered output names as one JSON line (any
        Hadoop filesystem)."""
        state = dataclasses.asdict(self) | {"feature_names": self.feature_names()}
        spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1).write.text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Preprocessor:
        state = json.loads(spark.read.text(path).first()[0])
        names = state.pop("feature_names")
        parts = {"freq": FrequencyEncoder, "onehot": OneHot, "log_scaler": RobustScaler, "robust_scaler": RobustScaler}
        out = cls(**{k: parts[k](**v) if k in parts and v is not None else v for k, v in state.items()})
        if out.feature_names() != names:
            raise ValueError(f"the state in {path} does not give the feature names saved with it")
        return out
