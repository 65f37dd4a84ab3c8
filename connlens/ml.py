"""The feature transforms as ``pyspark.ml`` stages, for a ``Pipeline`` that is fitted, saved and loaded as one.

Estimators: RareCategories, OneHotColumns, RobustScaling.  Transformers: Log1pColumns, ColumnCopies.  Fitting is that of
``operators.features`` (aggregates whose result is small by construction); a fitted model is its params, so
``DefaultParamsWritable`` stores it whole, and transforming is one projection of built-in expressions.

Nulls: a null category is rare and matches no one-hot column (0.0); a null number stays null.  Fitted on an empty
table, RareCategories knows no category, OneHotColumns makes no column, and RobustScaling changes nothing.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from connlens import config
from connlens.operators import features as FE


class _Columns(HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Input columns and as many output columns (default: the input columns, replaced)."""

    def outputs(self) -> list[str]:
        return self.getOutputCols() if self.isDefined(self.outputCols) else self.getInputCols()

    def _with_columns(self, **params):
        return self._set(**{k: v for k, v in params.items() if v is not None})


class _State(Params):
    state = Param(Params._dummy(), "state", "the fitted values, as JSON", typeConverter=TypeConverters.toString)

    def fitted(self) -> dict:
        return json.loads(self.getOrDefault(self.state))


class _Rare(_Columns):
    threshold = Param(Params._dummy(), "threshold", "least share of the non-null rows of a category that stays", typeConverter=TypeConverters.toFloat)
    fillValue = Param(Params._dummy(), "fillValue", "what replaces the other categories", typeConverter=TypeConverters.toString)


class RareCategories(Estimator, _Rare):
    """Replaces categories with a share below ``threshold``, nulls and categories unseen at fitting by ``fillValue``."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, threshold=config.RARE_THRESHOLD, fillValue=config.FILL_VALUE):
        super().__init__()
        self._with_columns(**self._input_kwargs)
        self._setDefault(threshold=config.RARE_THRESHOLD, fillValue=config.FILL_VALUE)

    def _fit(self, dataset: DataFrame) -> RareCategoriesModel:
        encoder = FE.FrequencyEncoder(self.getOrDefault(self.threshold), self.getOrDefault(self.fillValue)).fit(dataset, self.getInputCols())
        return self._copyValues(RareCategoriesModel()._set(state=json.dumps(encoder.frequent)))


class RareCategoriesModel(Model, _Rare, _State):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        encoder = FE.FrequencyEncoder(self.getOrDefault(self.threshold), self.getOrDefault(self.fillValue), self.fitted())
        return dataset.withColumns({out: encoder.expr(c) for c, out in zip(self.getInputCols(), self.outputs())})


class _Hot(_Columns):
    prefix = Param(Params._dummy(), "prefix", "begins the names of the new columns", typeConverter=TypeConverters.toString)


class OneHotColumns(Estimator, _Hot):
    """Adds a 0/1 column <prefix><column>_<category> for each category met at fitting, in sorted order."""

    @keyword_only
    def __init__(self, *, inputCols=None, prefix="cat__"):
        super().__init__()
        self._with_columns(**self._input_kwargs)
        self._setDefault(prefix="cat__")

    def _fit(self, dataset: DataFrame) -> OneHotColumnsModel:
        found = FE.OneHot(prefix=self.getOrDefault(self.prefix)).fit(dataset, self.getInputCols())
        return self._copyValues(OneHotColumnsModel()._set(state=json.dumps(found.categories)))


class OneHotColumnsModel(Model, _Hot, _State):
    def _own(self) -> FE.OneHot:
        return FE.OneHot(self.fitted(), self.getOrDefault(self.prefix))

    def names(self) -> list[str]:
        return self._own().names()

    def _transform(self, dataset: DataFrame) -> DataFrame:
        own = self._own()
        return dataset.withColumns({n: F.coalesce(e, F.lit(0.0)) for n, e in zip(own.names(), own.exprs())})


class RobustScaling(Estimator, _Columns):
    """(x - median) / (q75 - q25) with exact quantiles, all columns in one fit; a zero range divides by 1."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._with_columns(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> RobustScalingModel:
        scaler = FE.RobustScaler().fit(dataset, self.getInputCols())
        return self._copyValues(RobustScalingModel()._set(state=json.dumps({"center": scaler.center, "scale": scaler.scale})))


class RobustScalingModel(Model, _Columns, _State):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        found = self.fitted()
        scaler = FE.RobustScaler({c: found["center"].get(c, 0.0) for c in self.getInputCols()}, {c: found["scale"].get(c, 1.0) for c in self.getInputCols()})
        return dataset.withColumns({out: scaler.expr(c) for c, out in zip(self.getInputCols(), self.outputs())})


class Log1pColumns(Transformer, _Columns):
    """ln(1 + x); a negative value fails the job."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._with_columns(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns({out: FE.log1p_expr(c) for c, out in zip(self.getInputCols(), self.outputs())})


class ColumnCopies(Transformer, _Columns):
    """The input columns as doubles under the output names."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._with_columns(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns({out: F.col(c).cast("double") for c, out in zip(self.getInputCols(), self.outputs())})


def _named(prefix: str, columns: Sequence[str]) -> list[str]:
    return [f"{prefix}__{c}" for c in columns]


def record_stages(categorical: Sequence[str], log: Sequence[str], robust: Sequence[str], rate: Sequence[str], binary: Sequence[str],
                  threshold: float = config.RARE_THRESHOLD) -> list:
    """The five-group preprocessor as stages; the columns they make are named group__column."""
    rare = [f"__{c}" for c in categorical]
    return [RareCategories(inputCols=list(categorical), outputCols=rare, threshold=threshold), OneHotColumns(inputCols=rare, prefix="cat"),
            Log1pColumns(inputCols=list(log), outputCols=_named("log", log)),
            RobustScaling(inputCols=[*_named("log", log), *robust], outputCols=[*_named("log", log), *_named("robust", robust)]),
            ColumnCopies(inputCols=[*rate, *binary], outputCols=[*_named("rate", rate), *_named("binary", binary)])]


def feature_names(fitted: Sequence) -> list[str]:
    """The feature columns, in order, that fitted ``record_stages`` make."""
    hot, scaled, copied = fitted[1], fitted[3], fitted[4]
    return [*hot.names(), *scaled.outputs(), *copied.outputs()]


def fit_pipeline(train: DataFrame, stages: Sequence, learner):
    """A fitted ``PipelineModel`` of the preprocessing stages, their assembled features, and ``learner`` on "features"."""
    from pyspark.ml import PipelineModel

    pre = Pipeline(stages=list(stages)).fit(train)
    assembler = VectorAssembler(inputCols=feature_names(pre.stages), outputCol="features", handleInvalid="keep")
    return PipelineModel([*pre.stages, assembler, learner.fit(assembler.transform(pre.transform(train)))])
