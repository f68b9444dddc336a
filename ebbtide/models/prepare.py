"""Feature preparation as ML stages, fitted on train rows only."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.vocab import CATEGORICAL, NUMERIC

LABEL = "Churn"
FEATURES = "features"


def _filled(column: str) -> Column:
    return F.nullif(F.col(column).cast("string"), F.lit(""))


class CategoryModes(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the most frequent value of each input column (the smallest on a tie): one row, one pass."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> CategoryModesModel:
        names = self.getInputCols()
        found = dataset.agg(*[F.mode(_filled(c), True).alias(f"m{k}") for k, c in enumerate(names)]).first()
        return CategoryModesModel(
            inputCols=names, outputCols=self.getOutputCols(), modes=["missing" if m is None else m for m in found]
        )


class CategoryModesModel(Model, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Fills the nulls of each column with its mode, whatever text that is; a column that had no value
    gets the text ``missing``. Empty text counts as null, since a vector slot cannot be named by it."""

    modes = Param(Params._dummy(), "modes", "value that fills the nulls of each column", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None, modes: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        columns = zip(self.getInputCols(), self.getOutputCols(), self.getOrDefault(self.modes), strict=True)
        return dataset.withColumns({out: F.coalesce(_filled(c), F.lit(m)) for c, out, m in columns})


def preparation_stages(numeric: list[str] = NUMERIC, categorical: list[str] = CATEGORICAL) -> list:
    """Median imputing and standardising of numbers; mode imputing and one-hot of categories.

    The indexer keeps unknown values in an extra last slot and the encoder drops the last slot, so
    an unknown category is all zeros. The scaler divides by the sample deviation, which differs
    from the population deviation by the factor sqrt((n - 1) / n).
    """
    typed = ", ".join(f"CAST({c} AS DOUBLE) AS {c}__number" for c in numeric)
    numbers, indexed = [f"{c}__number" for c in numeric], [f"{c}__index" for c in categorical]
    filled = [f"{c}__filled" for c in categorical]
    return [
        SQLTransformer(statement=f"SELECT *, {typed} FROM __THIS__"),
        CategoryModes(inputCols=categorical, outputCols=filled),
        Imputer(strategy="median", inputCols=numbers, outputCols=numbers, relativeError=1e-4),
        VectorAssembler(inputCols=numbers, outputCol="numbers__raw"),
        StandardScaler(inputCol="numbers__raw", outputCol="numbers__scaled", withMean=True, withStd=True),
        StringIndexer(
            inputCols=filled, outputCols=indexed, handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ),
        OneHotEncoder(inputCols=indexed, outputCols=[f"{c}__hot" for c in categorical], dropLast=True),
        VectorAssembler(inputCols=["numbers__scaled", *[f"{c}__hot" for c in categorical]], outputCol=FEATURES),
    ]


def fit_preparation(train: DataFrame, numeric: list[str] = NUMERIC, categorical: list[str] = CATEGORICAL) -> PipelineModel:
    return Pipeline(stages=preparation_stages(numeric, categorical)).fit(train)


def feature_names(model: PipelineModel, numeric: list[str], categorical: list[str]) -> list[str]:
    """Names of the vector slots, in order."""
    labels = next(s for s in model.stages if s.__class__.__name__ == "StringIndexerModel").labelsArray
    return [*numeric, *[f"{c}_{v}" for c, values in zip(categorical, labels) for v in values]]


def slot_columns(model: PipelineModel, numeric: list[str], categorical: list[str]) -> list[str]:
    """The column that each vector slot comes from, in order."""
    labels = next(s for s in model.stages if s.__class__.__name__ == "StringIndexerModel").labelsArray
    return [*numeric, *[c for c, values in zip(categorical, labels) for _ in values]]


def prepared(model: PipelineModel, df: DataFrame) -> DataFrame:
    """The rows with the feature vector, without the helper columns."""
    out = model.transform(df)
    return out.select(*df.columns, FEATURES)


def with_balance_weight(train: DataFrame, label: str = LABEL) -> DataFrame:
    """Weight rows / (2 x rows of the label), so both labels weigh the same."""
    facts = train.agg(F.struct(F.count("*").alias("n"), F.sum(label).alias("pos")).alias("f")).scalar()
    of_label = F.when(F.col(label) == 1, facts["pos"]).otherwise(facts["n"] - facts["pos"])
    return train.withColumn("balance_weight", facts["n"] / (2 * of_label))
