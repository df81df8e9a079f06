"""Feature vectors: one-hot machine type, numeric pass-through, optional scaling."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame

from torqline import config as C


def type_encoder() -> list:
    """All levels kept in alphabetical order; an unseen level becomes all zeros.

    ``keep`` adds one slot for unseen levels and dropping the last slot removes exactly that.
    """
    return [
        StringIndexer(inputCol="type", outputCol="type_index", stringOrderType="alphabetAsc", handleInvalid="keep"),
        OneHotEncoder(inputCol="type_index", outputCol="type_one_hot", dropLast=True),
    ]


def vectoriser(scaled: bool = False) -> list:
    """Stages from a feature frame to ``features``; models that need it get scaled inputs."""
    raw = "raw_features" if scaled else "features"
    stages = [*type_encoder(), VectorAssembler(inputCols=[*C.NUMERIC_FEATURES, "type_one_hot"], outputCol=raw)]
    if scaled:
        stages.append(StandardScaler(inputCol=raw, outputCol="features", withMean=True, withStd=True))
    return stages


def one_hot_columns(fit_on: DataFrame, df: DataFrame, *keys: str) -> DataFrame:
    """The one-hot block as plain columns, one per level seen while fitting."""
    model = Pipeline(stages=type_encoder()).fit(fit_on.select("type"))
    levels = model.stages[0].labels
    block = vector_to_array("type_one_hot")
    return model.transform(df).select(*keys, *[block[i].alias(f"type_{level}") for i, level in enumerate(levels)])


def scaled_columns(df: DataFrame, *keys: str) -> DataFrame:
    """The numeric features as the scaled learners see them, as plain columns.

    The stage divides by the deviation of a sample; the definition by that of all rows it was fitted on, which
    is a factor sqrt(n / (n - 1)) that no learner notices. It is applied here so that values match.
    """
    model = Pipeline(stages=vectoriser(scaled=True)).fit(df)
    n = df.count()
    factor = (n / (n - 1)) ** 0.5 if n > 1 else 1.0
    block = vector_to_array("features")
    return model.transform(df).select(*keys, *[(block[i] * factor).alias(c) for i, c in enumerate(C.NUMERIC_FEATURES)])
