"""Random Fourier features (Rahimi & Recht, 2007): an RBF kernel as a plain dot product."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class RandomFourierFeatures(
    Transformer, HasInputCol, HasOutputCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable
):
    """Maps x to sqrt(2 / D) * cos(W x + b) with W drawn from N(0, 2 gamma).

    Spark has no matrix product over vector columns, so batches go through numpy via Arrow;
    W and b are drawn again from the seed on every worker instead of being shipped.
    """

    numFeatures = Param(Params._dummy(), "numFeatures", "size of the mapped vector", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "width of the kernel", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, numFeatures=256, gamma=1.0, seed=42):
        super().__init__()
        self._setDefault(numFeatures=256, gamma=1.0, seed=42)
        self._set(**self._input_kwargs)

    def setGamma(self, value: float) -> RandomFourierFeatures:
        return self._set(gamma=value)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        size, gamma, seed = self.getOrDefault("numFeatures"), self.getOrDefault("gamma"), self.getSeed()

        @F.pandas_udf("array<double>")
        def mapped(vectors: pd.Series) -> pd.Series:
            if vectors.empty:
                return pd.Series([], dtype=object)
            x = np.stack(vectors.to_numpy())
            rng = np.random.default_rng(seed)
            weights = rng.normal(0.0, np.sqrt(2.0 * gamma), (x.shape[1], size))
            shifts = rng.uniform(0.0, 2.0 * np.pi, size)
            return pd.Series(list(np.sqrt(2.0 / size) * np.cos(x @ weights + shifts)))

        arrays = mapped(vector_to_array(F.col(self.getInputCol())))
        return dataset.withColumn(self.getOutputCol(), array_to_vector(arrays))
