"""Scans of the training table and the frozen baseline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from torqline import config as C
from torqline.functions.features import engineer_features, feature_slice
from torqline.functions.quality import drop_incomplete
from torqline.sources import schemas


def if_present(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``read`` returns, or None when its path does not exist yet."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def load_training_table(spark: SparkSession, path: str) -> DataFrame:
    """The fourteen training columns, whatever bookkeeping columns the files carry."""
    return spark.read.schema(schemas.TRAINING).parquet(path).select(*schemas.TRAINING.fieldNames())


def load_exported_ids(spark: SparkSession, path: str, but_batch: int | None = None) -> DataFrame:
    """Ids of the readings that reached a training table, in any batch or in any but one."""
    rows = spark.read.schema("reading_id long, export_batch long").parquet(path)
    if but_batch is not None:
        rows = rows.where(F.col("export_batch") != but_batch)
    return rows.select(F.col("reading_id").alias("id"))


def load_baseline_csv(spark: SparkSession, path: str) -> DataFrame:
    """The baseline as delivered, with declared types; later selects prune the columns parsed."""
    return spark.read.schema(schemas.TRAINING).option("header", True).option("mode", "FAILFAST").csv(path)


def reference_features(baseline: DataFrame) -> DataFrame:
    """Baseline in the feature space the models see, without incomplete rows."""
    return drop_incomplete(feature_slice(engineer_features(baseline)))


def sensor_rows(baseline: DataFrame) -> DataFrame:
    """The five columns that scenario resampling draws from."""
    originals = {snake: original for original, snake in C.AI4I_TO_SNAKE.items()}
    names = ["type", *C.SENSORS[:4]]
    return baseline.select(*[originals[name] for name in names])
