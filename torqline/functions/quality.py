"""Input contract: typed, bounded readings, with field-level reasons for rejects."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from torqline import config as C


def _within(name: str) -> Column:
    low, low_in, high, high_in = C.SENSOR_BOUNDS[name]
    value = F.col(name)
    above = value >= low if low_in else value > low
    below = value <= high if high_in else value < high
    # NaN sorts above every number in Spark, so it fails the upper bound.
    return above & below


def field_rules() -> dict[str, Column]:
    rules = {"machine_type": F.col("machine_type").rlike(C.MACHINE_TYPE_PATTERN)}
    rules.update({name: _within(name) for name in C.SENSOR_BOUNDS})
    return rules


def is_valid() -> Column:
    """Plain conjunction of predicates, so the numeric bounds reach the Parquet scan."""
    return reduce(and_, field_rules().values())


def rejection_reasons() -> Column:
    """Names of the fields that break the contract; a null value breaks it."""
    bad = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in field_rules().items()]
    return F.array_compact(F.array(*bad))


def valid_readings(df: DataFrame) -> DataFrame:
    return df.where(is_valid())


def quarantine(df: DataFrame) -> DataFrame:
    """Rejected rows with their reasons; together with ``valid_readings`` it is the whole input."""
    return df.where(~F.coalesce(is_valid(), F.lit(False))).withColumn("reasons", rejection_reasons())


def drop_incomplete(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drop rows with a null or NaN in any feature."""
    return df.na.drop(subset=columns or C.FEATURES)


def since_filter(df: DataFrame, since: str | None, column: str = "timestamp") -> DataFrame:
    """Rows strictly after ``since``.

    The literal takes the column's own type: a cast on the column would keep the predicate
    away from the Parquet scan.
    """
    if since is None:
        return df
    kind = df.schema[column].dataType
    literal = F.lit(since).cast(kind if not isinstance(kind, T.StringType) else "string")
    return df.where(F.col(column) > literal)
