"""Splits, folds and class weights.

Splits hash the row key instead of ranking rows within a class: almost all rows are of one
class, so a per-class window would sort nearly the whole table in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from torqline import config as C
from torqline.functions.hashing import CALIBRATION_CUTS, CV_CUTS, fold_of, hash_integer, test_split

# Below this many rows a class is small enough to be ranked in one task.
RARE_CLASS_ROWS = 10_000


def with_split(df: DataFrame, key: str = "UDI") -> DataFrame:
    """Adds ``is_test``; class shares hold approximately."""
    return df.withColumn("is_test", test_split(F.col(key)))


def with_cv_fold(df: DataFrame, key: str = "UDI") -> DataFrame:
    return df.withColumn("fold", fold_of(F.col(key), CV_CUTS, f"cv-{C.SEED}"))


def with_calibration_fold(df: DataFrame, counts: dict[int, int], key: str = "UDI", label: str = "label") -> DataFrame:
    """Adds ``calibration_fold``; every class with a row per fold is present in every fold.

    Rare classes are dealt out in turn, which needs a window over their few rows. Classes too
    large for that fill all folds by hash alone.
    """
    rare = [k for k, n in counts.items() if n <= RARE_CLASS_ROWS]
    is_rare = F.col(label).isin(rare) if rare else F.lit(False)
    salt = f"calibration-{C.SEED}"
    turn = F.row_number().over(Window.partitionBy(label).orderBy(hash_integer(F.col(key), salt), key))
    dealt = df.where(is_rare).withColumn("calibration_fold", (turn - 1) % C.CALIBRATION_FOLDS)
    banded = df.where(~is_rare).withColumn("calibration_fold", fold_of(F.col(key), CALIBRATION_CUTS, salt))
    return dealt.unionByName(banded)


def imbalance_ratio(train: DataFrame, label: str = "label") -> DataFrame:
    """Negatives per positive; null without positives."""
    positives = F.sum((F.col(label) == 1).cast("long"))
    negatives = F.sum((F.col(label) == 0).cast("long"))
    return train.agg(
        negatives.alias("negatives"),
        positives.alias("positives"),
        (negatives / F.nullif(positives, F.lit(0).cast("long"))).alias("imbalance_ratio"),
    )


def class_weights(train: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weights n / (classes * n_class), one row per class."""
    counts = train.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes"))
    weight = totals.select(F.col("rows") / F.col("classes")).scalar() / F.col("n")
    return counts.withColumn("weight", weight)


def type_vocabulary(df: DataFrame, column: str = "type") -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)
