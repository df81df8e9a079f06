"""Exact classification metrics from small aggregates.

Nothing here looks at raw rows twice: labels and predictions reduce to confusion counts,
scores to counts per distinct score.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from torqline import config as C
from torqline.operators.prefix import range_cuts, running_sums, with_range


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction", by: list[str] | None = None):
    """rows per (label, prediction), within the groups of ``by``."""
    return df.groupBy(*(by or []), F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _ratio(numerator: Column, denominator: Column) -> Column:
    """0/0 counts as 0."""
    return F.coalesce(numerator / F.nullif(denominator.cast("double"), F.lit(0.0)), F.lit(0.0))


def _scores(tp: Column, predicted: Column, actual: Column) -> dict[str, Column]:
    return {
        "precision": _ratio(tp, predicted),
        "recall": _ratio(tp, actual),
        "f1": _ratio(tp * 2, predicted + actual),
    }


def binary_scores(counts: DataFrame, positive=1, by: list[str] | None = None) -> DataFrame:
    """Precision, recall and F1 of the positive class from confusion counts."""
    is_label, is_prediction = F.col("label") == positive, F.col("prediction") == positive

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    sums = counts.groupBy(*(by or [])).agg(
        total(is_label & is_prediction).alias("tp"),
        total(~is_label & is_prediction).alias("fp"),
        total(is_label & ~is_prediction).alias("fn"),
        total(~is_label & ~is_prediction).alias("tn"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return sums.withColumns(_scores(tp, tp + fp, tp + fn))


def class_scores(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 per class, over every class seen as label or prediction."""
    zero = F.lit(0).cast("long")
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(zero)
    sides = F.array(
        F.struct(F.col("label").alias("class"), hit.alias("tp"), F.col("n").alias("actual"), zero.alias("predicted")),
        F.struct(
            F.col("prediction").alias("class"), zero.alias("tp"), zero.alias("actual"), F.col("n").alias("predicted")
        ),
    )
    per_class = (
        counts.select(F.inline(sides))
        .groupBy("class")
        .agg(F.sum("tp").alias("tp"), F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"))
    )
    return per_class.withColumns(_scores(F.col("tp"), F.col("predicted"), F.col("actual")))


def macro_scores(counts: DataFrame) -> DataFrame:
    """Unweighted mean of the class scores."""
    return class_scores(counts).agg(
        F.count(F.lit(1)).alias("classes"),
        *[F.avg(name).alias(name) for name in ("precision", "recall", "f1")],
    )


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", ranges: int | None = None) -> DataFrame:
    """Area under the ROC curve with ties counted half; null when a class is missing."""
    scored = df.select(F.col(label).cast("int").alias("label"), F.col(score).cast("double").alias("score"))
    cuts = range_cuts(scored, ["score"], ranges)["score"]
    counts = (
        with_range(scored, "score", cuts, "range")
        .groupBy("range", "score")
        .agg(F.sum("label").alias("positives"), F.sum(1 - F.col("label")).alias("negatives"))
    )
    summed = running_sums(counts, "score", {"cum_negatives": "negatives"}, "range")
    # positives beat every negative below them and half of those at the same score
    wins = F.col("positives") * (F.col("cum_negatives") - F.col("negatives") / 2.0)
    pairs = F.sum("positives").cast("double") * F.sum("negatives").cast("double")
    return summed.agg((F.sum(wins) / F.nullif(pairs, F.lit(0.0))).alias("roc_auc"))


def brier_binary(label: Column, probability: Column) -> Column:
    """Mean squared error of the positive probability."""
    return F.avg((probability - label) * (probability - label))


def brier_multiclass(label: Column, probabilities: Column, classes: int) -> Column:
    """Half the mean squared distance to the one-hot label, so it shares the binary 0..1 scale."""

    def squared(k: int) -> Column:
        error = probabilities[k] - F.when(label == k, F.lit(1.0)).otherwise(F.lit(0.0))
        return error * error

    return F.avg(reduce(add, [squared(k) for k in range(classes)])) / 2.0


def overfit(f1_train: Column, f1_test: Column) -> dict[str, Column]:
    delta = f1_train - f1_test
    return {"overfit_delta": delta, "overfit_warning": delta > C.OVERFIT_WARNING}


def calibration_bins(df: DataFrame, label: str = "label", score: str = "score", bins: int = 10) -> DataFrame:
    """Predicted against observed frequency per probability bin."""
    number = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("long")
    return df.groupBy(number.alias("bin")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(score).alias("mean_predicted"),
        F.avg(F.col(label).cast("double")).alias("observed_rate"),
    )
