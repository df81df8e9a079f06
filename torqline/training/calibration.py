"""Sigmoid calibration over out-of-fold scores.

Each fold's model scores the rows it did not see; a sigmoid per class is fitted to those
scores. The calibrated probabilities of all folds are averaged.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import isfinite, log
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MAX_ROUNDS = 60
_GRADIENT_TOLERANCE = 1e-7


def sigmoid(score: Column, slope: float, intercept: float) -> Column:
    """1 / (1 + exp(slope * score + intercept)): a falling slope means a rising probability."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(score * F.lit(slope) + F.lit(intercept)))


def calibrated_probabilities(scores: Column, sigmoids: list[tuple[float, float]]) -> Column:
    """Array of class probabilities from an array of class scores, summing to 1.

    When every sigmoid is 0 the classes share the probability equally. A flat sigmoid ignores
    its score, which need not exist: models know no classes beyond the last one they saw.
    """

    def of_class(k: int, slope: float, intercept: float) -> Column:
        score = F.get(scores, F.lit(k)) if slope else F.lit(0.0)
        return F.coalesce(sigmoid(score, slope, intercept), F.lit(0.0))

    raw = F.array(*[of_class(k, slope, intercept) for k, (slope, intercept) in enumerate(sigmoids)])

    def shared(sigmoid_values: Column) -> Column:
        each = [sigmoid_values[k] for k in range(len(sigmoids))]
        total = reduce(add, each)
        return F.array(*[F.when(total == 0.0, F.lit(1.0 / len(sigmoids))).otherwise(p / total) for p in each])

    # Bound to a name: every probability needs all sigmoids, which would be computed again for each of them.
    return F.transform(F.array(raw), shared)[0]


def binary_probabilities(scores: Column, positive: tuple[float, float]) -> Column:
    """Two classes need one sigmoid, on the score of the positive class."""
    p = sigmoid(scores[1], *positive)
    return F.array(F.lit(1.0) - p, p)


def average_probabilities(folds: list[Column], classes: int) -> Column:
    """Element-wise mean of probability arrays."""
    return F.array(*[reduce(add, [fold[k] for fold in folds]) / float(len(folds)) for k in range(classes)])


def argmax_index(probabilities: Column) -> Column:
    """Index of the largest probability, the first one on ties."""
    return (F.array_position(probabilities, F.array_max(probabilities)) - 1).cast("int")


@dataclass
class _Fit:
    """Newton search of one sigmoid: the accepted point, the point to try and its step."""

    accepted: tuple[float, float]
    trial: tuple[float, float]
    loss: float = float("inf")
    done: bool = False


def fit_sigmoids(held_out: DataFrame, classes: int) -> dict[tuple[int, int], tuple[float, float]]:
    """Fit a sigmoid per (fold, class) to rows of (fold, label, scores).

    Every round is one aggregate that returns loss, gradient and curvature of all sigmoids
    together, so only a handful of sums per sigmoid reach the driver. Targets are smoothed by
    the class counts (Platt, 1999), which keeps separable classes finite. A class without rows
    on both sides of a fold gets no sigmoid.
    """
    wanted = [1] if classes == 2 else list(range(classes))
    cells = F.array(
        *[
            F.struct(
                F.lit(k).alias("class"),
                F.get("scores", F.lit(k)).alias("score"),
                (F.col("label") == k).alias("positive"),
            )
            for k in wanted
        ]
    )
    rows = held_out.select("fold", F.inline(cells)).where(F.col("score").isNotNull())
    counts = rows.groupBy("fold", "class").agg(
        F.sum(F.col("positive").cast("long")).alias("positives"), F.count(F.lit(1)).alias("n")
    )
    sizes = {
        (r["fold"], r["class"]): (r["positives"], r["n"] - r["positives"])
        for r in counts.where("positives > 0 AND positives < n").collect()
    }
    start = {key: (0.0, _prior_intercept(*size)) for key, size in sizes.items()}
    fits = {key: _Fit(point, point) for key, point in start.items()}

    for _ in range(_MAX_ROUNDS):
        active = {key: fit for key, fit in fits.items() if not fit.done}
        if not active:
            break
        for row in _newton_sums(rows, active, sizes).collect():
            _advance(active[(row["fold"], row["class"])], row)
    return {key: fit.accepted for key, fit in fits.items()}


def _prior_intercept(positives: int, negatives: int) -> float:
    return log((negatives + 1.0) / (positives + 1.0))


def _newton_sums(rows: DataFrame, active: dict, sizes: dict) -> DataFrame:
    """Loss, gradient and Hessian per sigmoid at its trial point.

    The points travel as a table of one row per sigmoid, not as literals, so that every round
    runs the code compiled for the first.
    """
    points = [
        (*key, *fit.trial, (sizes[key][0] + 1.0) / (sizes[key][0] + 2.0), 1.0 / (sizes[key][1] + 2.0))
        for key, fit in active.items()
    ]
    schema = "fold int, class int, slope double, intercept double, high double, low double"
    table = rows.sparkSession.createDataFrame(points, schema)
    parameters = rows.join(F.broadcast(table), ["fold", "class"]).withColumn(
        "target", F.when(F.col("positive"), F.col("high")).otherwise(F.col("low"))
    )
    z = F.col("slope") * F.col("score") + F.col("intercept")
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(z))
    # log(1 + exp(z)) without overflow
    softplus = F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))
    error, curvature = F.col("target") - p, p * (F.lit(1.0) - p)
    score = F.col("score")
    return parameters.groupBy("fold", "class").agg(
        F.sum(softplus - (F.lit(1.0) - F.col("target")) * z).alias("loss"),
        F.sum(error * score).alias("g_slope"),
        F.sum(error).alias("g_intercept"),
        F.sum(curvature * score * score).alias("h_slope"),
        F.sum(curvature * score).alias("h_cross"),
        F.sum(curvature).alias("h_intercept"),
        F.count(F.lit(1)).alias("n"),
    )


def _advance(fit: _Fit, sums) -> None:
    """Accept the trial point and take a Newton step, or halve the step that went uphill."""
    if not isfinite(sums["loss"]) or sums["loss"] > fit.loss + 1e-12 * abs(fit.loss):
        fit.trial = tuple((a + t) / 2.0 for a, t in zip(fit.accepted, fit.trial))
        if max(abs(a - t) for a, t in zip(fit.accepted, fit.trial)) < 1e-12:
            fit.done = True
        return
    fit.accepted, fit.loss = fit.trial, sums["loss"]
    g = (sums["g_slope"], sums["g_intercept"])
    if max(abs(g[0]), abs(g[1])) < _GRADIENT_TOLERANCE * sums["n"]:
        fit.done = True
        return
    ridge = 1e-12 * (1.0 + sums["h_slope"])
    a, b, c = sums["h_slope"] + ridge, sums["h_cross"], sums["h_intercept"] + ridge
    determinant = a * c - b * b
    if determinant <= 0.0:
        fit.done = True
        return
    step = ((c * g[0] - b * g[1]) / determinant, (a * g[1] - b * g[0]) / determinant)
    fit.trial = (fit.accepted[0] - step[0], fit.accepted[1] - step[1])
