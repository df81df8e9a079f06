"""Hyperparameter search by a tree-structured Parzen estimator, with cross-validation on the training split.

The first points are drawn at random, a known-good one before them. Every later point is the likeliest gain among some
draws: the better quarter of the points tried so far and the rest each give a density per parameter, and the draw with
the largest ratio of the two is tried next. Points are tried a few at a time, as many as are fitted side by side.
"""

from __future__ import annotations

import random
from collections.abc import Callable
from math import ceil, exp, log, pi, sqrt

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import Evaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from torqline import config as C
from torqline.functions.hashing import hash_fraction
from torqline.operators import metrics
from torqline.training import sampling
from torqline.training.experiments import WEIGHT, Experiment, TrainingFacts, draw
from torqline.training.fourier import RandomFourierFeatures
from torqline.training.model import (
    CalibratedModel,
    class_counts,
    cut_lineage,
    prepare,
    rows_per_task,
    side_by_side,
    spread_rows,
    train_model,
    weight_column,
)
from torqline.training.vectors import vectoriser


class MacroF1(Evaluator):
    """Unweighted mean of the class F1 scores; Spark's own ``f1`` weights by class size."""

    def _evaluate(self, dataset: DataFrame) -> float:
        return metrics.macro_scores(metrics.confusion(dataset)).first()["f1"]

    def isLargerBetter(self) -> bool:
        return True


def evaluator_for(experiment: Experiment) -> Evaluator:
    if experiment.multiclass:
        return MacroF1()
    return MulticlassClassificationEvaluator(metricName="fMeasureByLabel", metricLabel=1.0)


def trial_points(experiment: Experiment, trials: int, seed: int = C.SEED) -> list[dict]:
    """Random points to start a search with; a known-good setting, if there is one, is always the first."""
    if not experiment.space:
        raise ValueError(f"{experiment.name} has no search space")
    rng = random.Random(seed)
    first = [dict(experiment.warm_start)] if experiment.warm_start else []
    return (first + [draw(experiment.space, rng) for _ in range(trials)])[:trials]


STARTUP_TRIALS = 10  # drawn at random, before there is enough to learn from
BETTER_SHARE = 0.25
CANDIDATES = 24  # draws per parameter that the densities choose from


def _place(kind: str, bounds: tuple, value) -> float:
    """A number of a range as its place between 0 and 1."""
    low, high = (log(bounds[0]), log(bounds[1])) if kind == "log" else bounds
    return ((log(value) if kind == "log" else value) - low) / (high - low)


def _value(kind: str, bounds: tuple, place: float):
    if kind == "int":
        return min(bounds[1], max(bounds[0], round(bounds[0] + place * (bounds[1] - bounds[0]))))
    if kind == "log":
        return exp(log(bounds[0]) + place * (log(bounds[1]) - log(bounds[0])))
    return bounds[0] + place * (bounds[1] - bounds[0])


def _kernels(places: list[float]) -> list[tuple[float, float]]:
    """(centre, width) of a bell around each place and a wide one over the whole range.

    A bell is as wide as the larger gap to its neighbours, within bounds that narrow as places become many.
    """
    ordered = [0.0, *sorted(places), 1.0]
    narrowest = 1.0 / min(100, len(places) + 2)
    bells = [
        (here, min(1.0, max(narrowest, here - before, after - here)))
        for before, here, after in zip(ordered, ordered[1:], ordered[2:])
    ]
    return [*bells, (0.5, 1.0)]


def _log_density(kernels: list[tuple[float, float]], x: float) -> float:
    bells = [exp(-0.5 * ((x - m) / w) ** 2) / (w * sqrt(2 * pi)) for m, w in kernels]
    return log(sum(bells) / len(bells) + 1e-300)


def _promising(kind: str, bounds: tuple, better: list, rest: list, rng: random.Random):
    """The draw from the density of the better values that is rarest among the others."""
    if kind == "choice":
        options = list(bounds[0])
        weight = {o: (better.count(o) + 1) / (len(better) + len(options)) for o in options}
        other = {o: (rest.count(o) + 1) / (len(rest) + len(options)) for o in options}
        drawn = rng.choices(options, [weight[o] for o in options], k=CANDIDATES)
        return max(drawn, key=lambda o: weight[o] / other[o])
    good = _kernels([_place(kind, bounds, v) for v in better])
    bad = _kernels([_place(kind, bounds, v) for v in rest])
    drawn = []
    while len(drawn) < CANDIDATES:
        centre, width = rng.choice(good)
        x = rng.gauss(centre, width)
        if 0.0 <= x <= 1.0:
            drawn.append(x)
    return _value(kind, bounds, max(drawn, key=lambda x: _log_density(good, x) - _log_density(bad, x)))


def suggest(space: dict[str, tuple], tried: list[tuple[dict, float]], rng: random.Random) -> dict:
    """The next point to try after (point, score) of earlier ones; larger scores are better, ties go to earlier points."""
    ranked = [point for point, _ in sorted(tried, key=lambda t: -t[1])]
    cut = ceil(BETTER_SHARE * len(ranked))
    return {
        name: _promising(kind, tuple(bounds), [p[name] for p in ranked[:cut]], [p[name] for p in ranked[cut:]], rng)
        for name, (kind, *bounds) in space.items()
    }


def search(
    space: dict[str, tuple],
    first: list[dict],
    trials: int,
    together: int,
    evaluate: Callable[[list[dict]], list[float]],
    seed: int = C.SEED,
) -> list[tuple[dict, float]]:
    """``trials`` points and their scores in the order of trial, beginning with ``first``.

    ``evaluate`` scores ``together`` points at a time. A point of a round that has no score yet counts as a poor one, so
    that its round does not try the same place again.
    """
    rng, tried = random.Random(seed + 1), []
    while len(tried) < trials:
        many = min(together, trials - len(tried))
        batch = first[len(tried) : len(tried) + many]
        while len(batch) < many:
            lowest = min((score for _, score in tried), default=0.0)
            batch.append(suggest(space, [*tried, *[(point, lowest) for point in batch]], rng))
        tried += zip(batch, evaluate(batch))
    return tried


def _estimator(experiment: Experiment, facts: TrainingFacts, early_stop: bool) -> Pipeline:
    """Classifier of one trial; scaling is fitted inside each fold."""
    classifier = experiment.build(experiment.params, facts)
    if early_stop and isinstance(classifier, GBTClassifier):
        classifier = classifier.setValidationIndicatorCol("is_validation")
    stages = []
    if experiment.scaled:
        scaled = "scaled_features" if experiment.fourier else "features"
        stages.append(StandardScaler(inputCol="raw_features", outputCol=scaled, withMean=True, withStd=True))
    if experiment.fourier:
        stages.append(
            RandomFourierFeatures(
                inputCol="scaled_features",
                outputCol="features",
                numFeatures=experiment.params["fourierFeatures"],
                # Scaled inputs have unit variance, where both settings of gamma agree.
                gamma=1.0 / facts.inputs,
                seed=C.SEED,
            )
        )
    return Pipeline(stages=[*stages, classifier])


def tune_model(
    training: DataFrame,
    experiment: Experiment,
    trials: int = 30,
    parallelism: int = 4,
    early_stop: bool = True,
    fixed: dict | None = None,
) -> tuple[dict, list[dict]]:
    """Best point and the mean fold F1 of every point; held-out rows are never used.

    ``parallelism`` points are tried at a time, their folds side by side, and learnt from together. ``fixed`` overrides drawn values, for example to bound the number of trees.
    """
    first = trial_points(experiment, min(trials, STARTUP_TRIALS))
    split = sampling.with_split(prepare(training, experiment)).persist()
    train = split.where(~F.col("is_test"))
    counts = class_counts(train)
    train = spread_rows(train, sum(counts.values()), per_task=rows_per_task(experiment))
    vectors = Pipeline(stages=vectoriser()).fit(train).transform(train)
    vectors = vectors.withColumnRenamed("features", "raw_features") if experiment.scaled else vectors
    column = "raw_features" if experiment.scaled else "features"
    prepared = cut_lineage(
        sampling.with_cv_fold(vectors)
        .select("label", column, "fold", (hash_fraction(F.col("UDI"), "validation") < 0.1).alias("is_validation"))
        .withColumn(WEIGHT, weight_column(experiment, counts))
    ).persist()
    split.unpersist()
    classes = len(C.FAILURE_CLASSES) if experiment.multiclass else 2
    facts = TrainingFacts(len(prepared.first()[column]), classes, sum(counts.values()))

    judge = evaluator_for(experiment)

    def fold_score(point: dict, fold: int) -> float:
        # Every point is a complete estimator of its own: structure (layers) may differ between points.
        whole = experiment.with_params(**{**point, **(fixed or {})})
        model = _estimator(whole, facts, early_stop).fit(prepared.where(F.col("fold") != fold))
        return judge.evaluate(model.transform(prepared.where(F.col("fold") == fold)))

    def evaluate(points: list[dict]) -> list[float]:
        # All folds of all points at a time: a fit is a chain of short jobs that fills no cluster.
        fits = [(point, fold) for point in points for fold in range(C.CV_FOLDS)]
        scores = side_by_side(prepared.sparkSession, [lambda fit=fit: fold_score(*fit) for fit in fits])
        return [sum(scores[i : i + C.CV_FOLDS]) / C.CV_FOLDS for i in range(0, len(scores), C.CV_FOLDS)]

    tried = search(experiment.space, first, trials, parallelism, evaluate)
    prepared.unpersist()
    points = [{**experiment.params, **point, **(fixed or {})} for point, _ in tried]
    scores = [float(score) for _, score in tried]
    trials_table = [{**point, "mean_f1": score} for point, score in zip(points, scores)]
    best = max(range(len(points)), key=lambda i: scores[i])
    return points[best], trials_table


def tune_and_train(
    training: DataFrame, experiment: Experiment, trials: int = 30, **search
) -> tuple[CalibratedModel, dict[str, float], dict]:
    """Search, then fit once more with the best point on the whole training split.

    Settings outside the search space keep the experiment's values, and early stopping, which
    needs held-out rows, is left to the search.
    """
    best, _ = tune_model(training, experiment, trials, **search)
    model, scores, params = train_model(training, experiment.with_params(**best))
    return model, scores, {**params, "tuned": True, "trials": trials}
