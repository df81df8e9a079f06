"""The twelve experiments: six model families, each for the binary and the multiclass target."""

from __future__ import annotations

import random
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from math import exp, log

from pyspark.ml import Estimator
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    OneVsRest,
    RandomForestClassifier,
)

from torqline import config as C

WEIGHT = "weight"


@dataclass(frozen=True)
class TrainingFacts:
    """What an estimator needs to know about the prepared training rows."""

    inputs: int
    classes: int
    rows: int
    # Classifiers of one fit that may train at the same time.
    at_once: int = len(C.FAILURE_CLASSES)


@dataclass(frozen=True)
class Experiment:
    """One model family on one target.

    ``params`` are settings of the Spark estimator that ``build`` makes. ``weighting`` is
    ``ratio`` (positives weigh negatives per positive), ``balanced`` or ``none``. ``score``
    names the output column calibration works on. ``space`` maps a parameter to its search
    range; without one the experiment cannot be tuned.
    """

    name: str
    family: str
    multiclass: bool
    build: Callable[[dict, TrainingFacts], Estimator]
    params: dict
    weighting: str
    score: str
    scaled: bool = False
    fourier: bool = False
    space: dict[str, tuple] = field(default_factory=dict)
    warm_start: dict | None = None

    @property
    def target(self) -> str:
        return "failure_type" if self.multiclass else "machine_failure"

    @property
    def model_name(self) -> str:
        return C.MULTICLASS_MODEL if self.multiclass else C.BINARY_MODEL

    @property
    def experiment_path(self) -> str:
        kind = "multiclass" if self.multiclass else "binary"
        return f"predictive-maintenance/{self.family.replace('_', '-')}/{kind}"

    def with_params(self, **params) -> Experiment:
        return replace(self, params={**self.params, **params})


def draw(space: dict[str, tuple], rng: random.Random) -> dict:
    """One random point: ints and floats uniform, ``log`` ranges uniform in the exponent."""
    point = {}
    for name, (kind, *bounds) in space.items():
        if kind == "int":
            point[name] = rng.randint(*bounds)
        elif kind == "float":
            point[name] = rng.uniform(*bounds)
        elif kind == "log":
            point[name] = exp(rng.uniform(log(bounds[0]), log(bounds[1])))
        else:
            point[name] = rng.choice(bounds[0])
    return point


def _common(weighted: bool) -> dict:
    settings = {"featuresCol": "features", "labelCol": "label"}
    if weighted:
        settings["weightCol"] = WEIGHT
    return settings


def _one_vs_rest(classifier: Estimator, weighted: bool, facts: TrainingFacts) -> OneVsRest:
    return OneVsRest(classifier=classifier, parallelism=facts.at_once, **_common(weighted))


def _boosted(params: dict) -> dict:
    """Column sampling is given as a share and taken per node."""
    known = {k: v for k, v in params.items() if k != "columnShare"}
    if "columnShare" in params:
        known["featureSubsetStrategy"] = str(round(params["columnShare"], 4))
    return {**known, "seed": C.SEED}


def boosted_binary(params: dict, facts: TrainingFacts) -> Estimator:
    return GBTClassifier(**_boosted(params), **_common(True))


def boosted_multiclass(params: dict, facts: TrainingFacts) -> Estimator:
    return _one_vs_rest(GBTClassifier(**_boosted(params)), weighted=False, facts=facts)


def forest(params: dict, facts: TrainingFacts) -> Estimator:
    return RandomForestClassifier(**params, seed=C.SEED, **_common(True))


def logistic(params: dict, facts: TrainingFacts) -> Estimator:
    return LogisticRegression(**params, **_common(True))


def _svm_settings(params: dict, facts: TrainingFacts) -> dict:
    """The soft-margin constant C as a penalty on the mean hinge loss."""
    others = {k: v for k, v in params.items() if k not in ("C", "gamma", "fourierFeatures")}
    return {"regParam": 1.0 / (params["C"] * facts.rows), **others}


def svm_binary(params: dict, facts: TrainingFacts) -> Estimator:
    return LinearSVC(**_svm_settings(params, facts), **_common(True))


def svm_multiclass(params: dict, facts: TrainingFacts) -> Estimator:
    return _one_vs_rest(LinearSVC(**_svm_settings(params, facts)), weighted=True, facts=facts)


def perceptron(params: dict, facts: TrainingFacts) -> Estimator:
    hidden = [int(width) for width in params["hidden"].split("_")]
    others = {k: v for k, v in params.items() if k != "hidden"}
    return MultilayerPerceptronClassifier(
        layers=[facts.inputs, *hidden, facts.classes], seed=C.SEED, **others, **_common(False)
    )


# Published settings and search ranges of the experiments.
_XGB_WINNER = {
    "maxIter": 155,
    "maxDepth": 8,
    "stepSize": 0.0856,
    "minInstancesPerNode": 1,
    "subsamplingRate": 0.6472,
    "columnShare": 0.9604,
}
_BOOSTED_SPACE = {"maxIter": ("int", 100, 500), "stepSize": ("log", 0.01, 0.3)}
_XGB_SPACE = {
    **_BOOSTED_SPACE,
    "minInstancesPerNode": ("int", 1, 20),
    "subsamplingRate": ("float", 0.5, 1.0),
    "columnShare": ("float", 0.5, 1.0),
}
_SVM_PARAMS = {"C": 1.0, "gamma": "scale", "fourierFeatures": 256, "maxIter": 100}
_SVM_SPACE = {"C": ("log", 1e-2, 1e2), "gamma": ("choice", ["scale", "auto"])}
_MLP_PARAMS = {"hidden": "128_64", "maxIter": 300}
_MLP_SPACE = {"hidden": ("choice", ["64", "128", "64_32", "128_64"])}

EXPERIMENTS: dict[str, Experiment] = {
    e.name: e
    for e in [
        Experiment(
            "xgb_binary",
            "xgboost",
            False,
            boosted_binary,
            _XGB_WINNER,
            "ratio",
            "probability",
            space={**_XGB_SPACE, "maxDepth": ("int", 2, 12)},
            warm_start=_XGB_WINNER,
        ),
        Experiment(
            "xgb_multiclass",
            "xgboost",
            True,
            boosted_multiclass,
            {"maxIter": 200},
            "none",
            "rawPrediction",
            space={**_XGB_SPACE, "maxDepth": ("int", 2, 6)},
        ),
        Experiment(
            "lgbm_binary",
            "lightgbm",
            False,
            boosted_binary,
            {"maxIter": 200, "maxDepth": 4},
            "ratio",
            "probability",
            space={**_BOOSTED_SPACE, "maxDepth": ("int", 2, 8), "minInstancesPerNode": ("int", 10, 100)},
        ),
        Experiment(
            "lgbm_multiclass",
            "lightgbm",
            True,
            boosted_multiclass,
            {"maxIter": 200, "maxDepth": 3, "minInstancesPerNode": 30},
            "none",
            "rawPrediction",
            space={**_BOOSTED_SPACE, "maxDepth": ("int", 2, 6), "minInstancesPerNode": ("int", 20, 150)},
        ),
        *[
            Experiment(
                f"rf_{kind}",
                "random_forest",
                kind == "multiclass",
                forest,
                # Depth is unlimited in the original setting; 30 is the deepest Spark grows.
                {"numTrees": 100, "maxDepth": 30},
                "balanced",
                "probability",
            )
            for kind in ("binary", "multiclass")
        ],
        *[
            Experiment(
                f"logreg_{kind}",
                "logreg",
                kind == "multiclass",
                logistic,
                {"maxIter": 1000, "standardization": False, "family": "auto"},
                "balanced",
                "rawPrediction",
            )
            for kind in ("binary", "multiclass")
        ],
        *[
            Experiment(
                f"svm_{kind}",
                "svm",
                kind == "multiclass",
                svm_multiclass if kind == "multiclass" else svm_binary,
                _SVM_PARAMS,
                "balanced",
                "rawPrediction",
                scaled=True,
                fourier=True,
                space=_SVM_SPACE,
            )
            for kind in ("binary", "multiclass")
        ],
        *[
            Experiment(
                f"mlp_{kind}",
                "mlp",
                kind == "multiclass",
                perceptron,
                _MLP_PARAMS,
                "none",
                "probability",
                scaled=True,
                space=_MLP_SPACE,
            )
            for kind in ("binary", "multiclass")
        ],
    ]
}
