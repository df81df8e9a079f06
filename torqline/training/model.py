"""Training a calibrated classifier, applying it, and saving it."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from math import ceil

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from torqline import config as C
from torqline.functions import features, labels
from torqline.operators import metrics
from torqline.session import shared_folder
from torqline.training import sampling
from torqline.training.calibration import (
    argmax_index,
    average_probabilities,
    binary_probabilities,
    calibrated_probabilities,
    fit_sigmoids,
)
from torqline.training.experiments import WEIGHT, Experiment, TrainingFacts
from torqline.training.forest import forest_scores
from torqline.training.fourier import RandomFourierFeatures
from torqline.training.vectors import vectoriser

ROWS_PER_TASK = 10_000
# Each level of each boosted tree is a job of its own: the start of its tasks costs more than their rows, and many such
# fits run side by side.
BOOSTED_PER_TASK = 50_000
# Scoring walks every tree of all folds for each row and is one job.
SCORED_PER_TASK = 2_000
# More rows than that on a table so large that each core has this many scoring tasks.
SCORINGS_PER_CORE = 64
# Fits run side by side until each core has about this many of their tasks; every one keeps its own rows.
TASKS_PER_CORE = 4
_MODEL_OUTPUTS = ["rawPrediction", "probability", "prediction"]


def prepare(training: DataFrame, experiment: Experiment) -> DataFrame:
    """Training rows as key, model features and numeric ``label``."""
    engineered = features.engineer_features(training)
    if experiment.multiclass:
        label = labels.encode_class(labels.failure_type())
    else:
        label = F.col("machine_failure")
    return engineered.select("UDI", *C.FEATURES, label.cast("double").alias("label"))


def class_counts(df: DataFrame) -> dict[int, int]:
    return {int(r["label"]): r["n"] for r in df.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}


def spread_rows(df: DataFrame, rows: int, key: str = "UDI", per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Rows spread over tasks by key, as many as the row count is worth, in a repeatable order.

    A top-k window arrives in one partition, and learners that sample rows by their place in a
    partition must see the same places when a lost one is rebuilt.
    """
    return df.repartition(max(1, ceil(rows / per_task)), key).sortWithinPartitions(key)


def scored_per_task(spark: SparkSession, rows: int, least: int = SCORED_PER_TASK) -> int:
    """Rows of a scoring task; the start of a task on few rows would cost more than their scores."""
    return max(least, ceil(rows / (SCORINGS_PER_CORE * spark.sparkContext.defaultParallelism)))


def rows_per_task(experiment: Experiment) -> int:
    return BOOSTED_PER_TASK if experiment.family in ("xgboost", "lightgbm") else ROWS_PER_TASK


def weight_column(experiment: Experiment, counts: dict[int, int]) -> Column:
    """Row weight by class, from the class counts of the training split."""
    if experiment.weighting == "ratio":
        table = {0: 1.0, 1: counts.get(0, 0) / counts[1]}
    elif experiment.weighting == "balanced":
        rows = sum(counts.values())
        table = {k: rows / (len(counts) * n) for k, n in counts.items()}
    else:
        return F.lit(1.0)
    weight = F
    for label, value in table.items():
        weight = weight.when(F.col("label") == float(label), F.lit(value))
    return weight.otherwise(F.lit(1.0))


def check_classes(counts: dict[int, int], experiment: Experiment) -> None:
    """Calibration needs every class in every fold."""
    wanted = range(2) if not experiment.multiclass else counts
    rare = {k: counts.get(k, 0) for k in wanted if counts.get(k, 0) < C.CALIBRATION_FOLDS}
    if rare or len(counts) < 2:
        raise ValueError(
            f"{experiment.name}: every class needs at least {C.CALIBRATION_FOLDS} training rows "
            f"and there must be two classes; rows per class: {counts}"
        )


def fit_preparation(train: DataFrame, experiment: Experiment) -> PipelineModel:
    """Vectoriser (and scaler, and kernel map) fitted on the training split only."""
    model = Pipeline(stages=vectoriser(experiment.scaled)).fit(train)
    if not experiment.fourier:
        return model
    return PipelineModel(stages=[*_renamed_output(model), fourier_stage(model.transform(train), experiment)])


def _renamed_output(model: PipelineModel) -> list:
    """The fitted stages, with the last one writing to ``scaled_features``."""
    return [*model.stages[:-1], model.stages[-1].copy().setOutputCol("scaled_features")]


def fourier_stage(scaled: DataFrame, experiment: Experiment) -> RandomFourierFeatures:
    """Kernel map with gamma from the inputs: 1 / (inputs * variance) or 1 / inputs."""
    variances = scaled.select(Summarizer.variance(F.col("features"))).first()[0].toArray()
    spread = float(variances.mean()) if experiment.params["gamma"] == "scale" else 1.0
    return RandomFourierFeatures(
        inputCol="scaled_features",
        outputCol="features",
        numFeatures=experiment.params["fourierFeatures"],
        gamma=1.0 / (len(variances) * spread),
        seed=C.SEED,
    )


def cut_lineage(df: DataFrame) -> DataFrame:
    """The same rows read from the shared folder: tasks and plans built on them no longer carry what came before."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def _forest_scores(classifiers: list[PipelineModel], df: DataFrame, score: str) -> Column | None:
    """Class scores of all folds' models as an array of arrays, where they are forests."""
    scores = forest_scores(df.sparkSession, classifiers) if score == "probability" else None
    return None if scores is None else scores(vector_to_array("features"))


def _with_scores(model, df: DataFrame, score: str) -> DataFrame:
    """Class scores of one fold's model as an array, without its other outputs."""
    of_forest = _forest_scores([model], df, score)
    if of_forest is not None:
        return df.withColumn("scores", of_forest[0])
    scored = model.transform(df).withColumn("scores", vector_to_array(score))
    return scored.drop(*_MODEL_OUTPUTS)


@dataclass
class CalibratedModel:
    """Fitted preparation, one classifier per calibration fold and their sigmoids."""

    preparation: PipelineModel
    classifiers: list[PipelineModel]
    sigmoids: list[list[tuple[float, float]]]
    score: str
    classes: int

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``probability`` (array, averaged over folds) and ``prediction``."""
        return self.predict(self.preparation.transform(df))

    def predict(self, prepared: DataFrame) -> DataFrame:
        scored = prepared
        of_forests = _forest_scores(self.classifiers, prepared, self.score)
        if of_forests is not None:
            # All folds in one trip through Python.
            scored = scored.withColumn("all_scores", of_forests)
        for fold, classifier in enumerate(self.classifiers):
            if of_forests is None:
                scored = _with_scores(classifier, scored, self.score)
            else:
                scored = scored.withColumn("scores", F.col("all_scores")[fold])
            scored = scored.withColumn(f"p_{fold}", self._probabilities(fold)).drop("scores")
        folds = [f"p_{fold}" for fold in range(len(self.classifiers))]
        mean = average_probabilities([F.col(p) for p in folds], self.classes)
        averaged = scored.withColumn("probability", mean).drop(*folds, "all_scores")
        return averaged.withColumn("prediction", argmax_index(F.col("probability")).cast("double"))

    def _probabilities(self, fold: int) -> Column:
        if self.classes == 2:
            return binary_probabilities(F.col("scores"), self.sigmoids[fold][0])
        return calibrated_probabilities(F.col("scores"), self.sigmoids[fold])

    def as_gate(self, df: DataFrame) -> DataFrame:
        """Scorer for the binary gate."""
        scored = self.transform(df)
        return scored.select(
            *df.columns,
            F.col("prediction").cast("int").alias("machine_failure"),
            F.col("probability")[1].alias("failure_probability"),
        )

    def as_detail(self, df: DataFrame) -> DataFrame:
        """Scorer for the failure type of gated rows."""
        return self.transform(df).select(*df.columns, F.col("prediction").cast("int").alias("class_index"))

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        self.preparation.write().overwrite().save(f"{path}/preparation")
        for fold, classifier in enumerate(self.classifiers):
            classifier.write().overwrite().save(f"{path}/classifier-{fold}")
        rows = [
            (fold, position, slope, intercept, self.score, self.classes)
            for fold, sigmoids in enumerate(self.sigmoids)
            for position, (slope, intercept) in enumerate(sigmoids)
        ]
        schema = "fold int, position int, slope double, intercept double, score string, classes int"
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/calibration")

    @staticmethod
    def load(spark: SparkSession, path: str) -> CalibratedModel:
        rows = spark.read.parquet(f"{path}/calibration").orderBy("fold", "position").collect()
        folds = max(r["fold"] for r in rows) + 1
        return CalibratedModel(
            PipelineModel.load(f"{path}/preparation"),
            [PipelineModel.load(f"{path}/classifier-{fold}") for fold in range(folds)],
            [[(r["slope"], r["intercept"]) for r in rows if r["fold"] == fold] for fold in range(folds)],
            rows[0]["score"],
            rows[0]["classes"],
        )


def fits_at_once(spark: SparkSession, rows: int, experiment: Experiment) -> tuple[int, int]:
    """Folds, and classifiers of each, that are fitted at the same time.

    All of them on a window. The steps of one fit on a large table fill the cluster by themselves, and each fit persists
    its rows: side by side they would only take the memory of one another.
    """
    tasks = max(1, ceil(rows / rows_per_task(experiment)))
    fits = max(1, TASKS_PER_CORE * spark.sparkContext.defaultParallelism // tasks)
    folds = min(C.CALIBRATION_FOLDS, fits)
    return folds, min(len(C.FAILURE_CLASSES), fits // folds)


def side_by_side(spark: SparkSession, tasks: list[Callable], at_once: int | None = None) -> list:
    """Results of driver tasks that run their Spark jobs at the same time, in order; the first failure is raised.

    Boosting is a long chain of short jobs, which leaves a cluster idle unless several chains share it.
    """
    with ThreadPoolExecutor(max_workers=at_once or len(tasks)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(task)) for task in tasks]
        return [one.result() for one in running]


def fit_calibrated(train: DataFrame, experiment: Experiment, preparation: PipelineModel) -> CalibratedModel:
    """``train`` is prepared, weighted, persisted and carries ``calibration_fold``."""
    # Boosting cuts the lineage of its errors every few trees, but only where there is a checkpoint folder.
    shared_folder(train.sparkSession)
    counts = class_counts(train)
    # Class indexes stay those of the class list even where one of its classes is absent.
    classes = len(C.FAILURE_CLASSES) if experiment.multiclass else 2
    inputs = len(train.select("features").first()["features"])
    folds, at_once = fits_at_once(train.sparkSession, sum(counts.values()), experiment)
    facts = TrainingFacts(inputs, classes, sum(counts.values()), at_once)
    pipeline = Pipeline(stages=[experiment.build(experiment.params, facts)])
    fold_of = F.col("calibration_fold")
    inside = [train.where(fold_of != fold) for fold in range(C.CALIBRATION_FOLDS)]
    classifiers = side_by_side(train.sparkSession, [lambda rows=rows: pipeline.fit(rows) for rows in inside], folds)
    spread = spread_rows(train, facts.rows, per_task=scored_per_task(train.sparkSession, facts.rows))
    held_out = []
    for fold, classifier in enumerate(classifiers):
        scored = _with_scores(classifier, spread.where(fold_of == fold), experiment.score)
        held_out.append(scored.select(F.lit(fold).alias("fold"), "label", "scores"))
    scores = held_out[0]
    for other in held_out[1:]:
        scores = scores.unionByName(other)
    # Every round of the search plans its job anew, which takes long over the trees of all models.
    fitted = fit_sigmoids(cut_lineage(scores), classes)
    wanted = [1] if classes == 2 else range(classes)
    # A class that was never seen gets no probability.
    sigmoids = [[fitted.get((fold, k), (0.0, 700.0)) for k in wanted] for fold in range(C.CALIBRATION_FOLDS)]
    return CalibratedModel(preparation, classifiers, sigmoids, experiment.score, classes)


def evaluate(scored: DataFrame, experiment: Experiment) -> dict[str, float]:
    """Quality on both splits from (is_test, label, prediction, probability)."""
    counts = metrics.confusion(scored, by=["is_test"]).collect()
    spark = scored.sparkSession
    schema = "is_test boolean, label double, prediction double, n long"
    table = spark.createDataFrame([tuple(r) for r in counts], schema)

    def scores(is_test: bool):
        side = table.where(F.col("is_test") == is_test)
        return (metrics.macro_scores(side) if experiment.multiclass else metrics.binary_scores(side, 1.0)).first()

    train, test = scores(False), scores(True)
    held_out = scored.where("is_test")
    if experiment.multiclass:
        brier = metrics.brier_multiclass(F.col("label"), F.col("probability"), len(C.FAILURE_CLASSES))
    else:
        brier = metrics.brier_binary(F.col("label"), F.col("probability")[1])
    result = {
        "f1_train": train["f1"],
        "f1_test": test["f1"],
        "overfit_delta": train["f1"] - test["f1"],
        "precision_test": test["precision"],
        "recall_test": test["recall"],
        "brier_score": held_out.agg(brier).first()[0],
    }
    if not experiment.multiclass:
        positive = held_out.select("label", F.col("probability")[1].alias("score"))
        result["roc_auc_test"] = metrics.roc_auc(positive).first()[0]
    return result


def train_model(training: DataFrame, experiment: Experiment) -> tuple[CalibratedModel, dict[str, float], dict]:
    """Prepare, split, fit, calibrate and evaluate; returns model, metrics and parameters."""
    split = sampling.with_split(prepare(training, experiment)).persist()
    train = split.where(~F.col("is_test"))
    counts = class_counts(train)
    check_classes(counts, experiment)
    preparation = fit_preparation(train, experiment)
    folds = sampling.with_calibration_fold(train, counts).unionByName(
        split.where("is_test").withColumn("calibration_fold", F.lit(None).cast("int"))
    )
    prepared = cut_lineage(
        preparation.transform(spread_rows(folds, sum(counts.values()), per_task=rows_per_task(experiment)))
        .select("UDI", "label", "features", "is_test", "calibration_fold")
        .withColumn(WEIGHT, weight_column(experiment, counts))
    ).persist()
    model = fit_calibrated(prepared.where(~F.col("is_test")), experiment, preparation)
    rows = sum(counts.values())
    spread = spread_rows(prepared, rows, per_task=scored_per_task(prepared.sparkSession, rows))
    result = evaluate(cut_lineage(model.predict(spread)), experiment)
    for frame in (prepared, split):
        frame.unpersist()
    params = {
        **experiment.params,
        "model_family": experiment.family,
        "target_type": "multiclass" if experiment.multiclass else "binary",
        "test_size": C.TEST_SHARE,
    }
    return model, result, params
