"""Training, calibration, tuning, model store and streams with real models."""

from __future__ import annotations

import math
import random
import threading
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from torqline import config as C
from torqline.functions import features
from torqline.operators import etl, registry, scoring
from torqline.plans import catalog
from torqline.session import scratch_path
from torqline.sources import readings as rd
from torqline.sources import schemas
from torqline.sources.model_store import ModelStore
from torqline.streaming.scoring import ProductionModels
from torqline.training import sampling, tuning
from torqline.training.calibration import calibrated_probabilities, fit_sigmoids
from torqline.training.experiments import EXPERIMENTS, draw
from torqline.training.model import (
    SCORED_PER_TASK,
    CalibratedModel,
    check_classes,
    cut_lineage,
    fits_at_once,
    rows_per_task,
    side_by_side,
    spread_rows,
    train_model,
)
from torqline.training.tuning import search, trial_points, tune_model

SMALL = {
    "xgboost": {"maxIter": 2, "maxDepth": 3},
    "lightgbm": {"maxIter": 2, "maxDepth": 2, "minInstancesPerNode": 1},
    "random_forest": {"numTrees": 5, "maxDepth": 4},
    "logreg": {"maxIter": 20},
    "svm": {"maxIter": 3, "fourierFeatures": 16},
    "mlp": {"maxIter": 5},
}


@pytest.fixture(scope="module")
def small_table(spark, sf_dir):
    """A hundred and fifty rows in which every failure class occurs."""
    return rd.failure_pattern(rd.events(spark, sf_dir)).where("UDI <= 150").cache()


@pytest.mark.parametrize("name", list(EXPERIMENTS))
def test_every_experiment_trains_calibrated(small_table, name):
    experiment = EXPERIMENTS[name]
    model, scores, params = train_model(small_table, experiment.with_params(**SMALL[experiment.family]))
    assert len(model.classifiers) == C.CALIBRATION_FOLDS
    assert 0.0 <= scores["f1_test"] <= 1.0 and 0.0 <= scores["brier_score"] <= 1.0
    assert ("roc_auc_test" in scores) == (not experiment.multiclass)
    assert params["model_family"] == experiment.family


def test_training_after_a_purge_in_the_same_session(spark, small_table):
    """Models with a training summary hold the session, which must stay one that tasks can be sent with."""
    assert etl.purge_exported(spark.range(20), spark.range(5), scratch_path(spark, "purged")) == 5
    assert etl.purge_exported(spark.range(20), spark.range(20), scratch_path(spark, "purged")) == 20
    _, scores, _ = train_model(small_table, EXPERIMENTS["logreg_binary"].with_params(**SMALL["logreg"]))
    assert 0.0 <= scores["f1_test"] <= 1.0


def test_twelve_experiments():
    assert len(EXPERIMENTS) == 12
    families = {e.family for e in EXPERIMENTS.values()}
    assert {(e.family, e.multiclass) for e in EXPERIMENTS.values()} == set(product(families, [True, False]))


class Stop(Exception):
    pass


@pytest.mark.parametrize("name", [*(f"train_{n}" for n in EXPERIMENTS), "log_and_promote", "score_batch_model"])
def test_registered_training_has_the_published_settings(spark, sf_dir, monkeypatch, name):
    def seen(table, experiment):
        assert experiment == EXPERIMENTS[experiment.name]
        raise Stop

    monkeypatch.setattr(catalog, "train_model", seen)
    with pytest.raises(Stop):
        catalog.QUERIES[name](spark, sf_dir)


def test_the_multiclass_boosting_trains_on_the_whole_table(spark, tmp_path, monkeypatch):
    """One row more than the training window; the query must see the oldest one too."""
    rows = C.TRAINING_WINDOW + 1
    empty = [F.lit(None).cast(field.dataType).alias(field.name) for field in schemas.EVENTS.fields[1:]]
    events = spark.range(rows).select(F.col("id").alias("event_id"), *empty)
    events.write.parquet(str(tmp_path / "events.parquet"))

    def seen(table, experiment):
        assert table.agg(F.count("UDI"), F.countDistinct("UDI"), F.min("UDI")).first()[:] == (rows, rows, 1)
        raise Stop

    monkeypatch.setattr(catalog, "train_model", seen)
    with pytest.raises(Stop):
        catalog.QUERIES["train_xgb_multiclass"](spark, str(tmp_path))


@pytest.mark.parametrize("rows, expected", [(0, (3, 5)), (50_000, (3, 5)), (400_000, (3, 1)), (800_000, (2, 1)), (10**8, (1, 1))])
def test_fits_of_a_large_table_follow_one_another(spark, rows, expected):
    """Eight cores; each fit of a large table has a task for every 50,000 rows."""
    assert fits_at_once(spark, rows, EXPERIMENTS["xgb_multiclass"]) == expected


def test_registered_search_has_all_trials_and_nothing_fixed(spark, sf_dir, monkeypatch):
    def seen(table, experiment, trials=30, **rest):
        assert experiment == EXPERIMENTS[experiment.name] and trials == 30 and not rest.get("fixed")
        raise Stop

    monkeypatch.setattr(catalog, "tune_model", seen)
    with pytest.raises(Stop):
        catalog.QUERIES["tune_gbt"](spark, sf_dir)


@pytest.mark.parametrize("name, tasks", [("lgbm_multiclass", 1), ("xgb_binary", 1), ("rf_binary", 4)])
def test_boosted_fits_of_a_window_have_one_task_per_step(spark, name, tasks):
    """Forests have few and heavy steps and keep theirs; scoring, one step, is spread wider than both."""
    rows = spark.range(100).withColumnRenamed("id", "UDI")
    spread = spread_rows(rows, 40_000, per_task=rows_per_task(EXPERIMENTS[name]))
    assert spread.rdd.getNumPartitions() == tasks
    assert spread_rows(rows, 40_000, per_task=SCORED_PER_TASK).rdd.getNumPartitions() == 20


def test_cut_lineage_reads_stored_rows(spark):
    calls = spark.sparkContext.accumulator(0)

    def seen(rows):
        for row in rows:
            calls.add(1)
            yield row

    made = cut_lineage(spark.range(7).rdd.mapPartitions(seen).toDF())
    before = calls.value
    assert sorted(r["id"] for r in made.collect()) == list(range(7)) and calls.value == before


def test_all_folds_of_all_points_are_fitted_side_by_side(spark, sf_dir, monkeypatch):
    together = []

    def noted(session, tasks):
        together.append(len(tasks))
        return [float(i) for i in range(len(tasks))]

    monkeypatch.setattr(tuning, "side_by_side", noted)
    table = rd.failure_pattern(rd.events(spark, sf_dir))
    _, trials = tune_model(table, EXPERIMENTS["lgbm_binary"], trials=5)
    assert together == [4 * C.CV_FOLDS, C.CV_FOLDS]
    assert [t["mean_f1"] for t in trials] == [2.0, 7.0, 12.0, 17.0, 2.0]


def test_score_batch_model_spreads_the_readings(spark, sf_dir, readings, monkeypatch):
    """A table in one file would be scored in one task."""
    model = CalibratedModel(None, [], [], "probability", 2)
    monkeypatch.setattr(catalog, "_trained", lambda *_: (None, model, None, None))
    monkeypatch.setattr(catalog, "SCORED_PER_TASK", 100)

    def seen(source, gate, detail):
        assert source.rdd.getNumPartitions() == math.ceil(readings.count() / 100)
        assert source.select("id").exceptAll(readings.select("id")).count() == 0 and source.count() == readings.count()
        raise Stop

    monkeypatch.setattr(scoring, "gate_and_detail", seen)
    with pytest.raises(Stop):
        catalog.score_batch_model(spark, sf_dir)


def test_rare_class_is_refused():
    with pytest.raises(ValueError, match="at least 3"):
        check_classes({0: 100, 1: 2}, EXPERIMENTS["rf_binary"])


def test_rare_classes_reach_every_fold(spark):
    df = spark.createDataFrame([(i, float(i < 4)) for i in range(200)], "UDI long, label double")
    folds = sampling.with_calibration_fold(df, {0: 196, 1: 4})
    seen = {tuple(r) for r in folds.select("label", "calibration_fold").distinct().collect()}
    assert seen == {(label, fold) for label in (0.0, 1.0) for fold in range(3)}


def test_sigmoid_fit_equals_gradient_descent_free_reference(spark):
    """The fitted point has a vanishing gradient of Platt's smoothed likelihood."""
    rng = np.random.default_rng(0)
    score = rng.normal(size=400)
    label = (rng.random(400) < 1 / (1 + np.exp(-2 * score + 0.5))).astype(int)
    df = spark.createDataFrame(
        [(0, float(y), [float(-s), float(s)]) for s, y in zip(score, label)], "fold int, label double, scores array<double>"
    )
    slope, intercept = fit_sigmoids(df, 2)[(0, 1)]
    positives = int(label.sum())
    target = np.where(label == 1, (positives + 1) / (positives + 2), 1 / (400 - positives + 2))
    p = 1 / (1 + np.exp(slope * score + intercept))
    assert abs(((target - p) * score).sum()) < 1e-3 and abs((target - p).sum()) < 1e-3
    assert slope < 0


def test_separable_scores_stay_finite(spark):
    rows = [(f, float(y), [float(-y), float(y) * 100]) for f in range(3) for y in (0, 1) for _ in range(10)]
    fitted = fit_sigmoids(spark.createDataFrame(rows, "fold int, label double, scores array<double>"), 2)
    assert set(fitted) == {(0, 1), (1, 1), (2, 1)}
    assert all(math.isfinite(v) for pair in fitted.values() for v in pair)


def test_absent_class_gets_no_probability(spark):
    df = spark.createDataFrame([([1.0, 2.0],)], "scores array<double>")
    flat = (0.0, 700.0)
    p = df.select(calibrated_probabilities(F.col("scores"), [(-1.0, 0.0), (-1.0, 0.0), flat])).first()[0]
    assert p[2] == pytest.approx(0.0, abs=1e-12) and sum(p) == pytest.approx(1.0)


def test_fits_overlap_keep_their_order_and_raise(spark):
    """Three driver tasks that wait for one another only end if all of them run."""
    meet = threading.Barrier(3, timeout=30)

    def task(n):
        meet.wait()
        return spark.range(n).count()

    assert side_by_side(spark, [lambda n=n: task(n) for n in (3, 1, 2)]) == [3, 1, 2]
    with pytest.raises(ZeroDivisionError):
        side_by_side(spark, [lambda: 1, lambda: 1 // 0])


_SURFACE = {"x": ("float", 0.0, 1.0), "rate": ("log", 1e-3, 1.0), "depth": ("int", 1, 20), "kind": ("choice", list("abc"))}


def _height(point):
    off = (point["x"] - 0.3) ** 2 + (math.log10(point["rate"]) / 3 + 0.4) ** 2 + ((point["depth"] - 14) / 19) ** 2
    return -off - (point["kind"] != "b") * 0.2


def test_search_learns_a_known_surface_better_than_random_draws():
    seen, best, by_chance = [], [], []
    for seed in range(20):
        rng = random.Random(seed)
        drawn = [draw(_SURFACE, rng) for _ in range(30)]

        def evaluate(points):
            seen.append(len(points))
            assert all(0 <= p["x"] <= 1 and 1e-3 <= p["rate"] <= 1 and p["depth"] in range(1, 21) for p in points)
            return [_height(p) for p in points]

        tried = search(_SURFACE, drawn[:10], 30, 4, evaluate, seed)
        assert [p for p, _ in tried[:10]] == drawn[:10] and len(tried) == 30
        assert tried == search(_SURFACE, drawn[:10], 30, 4, lambda points: [_height(p) for p in points], seed)
        best.append(max(score for _, score in tried))
        by_chance.append(max(map(_height, drawn)))
    assert set(seen) == {4, 2}
    assert np.mean(best) > np.mean(by_chance) / 2 and np.median(best) > np.median(by_chance)
    assert sum(a > b for a, b in zip(best, by_chance)) >= 14


def test_search_starts_warm_and_is_repeatable():
    points = trial_points(EXPERIMENTS["xgb_binary"], 4)
    assert points[0] == EXPERIMENTS["xgb_binary"].warm_start and points == trial_points(EXPERIMENTS["xgb_binary"], 4)
    assert all(0.01 <= p["stepSize"] <= 0.3 and 2 <= p["maxDepth"] <= 12 for p in points)
    with pytest.raises(ValueError, match="no search space"):
        trial_points(EXPERIMENTS["rf_binary"], 1)


@pytest.mark.parametrize("name, fixed", [("lgbm_binary", {"maxIter": 2, "maxDepth": 2}), ("mlp_multiclass", {"maxIter": 3})])
def test_tuning(spark, sf_dir, name, fixed):
    table = rd.failure_pattern(rd.events(spark, sf_dir))
    best, trials = tune_model(table, EXPERIMENTS[name], trials=2, fixed=fixed)
    assert len(trials) == 2 and all(0.0 <= t["mean_f1"] <= 1.0 for t in trials)
    assert max(trials, key=lambda t: t["mean_f1"])["mean_f1"] == next(
        t["mean_f1"] for t in trials if all(t[k] == v for k, v in best.items())
    )


def test_store_reload_and_scoring(spark, sf_dir, readings):
    """Log, promote, reload while serving, and keep serving when a reload fails."""
    table = rd.failure_pattern(rd.events(spark, sf_dir))
    store = ModelStore(spark, scratch_path(spark, "store"))
    models = ProductionModels(store)
    models.refresh()
    with pytest.raises(RuntimeError, match="no production version"):
        models.scorers()

    experiment = EXPERIMENTS["rf_binary"].with_params(**SMALL["random_forest"])
    model, scores, params = train_model(table, experiment)
    assert store.log_run(experiment, model, scores, params) == "1"
    store.set_alias(C.BINARY_MODEL, "1")
    models.refresh()
    gate, detail = models.scorers()
    assert detail is None and models.version(C.BINARY_MODEL) == "1"

    some = readings.select("id", "machine_type", *C.SENSORS).withColumns(features.derived_features())
    first = scoring.gate_and_detail(some, gate, detail)
    direct = model.as_gate(some.withColumnRenamed("machine_type", "type"))
    columns = ["id", "machine_failure", "failure_probability"]
    assert sorted(first.select(columns).collect()) == sorted(direct.select(columns).collect())
    assert first.where("failure_type IS NOT NULL").count() == 0

    assert store.log_run(experiment, model, scores, params) == "2"
    store.set_alias(C.BINARY_MODEL, "3")  # a version that does not exist
    models.refresh()
    assert models.version(C.BINARY_MODEL) == "1"
    store.set_alias(C.BINARY_MODEL, "2")
    models.refresh()
    assert models.version(C.BINARY_MODEL) == "2"
    store._append("model_versions", (C.BINARY_MODEL, "4", "broken", "/nowhere"), schemas.MODEL_VERSIONS)
    store.set_alias(C.BINARY_MODEL, "4")
    models.refresh()
    assert models.version(C.BINARY_MODEL) == "2" and C.BINARY_MODEL in models.errors
    report = registry.promotion_report(store.versions(), store.aliases(), store.runs()).first()
    assert report["candidate_version"] == "4" and report["decision"] == "NO METRIC"


def test_saved_kernel_model_scores_the_same(spark, sf_dir, small_table):
    experiment = EXPERIMENTS["svm_multiclass"].with_params(**SMALL["svm"])
    model, _, _ = train_model(small_table, experiment)
    path = scratch_path(spark, "model")
    model.save(path)
    loaded = CalibratedModel.load(spark, path)
    frame = features.feature_slice(features.engineer_features(small_table), "UDI")
    pick = ["UDI", "probability", "prediction"]
    assert sorted(model.transform(frame).select(pick).collect()) == sorted(loaded.transform(frame).select(pick).collect())
