"""Random forests as flat arrays."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from torqline import config as C
from torqline.training.forest import forest_scores, pack
from torqline.training.model import CalibratedModel, scored_per_task
from torqline.training.vectors import vectoriser


def _nodes(*rows):
    """Rows of (tree, id, left, right, feature, categories, threshold)."""
    names = ["tree", "id", "left", "right", "feature", "categories", "threshold"]
    return pa.table({name: list(values) for name, values in zip(names, zip(*rows))})


def test_a_packed_tree_goes_the_ways_of_spark():
    """At or below a threshold: left. A category goes left if it is named. A leaf may be a whole tree, or hold nothing."""
    nodes = _nodes(
        (0, 0, 1, 4, 0, -1, 2.5),
        (0, 1, 2, 3, 1, 2, 1.0),
        (0, 2, -1, -1, -1, -1, 0.0),
        (0, 3, -1, -1, -1, -1, 0.0),
        (0, 4, 5, 6, 1, 2, 0.0),
        (0, 5, -1, -1, -1, -1, 0.0),
        (0, 6, -1, -1, -1, -1, 0.0),
        (1, 0, -1, -1, -1, -1, 0.0),
    )
    stats = np.array([[9, 9], [9, 9], [3, 1], [0, 0], [9, 9], [1, 3], [0, 2], [1, 1]], float)
    forest = pack(nodes, stats, 2)
    x = np.array([[2.5, 1], [2.5, 0], [np.nextafter(2.5, 3), 0], [9, 1], [math.nan, 1], [-math.inf, 1]])
    first = np.array([[0.75, 0.25], [0, 0], [0.25, 0.75], [0, 1], [0, 1], [0.75, 0.25]])
    expected = first + 0.5
    assert np.array_equal(forest.probabilities(x), expected / expected.sum(axis=1, keepdims=True))
    assert forest.probabilities(x[:0]).shape == (0, 2)
    assert pack(_nodes((0, 0, 1, 2, 0, 3, 0.0), (0, 1, -1, -1, -1, -1, 0.0), (0, 2, -1, -1, -1, -1, 0.0)), stats[:3], 1) is None


@pytest.fixture(scope="module")
def prepared(spark):
    """Rows of all machine types, with labels that a tree cannot tell apart."""
    rng = np.random.default_rng(3)
    rows = [
        (i, "LMH"[i % 3], *map(float, rng.integers(0, 40, len(C.NUMERIC_FEATURES))), float(rng.integers(0, 4)))
        for i in range(900)
    ]
    names = ["UDI", "type", *C.NUMERIC_FEATURES, "label"]
    df = spark.createDataFrame(rows, names).repartition(3, "UDI")
    return Pipeline(stages=vectoriser()).fit(df).transform(df).select("UDI", "label", "features").cache()


@pytest.mark.parametrize("classes", [2, 4])
def test_scores_equal_those_of_the_model_to_the_last_bit(spark, prepared, classes):
    rows = prepared.withColumn("label", F.col("label") % classes).withColumn("weight", F.col("UDI") % 7 + 1.0)
    forests = [
        Pipeline(stages=[RandomForestClassifier(numTrees=trees, maxDepth=12, seed=trees, weightCol="weight")]).fit(rows)
        for trees in (3, 20)
    ]
    scores = forest_scores(spark, forests)(vector_to_array("features"))
    mine = {r["UDI"]: r["scores"] for r in rows.select("UDI", scores.alias("scores")).collect()}
    for k, forest in enumerate(forests):
        theirs = forest.transform(rows).select("UDI", "probability").collect()
        assert len(theirs) == 900 and all(list(r["probability"]) == mine[r["UDI"]][k] for r in theirs)
    model = CalibratedModel(None, forests, [[(-2.0, 1.0)] * (1 if classes == 2 else classes)] * 2, "probability", classes)
    predicted = model.predict(rows)
    plan = predicted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and predicted.columns == [*rows.columns, "probability", "prediction"]
    assert predicted.count() == 900


def test_other_models_score_for_themselves(spark, prepared):
    rows = prepared.withColumn("label", F.col("label") % 2)
    logistic = Pipeline(stages=[LogisticRegression(maxIter=2)]).fit(rows)
    assert forest_scores(spark, [logistic]) is None and forest_scores(spark, []) is None


def test_sparse_vectors_and_empty_partitions(spark, prepared):
    forest = Pipeline(stages=[RandomForestClassifier(numTrees=4, maxDepth=5, seed=1)]).fit(prepared)
    some = prepared.where("UDI < 3").repartition(8, "UDI").select("UDI", "features")
    zero = some.select("UDI", array_to_vector(F.transform(vector_to_array("features"), lambda v: v * 0)).alias("features"))
    for df in (some, zero):
        mine = df.select("UDI", forest_scores(spark, [forest])(vector_to_array("features"))[0].alias("p"))
        theirs = forest.transform(df).select("UDI", vector_to_array("probability").alias("p"))
        assert sorted(map(tuple, mine.collect())) == sorted(map(tuple, theirs.collect())) and mine.count() == 3


def test_scoring_tasks_grow_with_a_large_table(spark):
    """Eight cores with 64 tasks each; up to that, tasks stay small."""
    assert [scored_per_task(spark, n) for n in (0, 40_000, 1_024_000, 36_000_000)] == [2_000, 2_000, 2_000, 70_313]
    assert scored_per_task(spark, 1_000, 100) == 100
