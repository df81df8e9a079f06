"""Random forests as flat arrays: the scores of Spark's model, many rows at a time.

Spark walks every tree of a forest for one row after the other, over node objects all over the heap, and gives each task
a copy of the forest. Here a forest is a few arrays that a worker receives once. A batch of rows goes down one tree
together, whose nodes stay in the cache meanwhile; votes are added in the order of the trees, as Spark does, so
scores are equal to the last bit.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from torqline.session import scratch_path

# A node is one number: its left child, the place of its threshold among those of the feature, the feature.
_CHILD, _PLACE, _MASK = 32, 16, 0xFFFF
# Rows of a batch that have arrived at a leaf are set aside once in so many steps.
_STEPS = 4


@dataclass(frozen=True)
class PackedForest:
    """``cuts``: ascending thresholds of each feature; ``roots``, ``nodes``: all trees; ``votes``: class shares of the nodes.

    The right child of a node follows its left one. A leaf is its own left child and has a threshold that no value is above.
    """

    cuts: list[np.ndarray]
    roots: np.ndarray
    nodes: np.ndarray
    votes: np.ndarray

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Class probabilities of the rows of ``x``."""
        places = np.empty(x.shape, np.int64)
        for feature, cuts in enumerate(self.cuts):
            # How many thresholds a value is above; NaN is above all, and goes right.
            places[:, feature] = np.searchsorted(cuts, x[:, feature])
        flat, first = places.ravel(), np.arange(len(x), dtype=np.int64) * x.shape[1]
        votes = np.zeros((len(x), self.votes.shape[1]))
        leaf = np.empty(len(x), np.int64)
        for root in self.roots:
            self._walk(root, flat, first, leaf)
            votes += self.votes.take(leaf, axis=0)
        total = _in_order(votes)
        return np.divide(votes, total, out=votes, where=total != 0.0)

    def _walk(self, root: int, flat: np.ndarray, first: np.ndarray, leaf: np.ndarray) -> None:
        """Writes to ``leaf`` where each row ends in the tree at ``root``."""
        rows, at = np.arange(len(first)), np.full(len(first), root, np.int64)
        while len(rows):
            for _ in range(_STEPS):
                node = self.nodes.take(at)
                before, at = at, flat.take(first + (node & _MASK)) > ((node >> _PLACE) & _MASK)
                at = at + (node >> _CHILD)
            moving = at != before
            leaf[rows] = at
            rows, first, at = rows[moving], first[moving], at[moving]


def _in_order(values: np.ndarray) -> np.ndarray:
    """Row sums as a column, added from left to right."""
    total = values[:, :1].copy()
    for k in range(1, values.shape[1]):
        total += values[:, k : k + 1]
    return total


def pack(nodes: pa.Table, stats: np.ndarray, features: int) -> PackedForest | None:
    """A forest from its nodes in order of tree and id; None if a split has more than two categories."""
    column = {name: nodes.column(name).to_numpy() for name in nodes.column_names}
    tree, left, right = column["tree"], column["left"].astype(np.int64), column["right"].astype(np.int64)
    inner = np.flatnonzero(left >= 0)
    two = column["categories"][inner] == 2
    if not np.all(two | (column["categories"][inner] < 0)):
        return None
    # Ids count the nodes of a tree from its root.
    roots = np.flatnonzero(column["id"] == 0)
    start = roots[tree]
    # A feature of two categories, 0 and 1, has one threshold: 0.
    swap = two & (column["threshold"][inner] == 1.0)
    threshold = np.where(two, 0.0, column["threshold"][inner])
    children = np.stack([np.where(swap, right[inner], left[inner]), np.where(swap, left[inner], right[inner])], axis=1)

    feature = column["feature"][inner].astype(np.int64)
    cuts = [np.unique(threshold[feature == k]) for k in range(features)]
    if max(features, *map(len, cuts)) > _MASK:
        return None
    place = np.zeros(len(inner), np.int64)
    for k, own in enumerate(cuts):
        place[feature == k] = np.searchsorted(own, threshold[feature == k])

    # The children of a tree's k-th inner node get its places 2k + 1 and 2k + 2.
    rank = np.arange(len(inner)) - np.searchsorted(inner, roots)[tree[inner]]
    child = start[inner] + 2 * rank + 1
    moved = np.arange(len(tree))
    moved[start[inner] + children[:, 0]] = child
    moved[start[inner] + children[:, 1]] = child + 1
    packed = (np.arange(len(tree), dtype=np.int64) << _CHILD) | (_MASK << _PLACE)
    packed[moved[inner]] = (child << _CHILD) | (place << _PLACE) | feature

    total = _in_order(stats)
    votes = np.zeros_like(stats)
    votes[moved] = np.divide(stats, total, out=np.zeros_like(stats), where=total != 0.0)
    return PackedForest(cuts, roots, packed, votes)


_PACKED: WeakKeyDictionary[PipelineModel, PackedForest | None] = WeakKeyDictionary()


def _packed(spark: SparkSession, classifier: PipelineModel) -> PackedForest | None:
    """The forest of a fitted classifier, read from its stored form; None if it is something else."""
    model = classifier.stages[-1]
    if len(classifier.stages) != 1 or not isinstance(model, RandomForestClassificationModel):
        return None
    if classifier not in _PACKED:
        path = scratch_path(spark, "forest")
        model.write().save(path)
        node, split = F.col("nodeData"), F.col("nodeData.split")
        stored = spark.read.parquet(f"{path}/data").select(
            F.col("treeID").alias("tree"),
            node["id"].alias("id"),
            node["leftChild"].alias("left"),
            node["rightChild"].alias("right"),
            split["featureIndex"].alias("feature"),
            split["numCategories"].alias("categories"),
            F.coalesce(F.get(split["leftCategoriesOrThreshold"], F.lit(0)), F.lit(0.0)).alias("threshold"),
            node["impurityStats"].alias("stats"),
        )
        nodes = stored.toArrow().sort_by([("tree", "ascending"), ("id", "ascending")])
        stats = nodes.column("stats").combine_chunks().flatten().to_numpy().reshape(len(nodes), -1)
        _PACKED[classifier] = pack(nodes.drop_columns("stats"), stats, model.numFeatures)
    return _PACKED[classifier]


def forest_scores(spark: SparkSession, classifiers: list[PipelineModel]) -> Callable[[Column], Column] | None:
    """From an array of features to the class probabilities by each of the forests; None if not all are forests."""
    forests = [_packed(spark, classifier) for classifier in classifiers]
    if not forests or None in forests:
        return None
    sent = spark.sparkContext.broadcast(forests)

    @F.arrow_udf("array<array<double>>")
    def scores(rows: pa.Array) -> pa.Array:
        x = rows.flatten().to_numpy().reshape(len(rows), -1) if len(rows) else np.empty((0, len(sent.value[0].cuts)))
        by_forest = [forest.probabilities(x) for forest in sent.value]
        widths = np.tile([p.shape[1] for p in by_forest], len(rows))
        values = np.concatenate(by_forest, axis=1).ravel()
        arrays = pa.ListArray.from_arrays(np.append(0, np.cumsum(widths)).astype(np.int32), pa.array(values))
        ends = np.arange(len(rows) + 1, dtype=np.int32) * len(by_forest)
        return pa.ListArray.from_arrays(ends, arrays)

    return scores
