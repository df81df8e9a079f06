from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from torqline.llm.sharding import (
    _large_hypergeometric,
    communication_matrix,
    hypergeometric_shards,
    shard_sizes,
)


def test_every_row_once_with_exact_sizes_and_gapless_slots(docs, rows):
    found = hypergeometric_shards(docs, 7)
    assert [c for c in found.columns if c.lower() == "shard"] == ["shard"]
    got = found.collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(rows)
    by_shard = {j: sorted(r["slot"] for r in got if r["shard"] == j) for j in range(7)}
    assert [len(by_shard[j]) for j in range(7)] == shard_sizes(len(rows), 7)
    assert all(slots == list(range(len(slots))) for slots in by_shard.values())


def test_seed_decides_and_more_shards_than_rows_work(docs, rows):
    def places(**kw):
        return sorted((r["shard"], r["slot"], str(r["text"])) for r in hypergeometric_shards(docs, **kw).collect())

    assert places(shards=3, seed=1) == places(shards=3, seed=1) != places(shards=3, seed=2)
    assert len(places(shards=500)) == len(rows)


def test_equal_rows_are_shuffled(spark, tmp_path):
    """A thousand equal rows of five thousand lie like any other thousand: in every shard, and seldom side by side."""
    rows = spark.range(5000).select(
        F.when(F.col("id") < 1000, F.lit(7)).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") < 1000, F.lit("same")).otherwise(F.col("id").cast("string")).alias("text"),
    )
    rows.repartition(4).write.parquet(f"{tmp_path}/rows")
    got = hypergeometric_shards(spark.read.parquet(f"{tmp_path}/rows"), 10).collect()
    held = Counter(r["shard"] for r in got if r["doc_id"] == 7)
    assert sorted(held) == list(range(10)) and 60 <= min(held.values()) and max(held.values()) <= 140
    order = [r["doc_id"] == 7 for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))]
    assert 130 <= sum(a and b for a, b in zip(order, order[1:])) <= 270


def test_empty_table(nothing):
    assert hypergeometric_shards(nothing, 4).count() == 0


def test_matrix_has_given_sums_and_hypergeometric_means():
    counts, sizes = [50, 0, 30, 20], [34, 33, 33]
    draws = np.array([communication_matrix(counts, sizes, seed) for seed in range(600)])
    assert (draws.sum(axis=2) == counts).all() and (draws.sum(axis=1) == sizes).all()
    expected = np.outer(counts, sizes) / 100
    assert np.abs(draws.mean(axis=0) - expected).max() < 0.4
    # Variance of one entry: n K (N-K) (N-n) / (N^2 (N-1)).
    assert draws[:, 0, 0].var() == pytest.approx(50 * 34 * 66 * 50 / (100**2 * 99), rel=0.2)
    with pytest.raises(ValueError):
        communication_matrix([3], [2])


def test_large_populations_follow_the_same_law():
    rng = np.random.default_rng(0)
    own = [_large_hypergeometric(rng, 400, 600, 100) for _ in range(4000)]
    numpy = rng.hypergeometric(400, 600, 100, 4000)
    assert np.mean(own) == pytest.approx(numpy.mean(), abs=0.4)
    assert np.var(own) == pytest.approx(numpy.var(), rel=0.12)
    big = [_large_hypergeometric(rng, 10**10, 3 * 10**10, 10**5) for _ in range(300)]
    assert np.mean(big) == pytest.approx(25_000, rel=0.002)
