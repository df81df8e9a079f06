"""Sharding by a hypergeometric communication matrix (DataFrame functions only).

A uniform random permutation of a distributed table, with exact shard sizes, in one exchange of the rows:
how many rows of every input partition go to every shard is drawn first, as it would come out of a uniform
permutation; every partition then permutes its own rows, deals them out by that matrix, and every shard
permutes what it received.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from torqline.llm.common import sent_if_small, stored, without

SHARDS = 40
SEED = 20_240_601
_NUMPY_LIMIT = 10**9
_RANK_BITS = 33  # monotonically_increasing_id keeps the place within a partition in its low 33 bits


def shard_sizes(rows: int, shards: int) -> list[int]:
    """Counts at most one apart, the larger ones first."""
    return [rows // shards + (j < rows % shards) for j in range(shards)]


def _large_hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """One draw for populations beyond numpy's limit: rejection under a ratio-of-uniforms envelope."""
    total = good + bad
    mean = draws * good / total
    spread = math.sqrt(max(mean * (bad / total) * (total - draws) / max(total - 1, 1), 0.0))
    low, high = max(0, draws - bad), min(draws, good)
    if low == high:
        return low
    mode = min(max((draws + 1) * (good + 1) // (total + 2), low), high)

    def log_weight(k: int) -> float:
        return -(
            math.lgamma(k + 1)
            + math.lgamma(good - k + 1)
            + math.lgamma(draws - k + 1)
            + math.lgamma(bad - draws + k + 1)
        )

    top = log_weight(mode)
    width = 2.0 * math.sqrt(2.0 / math.e) * (spread + 0.5) + 3.0
    while True:
        u, v = 1.0 - rng.random(), rng.random() - 0.5
        k = math.floor(mean + 0.5 + width * v / u)
        if low <= k <= high and 2.0 * math.log(u) <= log_weight(k) - top:
            return k


def communication_matrix(row_counts: list[int], sizes: list[int], seed: int = SEED) -> np.ndarray:
    """Rows sent from partition i to shard j: a draw from the law that a uniform permutation follows.

    Row sums are ``row_counts``, column sums are ``sizes``; both must have the same total.
    """
    if sum(row_counts) != sum(sizes):
        raise ValueError("partitions and shards must hold the same number of rows")
    rng = np.random.default_rng(seed)
    left = np.array(sizes, dtype=np.int64)
    matrix = np.zeros((len(row_counts), len(sizes)), dtype=np.int64)
    for i, count in enumerate(row_counts):
        if int(left.sum()) < _NUMPY_LIMIT:
            matrix[i] = rng.multivariate_hypergeometric(left, count, method="marginals")
        else:
            need, pool = count, int(left.sum())
            for j, have in enumerate(left.tolist()):
                pool -= have
                matrix[i, j] = _large_hypergeometric(rng, have, pool, need) if need else 0
                need -= int(matrix[i, j])
        left -= matrix[i]
    return matrix


def hypergeometric_shards(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """All columns of ``docs`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in its shard).

    Shard sizes are exact and at most one apart; the order over (shard, slot) is a uniform permutation that
    depends on ``seed`` and the places of the rows in ``docs``. That must be a stored table: its partitions are
    counted in one pass and dealt out in a second one (a mismatch raises), and a task that runs again reads the same
    rows in the same order. Only one row per input partition and one per block of a shard reach the driver or a
    broadcast.

    A shard is permuted in blocks drawn by hash, each about as large as an input partition, so that no task
    holds a whole shard; a block begins where the blocks before it end.

    Nulls and empty texts are ordinary rows; equal rows are shuffled like all others; an empty table gives an
    empty result; columns already called ``shard`` or ``slot`` are replaced; other columns are kept.
    """
    spark = docs.sparkSession
    docs = without(docs, ["shard", "slot"])
    counts = docs.groupBy(F.spark_partition_id().alias("_tq_part")).count().collect()
    counts = sorted((row["_tq_part"], row["count"]) for row in counts)
    rows = sum(count for _, count in counts)
    sizes = shard_sizes(rows, shards)
    matrix = communication_matrix([count for _, count in counts], sizes, seed)
    ends = np.cumsum(matrix, axis=1)
    deal = spark.createDataFrame(
        [(part, ends[i].tolist()) for i, (part, _) in enumerate(counts)],
        "_tq_part int, _tq_ends array<bigint>",
    )
    deal = sent_if_small(deal, len(counts), 8 * shards + 64)
    blocks = max(1, math.ceil(len(counts) / shards))

    # The place of a row in the stored table, not its content, is what the keys are drawn from: equal rows part.
    permuted = docs.select(
        "*",
        F.spark_partition_id().alias("_tq_part"),
        F.xxhash64(F.lit(seed), F.monotonically_increasing_id()).alias("_tq_key"),
    ).sortWithinPartitions("_tq_key")
    permuted = permuted.select(
        "*", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _RANK_BITS) - 1)).alias("_tq_rank")
    )
    dealt = permuted.join(deal, "_tq_part").select(
        "*",
        F.size(F.filter("_tq_ends", lambda end: end <= F.col("_tq_rank"))).alias("shard"),
        F.pmod(F.xxhash64(F.lit(seed + 1), "_tq_key"), F.lit(blocks)).cast("int").alias("_tq_block"),
    )
    again = Window.partitionBy("shard", "_tq_block").orderBy(
        F.xxhash64(F.lit(seed + 2), "_tq_key"), "_tq_part", "_tq_rank"
    )
    received = stored(
        dealt.withColumn("_tq_place", (F.row_number().over(again) - 1).cast("long")).drop(
            "_tq_part", "_tq_key", "_tq_rank", "_tq_ends"
        ),
        "shards",
    )
    held = received.groupBy("shard", "_tq_block").agg(F.count("*").alias("_tq_rows"))
    full = {row["shard"]: row["n"] for row in held.groupBy("shard").agg(F.sum("_tq_rows").alias("n")).collect()}
    if [full.get(j, 0) for j in range(shards)] != sizes:
        raise RuntimeError("the input partitions changed between two passes; store the table first")
    before = Window.partitionBy("shard").orderBy("_tq_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select(
        "shard", "_tq_block", F.coalesce(F.sum("_tq_rows").over(before), F.lit(0)).alias("_tq_start")
    )
    starts = sent_if_small(starts, shards * blocks, 40)
    return (
        received.join(starts, ["shard", "_tq_block"])
        .withColumn("slot", F.col("_tq_start") + F.col("_tq_place"))
        .drop("_tq_block", "_tq_place", "_tq_start")
    )
