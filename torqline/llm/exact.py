"""Exact deduplication by a tree-merge of sorted digest runs (DataFrame functions only).

Every input partition becomes a run: its distinct digests in order, each with the row to retain and a count.
Runs then meet in rounds. In each, ``fan_in`` neighbouring runs are merged, spread over tasks by digest, and
every digest keeps one entry. The result flows back down the same tree, so that a text which a third of all
rows share is met as ``fan_in`` entries at most anywhere but in the partitions that read it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from torqline.llm.common import lower_ascii, stored

FAN_IN = 16
# Entries are sorted by the short digest and merged only where SHA-256 and length agree too.
_ENTRY = ["digest", "sha", "n_bytes"]


def _digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = lower_ascii(F.coalesce(F.col(text_col), F.lit("")))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.spark_partition_id().alias("run"),
        F.monotonically_increasing_id().alias("row"),
        text.alias("norm"),
    ).select(
        "doc_id",
        "run",
        "row",
        F.xxhash64("norm").alias("digest"),
        F.unhex(F.sha2("norm", 256)).alias("sha"),
        F.octet_length("norm").cast("long").alias("n_bytes"),
    )


def _merged(entries: DataFrame) -> DataFrame:
    """One entry per run and digest, with the largest (id, row) and the number of rows behind it."""
    return entries.groupBy(*_ENTRY, "run").agg(F.max("best").alias("best"), F.sum("size").alias("size"))


def digest_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = FAN_IN
) -> DataFrame:
    """One row per document: doc_id, row, sha, n_bytes, keep_id, keep_row, group_size, kept.

    Texts are equal when their bytes are, after lower-casing A-Z; null counts as empty. Of equal texts the row with
    the largest id is kept; null ids come last, and of rows with the same id the one read last is kept, so exactly
    one row of each group has ``kept``. An empty table gives an empty result. Other columns are not read.
    ``row`` numbers the rows of this pass.
    """
    leaves = stored(_digests(docs, id_col, text_col), "digests")
    last = leaves.agg(F.max("run")).first()[0]
    first = leaves.select(
        *_ENTRY, "run", F.struct("doc_id", "row").alias("best"), F.lit(1).cast("long").alias("size")
    )
    levels = [stored(_merged(first).sortWithinPartitions("digest"), "run")]
    width = (last or 0) + 1
    while width > 1:
        below = levels[-1].withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
        levels.append(stored(_merged(below).sortWithinPartitions("digest"), "run"))
        width = -(-width // fan_in)
    known = levels[-1]
    for level in reversed(levels[:-1]):
        above = known.select(*_ENTRY, F.col("run").alias("up"), "best", "size")
        known = (
            level.select(*_ENTRY, "run", F.floor(F.col("run") / fan_in).cast("int").alias("up"))
            .join(above, [*_ENTRY, "up"])
            .drop("up")
        )
    return leaves.join(known, [*_ENTRY, "run"]).select(
        "doc_id",
        "row",
        "sha",
        "n_bytes",
        F.col("best.doc_id").alias("keep_id"),
        F.col("best.row").alias("keep_row"),
        F.col("size").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"),
    )


def without_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = FAN_IN
) -> DataFrame:
    """The rows of ``docs``, all columns, of which :func:`digest_groups` keeps one per group of equal texts.

    Rows are found again by id, SHA-256 and length. Where an id occurs twice with the same text, one of those
    rows stays.
    """
    names = [F.col(f"`{c}`") for c in docs.columns]
    groups = digest_groups(docs, id_col, text_col, fan_in)
    keepers = stored(
        groups.withColumn("same", (F.col("doc_id").eqNullSafe(F.col("keep_id"))).cast("int"))
        .groupBy("sha", "n_bytes", "keep_id", "same")
        .agg(F.count("*").alias("twins"))
        .filter("same = 1")
        .select(
            F.col("sha").alias("_tq_sha"),
            F.col("n_bytes").alias("_tq_bytes"),
            F.col("keep_id").alias("_tq_id"),
            F.col("twins").alias("_tq_twins"),
        ),
        "keepers",
    )
    text = lower_ascii(F.coalesce(F.col(text_col), F.lit("")))
    marked = docs.withColumn("_tq_norm", text).select(
        *names,
        F.unhex(F.sha2("_tq_norm", 256)).alias("_tq_own_sha"),
        F.octet_length("_tq_norm").cast("long").alias("_tq_own_bytes"),
    )
    found = marked.join(
        keepers,
        F.col(id_col).eqNullSafe(F.col("_tq_id"))
        & (F.col("_tq_own_sha") == F.col("_tq_sha"))
        & (F.col("_tq_own_bytes") == F.col("_tq_bytes")),
    )
    single = found.filter("_tq_twins = 1").select(*names)
    if keepers.filter("_tq_twins > 1").isEmpty():
        return single
    double = found.filter("_tq_twins > 1").dropDuplicates(["_tq_id", "_tq_sha", "_tq_bytes"])
    return single.unionByName(double.select(*names))
