"""Bounded samples of labelled rows, drawn by a hash of the document id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for null."""
    return F.crc32(doc_id.cast("string")) % parts


def at_most(rows: DataFrame, key: str, limit: int, seed: int) -> DataFrame:
    """About ``limit`` rows at most, those with the smallest hashes of ``key``; all rows if there are no more."""
    have = rows.count()
    if have <= limit:
        return rows
    share = int(2**32 * limit / have)
    return rows.filter(F.pmod(F.xxhash64(F.lit(seed), key), F.lit(2**32)) < share)


def labels_of(labels: DataFrame, column: str) -> DataFrame:
    """doc_id and label (0 or 1): one row per document that has one, the larger where several differ."""
    return (
        labels.select("doc_id", F.col(column).cast("int").alias("label"))
        .filter("doc_id IS NOT NULL AND label IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
