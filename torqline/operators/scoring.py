"""Gate-and-detail scoring and what is derived from its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from torqline import config as C
from torqline.functions.labels import decode_class

Scorer = Callable[[DataFrame], DataFrame]


def gate_and_detail(df: DataFrame, gate: Scorer, detail: Scorer | None) -> DataFrame:
    """Score with the binary gate and name the failure type of the positives, in one pass over ``df``.

    ``gate`` adds ``machine_failure`` (0/1) and ``failure_probability``; ``detail`` adds
    ``class_index`` and must look at each row by itself: its answer counts where the gate says 1. Without a
    detail model, or when it answers "none", the type stays null and the binary result stands.
    """
    gated = gate(df)
    if detail is None:
        return gated.withColumn("failure_type", F.lit(None).cast("string"))
    kind = F.when(F.col("machine_failure") == 1, decode_class(F.col("class_index")))
    return detail(gated).withColumn("failure_type", kind).drop("class_index")


def response(scored: DataFrame, *keys: str, model_name: str = C.BINARY_MODEL, version: str | None = None) -> DataFrame:
    """The columns a caller gets back, probability rounded to four decimals."""
    return scored.select(
        *keys,
        "machine_failure",
        F.bround("failure_probability", 4).alias("failure_probability"),
        "failure_type",
        F.lit(model_name).alias("model_name"),
        F.lit(version).cast("string").alias("model_version"),
    )


def explode_batches(requests: DataFrame, request_id: str = "request_id") -> DataFrame:
    """One row per reading of an array request, with its position; empty requests give no row."""
    exploded = requests.select(request_id, F.posexplode("readings").alias("position", "reading"))
    return exploded.select(request_id, "position", "reading.*")


def batch_totals(responses: DataFrame, request_id: str = "request_id") -> DataFrame:
    return responses.groupBy(request_id).agg(
        F.count(F.lit(1)).alias("total_readings"),
        F.sum("machine_failure").cast("long").alias("total_failures_predicted"),
    )


def alert_level(probability: Column, high: float = C.ALERT_HIGH, low: float = C.ALERT_LOW) -> Column:
    return (
        F.when(probability >= high, F.lit("shutdown"))
        .when(probability >= low, F.lit("inspect"))
        .when(probability.isNotNull(), F.lit("ok"))
    )
