"""Sinks: append-only tables, versioned rewrites, audit and report output."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from torqline.sources import schemas


def utc_now() -> str:
    return datetime.now(timezone.utc).isoformat()


def insert_readings(df: DataFrame, path: str) -> None:
    """Append scored readings by column name."""
    df.select(*schemas.READINGS.fieldNames()).write.mode("append").parquet(path)


def append_training(df: DataFrame, path: str) -> None:
    """Add a batch to the training table; existing files are neither read nor rewritten."""
    df.select(*schemas.TRAINING.fieldNames()).write.mode("append").parquet(path)


def write_training(df: DataFrame, path: str) -> None:
    """Start a training table (or a separate file set) with this batch."""
    df.select(*schemas.TRAINING.fieldNames()).write.mode("overwrite").parquet(path)


def write_batch(
    df: DataFrame, path: str, batch_id: int, column: str = "export_batch", fresh: bool = False
) -> None:
    """Write one numbered batch so that writing it again replaces it; ``fresh`` drops all other batches.

    The batch is a partition folder of its own that is overwritten as a whole: rewritten without rows, it has none.
    """
    if fresh:
        numbered = df.withColumn(column, F.lit(batch_id).cast("long")).write.mode("overwrite")
        numbered.option("partitionOverwriteMode", "static").partitionBy(column).parquet(path)
    else:
        df.drop(column).write.mode("overwrite").parquet(f"{path}/{column}={batch_id}")


def append_audit(
    spark: SparkSession, path: str, batch_id: int, drift_detected: bool, retrain_triggered: bool, error: str | None = None
) -> None:
    """One JSON line per drift check, under its number: a replayed check replaces its own line."""
    line = [(utc_now(), drift_detected, retrain_triggered, error)]
    spark.createDataFrame(line, schemas.AUDIT_LOG).coalesce(1).write.mode("overwrite").json(f"{path}/check={batch_id}")


def note_export(spark: SparkSession, path: str, batch_id: int, first_check: int, done: bool) -> None:
    """What the export of a check covers, under its number; said before its rows are written and again after."""
    line = spark.createDataFrame([(first_check, done)], schemas.EXPORTS)
    line.coalesce(1).write.mode("overwrite").json(f"{path}/check={batch_id}")


def request_retrain(spark: SparkSession, path: str, batch_id: int) -> None:
    """One line per request, under the number of its check."""
    line = spark.createDataFrame([(utc_now(), batch_id)], schemas.RETRAIN_REQUESTS)
    line.coalesce(1).write.mode("overwrite").json(f"{path}/check={batch_id}")


def write_drift_report(parts: dict[str, DataFrame], path: str) -> None:
    """The data behind a drift dashboard, one Parquet table per part."""
    for name, frame in parts.items():
        frame.write.mode("overwrite").parquet(f"{path}/{name}")
