"""What the operators share: reading tables, durable cuts of the lineage, size-checked broadcasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from torqline.session import scratch_path

# A side of a join is sent to every executor only when its rows, counted first, stay below this.
BROADCAST_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXT_BATCH = 1000  # rows in an Arrow batch of whole texts


def stored(df: DataFrame, label: str, batch_rows: int | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read from there.

    What was drawn, numbered or hashed in ``df`` stays as it is when an executor is lost later, and nothing
    above is computed twice. ``batch_rows`` sets the Arrow batches of this write only.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(_BATCH_ROWS)
    spark.conf.set(_BATCH_ROWS, str(batch_rows or before))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_BATCH_ROWS, before)
    return spark.read.schema(df.schema).parquet(path)


def sent_if_small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted size allows; else Spark joins it by shuffle or its own choice."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without columns of these names, in any case: results replace input columns of the same name."""
    gone = {name.lower() for name in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is; null stays null."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    mapped = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(ascii_only, F.lower(text)).otherwise(mapped)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
