"""Running tool state per machine, kept by the stream.

A micro-batch becomes pieces, one row per machine and id chunk, not one per machine alone: a machine that sends a large
part of all readings spreads over many pieces. Pieces are stitched when the state is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import WindowSpec

from torqline.sources.sinks import write_batch

CHUNK_IDS = 1 << 16


def _fell(now: str, before: WindowSpec) -> Column:
    """1 where wear is below that of the row before, 0 also where either is missing."""
    return F.coalesce((F.col(now) < F.lag("last_wear").over(before)).cast("long"), F.lit(0).cast("long"))


def tool_pieces(readings: DataFrame, chunk_ids: int = CHUNK_IDS) -> DataFrame:
    """Tool changes inside each chunk of a machine's readings, and the wear at both of its ends.

    A window meets at most the ids of one chunk, so sorting it is bounded. The shuffle for the windows serves the sums too.
    """
    wear = F.nanvl(F.col("tool_wear_minutes"), F.lit(None).cast("double")).alias("last_wear")
    keyed = readings.select("machine_id", F.expr(f"id div {chunk_ids}").alias("chunk"), "id", wear)
    inside = Window.partitionBy("machine_id", "chunk").orderBy("id")
    ends = F.struct("id", "last_wear")
    pieces = (
        keyed.withColumn("reset", _fell("last_wear", inside))
        .groupBy("machine_id", "chunk")
        .agg(
            F.min(ends).alias("first"),
            F.max(ends).alias("last"),
            F.sum("reset").alias("resets"),
            F.count(F.lit(1)).alias("readings"),
        )
    )
    return pieces.select(
        "machine_id",
        "chunk",
        F.col("first.last_wear").alias("first_wear"),
        F.col("last.last_wear").alias("last_wear"),
        F.col("last.id").alias("last_id"),
        "resets",
        "readings",
    )


def start_tool_state(
    stream: DataFrame, output: str, checkpoint: str, chunk_ids: int = CHUNK_IDS, trigger: dict | None = None
) -> StreamingQuery:
    """Write the pieces of each micro-batch under its number.

    Readings of a chunk must arrive in id order between micro-batches, in any order within one.
    """
    needed = stream.select("machine_id", "id", "tool_wear_minutes")

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch(tool_pieces(batch, chunk_ids), output, batch_id, "batch_id")

    writer = needed.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def current_tools(spark: SparkSession, output: str) -> DataFrame:
    """Tool changes so far, current wear and readings of every machine."""
    across = Window.partitionBy("machine_id").orderBy("chunk", "batch_id")
    return (
        spark.read.parquet(output)
        .withColumn("changed", _fell("first_wear", across))
        .groupBy("machine_id")
        .agg(
            F.sum(F.col("resets") + F.col("changed")).alias("tool_changes"),
            F.max_by("last_wear", "last_id").alias("current_wear"),
            F.sum("readings").alias("readings"),
        )
    )
