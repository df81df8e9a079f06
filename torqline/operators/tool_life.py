"""Tool-life cycles: wear grows per machine and drops when the tool is replaced.

A machine may own a large part of all rows, so its history is cut along the id axis. Each
piece finds its own resets; the pieces are stitched with one row per machine and range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from torqline.operators.prefix import range_cuts, with_range


def tool_life_cycles(readings: DataFrame, ranges: int | None = None) -> DataFrame:
    """One row per machine and tool: wear range, readings, time span and failures."""
    needed = readings.select("id", "machine_id", "timestamp", "tool_wear_minutes", "injected_failure")
    ranged = with_range(needed, "id", range_cuts(needed, ["id"], ranges)["id"], "range")

    inside = Window.partitionBy("machine_id", "range").orderBy("id")
    wear = F.col("tool_wear_minutes")
    reset = F.coalesce((wear < F.lag(wear).over(inside)).cast("long"), F.lit(0).cast("long"))
    marked = ranged.withColumn("reset", reset).withColumn(
        "local_cycle", F.sum("reset").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    pieces = marked.groupBy("machine_id", "range", "local_cycle").agg(
        F.min("tool_wear_minutes").alias("min_wear"),
        F.max("tool_wear_minutes").alias("max_wear"),
        F.count(F.lit(1)).alias("readings"),
        F.sum("injected_failure").cast("long").alias("failures"),
        F.min("timestamp").alias("first_seen"),
        F.max("timestamp").alias("last_seen"),
        F.min("id").alias("first_id"),
        F.min_by("tool_wear_minutes", "id").alias("first_wear"),
        F.max_by("tool_wear_minutes", "id").alias("last_wear"),
    )
    offsets = stitch_offsets(pieces)
    return (
        pieces.join(offsets, ["machine_id", "range"])
        .withColumn("cycle", F.col("cycles_before") + F.col("local_cycle"))
        .groupBy("machine_id", "cycle")
        .agg(
            F.min("min_wear").alias("min_wear"),
            F.max("max_wear").alias("max_wear"),
            F.sum("readings").alias("readings"),
            F.sum("failures").alias("failures"),
            F.min("first_seen").alias("first_seen"),
            F.max("last_seen").alias("last_seen"),
        )
    )


def stitch_offsets(pieces: DataFrame) -> DataFrame:
    """Cycles a machine went through before each of its ranges (cycle numbers start at 0)."""
    per_range = pieces.groupBy("machine_id", "range").agg(
        F.max("local_cycle").alias("resets"),
        F.min_by("first_wear", "first_id").alias("first_wear"),
        F.max_by("last_wear", "first_id").alias("last_wear"),
    )
    across = Window.partitionBy("machine_id").orderBy("range")
    changed = F.coalesce((F.col("first_wear") < F.lag("last_wear").over(across)).cast("long"), F.lit(0).cast("long"))
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    upto = across.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        per_range.withColumn("changed", changed)
        .withColumn(
            "cycles_before",
            F.coalesce(F.sum("resets").over(before), F.lit(0).cast("long")) + F.sum("changed").over(upto),
        )
        .select("machine_id", "range", "cycles_before")
    )
