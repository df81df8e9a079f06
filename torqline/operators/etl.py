"""Readings to training rows: numbering, relabelling, appending and purging."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from torqline import config as C
from torqline.functions.features import product_id, round_half_even
from torqline.functions.labels import with_failure_flags
from torqline.operators.prefix import dense_sequence
from torqline.sources import schemas

_FLAG_COLUMNS = ["TWF", "HDF", "PWF", "OSF", "RNF"]


def next_udi(training: DataFrame) -> DataFrame:
    """Existing rows, last key and the key the next batch starts with (1 for an empty table)."""
    last = F.max("UDI")
    return training.agg(
        F.count(F.lit(1)).alias("existing_rows"),
        last.alias("last_udi"),
        (F.coalesce(last, F.lit(0).cast("long")) + 1).alias("starting_udi"),
    )


def export_layout(
    readings: DataFrame, starting_udi: int = 1, ranges: int | None = None, keep_id: bool = False
) -> DataFrame:
    """Readings in the training layout, numbered in id order after the rows that exist.

    Flags come from the unrounded sensors. Product IDs count from 1 in each batch, so they
    repeat between batches; ``UDI`` is the key. ``keep_id`` adds ``reading_id``, which lets one
    write both store a row and record that its reading was exported.
    """
    needed = readings.select("id", "machine_type", *C.SENSORS, "injected_failure")
    numbered = with_failure_flags(dense_sequence(needed, "id", "position", 1, ranges))
    layout = {
        "UDI": F.col("position") + F.lit(starting_udi - 1).cast("long"),
        "Product ID": product_id(F.col("machine_type"), F.col("position")),
        "Type": F.col("machine_type"),
        "Air temperature [K]": round_half_even(F.col("air_temperature_kelvin"), 1),
        "Process temperature [K]": round_half_even(F.col("process_temperature_kelvin"), 1),
        "Rotational speed [rpm]": F.col("rotational_speed_rpm").cast("int"),
        "Torque [Nm]": round_half_even(F.col("torque_nm"), 1),
        "Tool wear [min]": F.col("tool_wear_minutes").cast("int"),
        "Machine failure": F.col("injected_failure").cast("int"),
        **{flag: F.col(flag.lower()) for flag in _FLAG_COLUMNS},
    }
    kept = [F.col("id").alias("reading_id")] if keep_id else []
    return numbered.select(*[column.alias(name) for name, column in layout.items()], *kept)


def export_summary(export: DataFrame) -> DataFrame:
    """Counts, shares and key range of a batch in one pass; shares of an empty batch are null."""
    rows = F.count(F.lit(1))
    flags = [flag for flag in _FLAG_COLUMNS if flag != "RNF"]
    return export.agg(
        rows.alias("rows"),
        F.avg("Machine failure").alias("failure_rate"),
        *[F.sum(flag).alias(f"{flag.lower()}_count") for flag in flags],
        *[(F.sum(flag) / F.nullif(rows, F.lit(0))).alias(f"{flag.lower()}_share") for flag in flags],
        F.min("UDI").alias("first_udi"),
        F.max("UDI").alias("last_udi"),
    )


def export_preview(export: DataFrame, rows: int = 3) -> DataFrame:
    return export.orderBy("UDI").limit(rows)


def append_union(existing: DataFrame, batch: DataFrame) -> DataFrame:
    return existing.unionByName(batch.select(*schemas.TRAINING.fieldNames()))


def surviving_readings(readings: DataFrame, exported_ids: DataFrame) -> DataFrame:
    """Readings that were not exported.

    Only the exact exported ids go, so rows written while an export ran stay.
    """
    return readings.join(exported_ids.select("id"), "id", "left_anti")


def purge_exported(readings: DataFrame, exported_ids: DataFrame, new_path: str) -> int:
    """Write the surviving readings as a new table version and return how many rows went.

    The version being read is never overwritten; readers move to ``new_path`` once this
    returns. Run it while no writer is appending to the old version. Both versions are counted afterwards, which reads
    no column. An ``Observation`` would count during the write, but a session that has had one can no longer send models
    with a training summary to its tasks.
    """
    surviving_readings(readings, exported_ids).write.mode("errorifexists").parquet(new_path)
    return readings.count() - readings.sparkSession.read.schema(readings.schema).parquet(new_path).count()


_BINS = 1024


def _axis(df: DataFrame, key: str) -> tuple[Column, Callable[[int], Column]] | None:
    """``key`` as a whole number, and back; None for types that have no such form."""
    kind = df.schema[key].dataType.typeName()
    if kind in ("byte", "short", "integer", "long"):
        return F.col(key).cast("long"), F.lit
    if kind == "timestamp":
        return F.unix_micros(F.col(key)), lambda at: F.timestamp_micros(F.lit(at))
    if kind == "timestamp_ntz":
        # The wall clock read as UTC, whatever the zone of the session.
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        micros = F.timestamp_diff("MICROSECOND", epoch, F.col(key))
        return micros, lambda at: epoch + F.make_dt_interval(secs=F.lit(Decimal(at).scaleb(-6)))
    return None


def newest_cut(df: DataFrame, rows: int, key: str) -> Column | None:
    """A filter on ``key`` that the last ``rows`` rows pass and, ties apart, not many more; None if all rows are needed.

    Exact selection by histograms: the first one has bins that widen with the distance from the largest key, a
    sixteenth of an octave each, so that it is fine where the newest rows lie, at any size. As long as the bin that
    the cut falls into holds more than ``rows`` rows, it is counted again in equal bins, reading its own range only.
    Cuts are keys that occur, so every count is exact.
    """
    form = _axis(df, key)
    if form is None:
        return None
    axis, back = form
    keys = df.select(F.col(key), axis.alias("axis"))
    found = keys.agg(F.count("axis").alias("n"), F.max("axis").alias("high")).first()
    if found["n"] <= rows:
        return None
    bins = F.floor(16 * F.log2(F.lit(found["high"]).cast("double") - F.col("axis") + 1))
    above, part = 0, keys.where("axis IS NOT NULL")
    while True:
        counted = part.groupBy(bins.alias("bin")).agg(
            F.count(F.lit(1)).alias("n"), F.min("axis").alias("low"), F.max("axis").alias("high")
        )
        for chosen in sorted(counted.collect(), key=lambda b: -b["high"]):  # some 1,024 bins
            if above + chosen["n"] >= rows:
                break
            above += chosen["n"]
        if chosen["n"] <= rows or chosen["low"] == chosen["high"]:
            return F.col(key) >= back(chosen["low"])
        part = part.where((F.col(key) >= back(chosen["low"])) & (F.col(key) <= back(chosen["high"])))
        width = max(1, -(-(chosen["high"] - chosen["low"] + 1) // _BINS))
        bins = F.floor((F.lit(chosen["high"]) - F.col("axis")) / F.lit(width))


def newest_rows(df: DataFrame, rows: int, key: str, *ties: str) -> DataFrame:
    """The last ``rows`` rows in the order of ``key`` and ``ties``.

    A top-k alone keeps ``rows`` rows of every input partition. So ``newest_cut`` goes first: it reads ``key`` only,
    as a filter it reaches the scan, and the top-k meets little more than the rows asked for.
    """
    cut = newest_cut(df, rows, key)
    newest = df if cut is None else df.where(cut)
    return newest.orderBy(*[F.desc(name) for name in (key, *ties)]).limit(rows)


def training_window(training: DataFrame, rows: int = C.TRAINING_WINDOW) -> DataFrame:
    """The newest training rows; the key order is the append order."""
    return newest_rows(training, rows, "UDI")


def newest_readings(readings: DataFrame, rows: int = C.CURRENT_ROWS) -> DataFrame:
    """The newest readings by time, ties broken by id."""
    return newest_rows(readings, rows, "timestamp", "id")
