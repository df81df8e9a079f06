"""The readings table: stored form, and the view over an ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from torqline import config as C
from torqline.functions import features, labels
from torqline.functions.hashing import hash_fraction, hash_integer
from torqline.functions.quality import since_filter
from torqline.operators.scenario import failure_rate
from torqline.sources import schemas

_READING_COLUMNS = schemas.READINGS.fieldNames()

_EVENT_EXPRESSIONS = {
    "id": "event_id",
    "timestamp": "ts",
    "reading_number": "event_id + 1",
    "machine_id": "concat('machine_', CAST(user_id AS STRING))",
    "machine_type": "CASE WHEN event_id % 10 < 6 THEN 'L' WHEN event_id % 10 < 9 THEN 'M' ELSE 'H' END",
    "air_temperature_kelvin": "CAST(2953 + (event_id * 7) % 92 AS DOUBLE) / CAST(10 AS DOUBLE)",
    "process_temperature_kelvin": (
        "CAST(3029 + (event_id * 7) % 92 + (event_id * 13) % 45 AS DOUBLE) / CAST(10 AS DOUBLE)"
    ),
    "rotational_speed_rpm": "CAST(2000 - (38 + (event_id * 37) % 729) + (event_id * 11) % 300 AS DOUBLE)",
    "torque_nm": "CAST(38 + (event_id * 37) % 729 AS DOUBLE) / CAST(10 AS DOUBLE)",
    "tool_wear_minutes": "CAST((event_id div 8) % 254 AS DOUBLE)",
    "injected_failure": "CASE WHEN (event_id * 37) % 729 > 682 OR event_id % 97 = 0 THEN 1 ELSE 0 END",
    "mode": "CASE WHEN event_id % 4 = 0 THEN 'sudden-spike' ELSE 'normal' END",
}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(schemas.EVENTS).parquet(f"{sf_dir}/events.parquet")


def readings_from_events(source: DataFrame, readings_in_run: int | None = None) -> DataFrame:
    """Machine readings computed row by row from an ``events`` frame (batch or stream).

    ``timestamp`` keeps the source column untouched so that time filters reach its scan.
    ``readings_in_run`` sets the length of the failure-rate schedule; left out, a scalar
    subquery counts the source (only when the rate column is used).
    """
    if readings_in_run is None:
        length = source.agg(F.count(F.lit(1)).alias("n")).scalar()
    else:
        length = F.lit(readings_in_run).cast("long")
    base = source.select(*[F.expr(text).alias(name) for name, text in _EVENT_EXPRESSIONS.items()])
    scored = base.withColumns(features.derived_features()).withColumn(
        "failure_probability",
        F.least(F.lit(999).cast("long"), (F.col("id") * 31) % 700 + 299 * F.col("injected_failure")) / F.lit(1000.0),
    )
    predicted = scored.withColumn("predicted_failure", (F.col("failure_probability") >= 0.5).cast("int")).withColumn(
        "predicted_failure_type",
        F.when(F.col("predicted_failure") == 1, F.nullif(labels.physics_type(), F.lit("none"))),
    )
    return (
        predicted.withColumn("target", features.target_kind(F.col("predicted_failure_type")))
        .withColumn("effective_failure_rate", failure_rate(F.col("mode"), F.col("reading_number") - 1, length))
        .select(*_READING_COLUMNS)
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_from_events(events(spark, sf_dir))


def load_readings(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """The stored readings table (a Parquet directory), optionally only what came after ``since``."""
    return since_filter(spark.read.schema(schemas.READINGS).parquet(path).select(*_READING_COLUMNS), since)


def stream_readings(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """The stored readings table as a stream."""
    reader = spark.readStream.schema(schemas.READINGS)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path).select(*_READING_COLUMNS)


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.readStream.schema(schemas.EVENTS).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def drift_projection(readings: DataFrame) -> DataFrame:
    """The nine model features as stored; they are read, not computed again."""
    return features.feature_slice(features.with_type_column(readings))


def with_bad_rows(readings: DataFrame) -> DataFrame:
    """Readings with contract violations planted by id, for the validation queries."""
    row_id = F.col("id")
    return readings.withColumns(
        {
            "torque_nm": F.when(row_id % 50 == 0, F.col("torque_nm") + 100.0).otherwise(F.col("torque_nm")),
            "machine_type": F.when(row_id % 70 == 0, F.lit("X")).otherwise(F.col("machine_type")),
            "tool_wear_minutes": F.when(row_id % 90 != 0, F.col("tool_wear_minutes")),
        }
    )


def failure_pattern(source: DataFrame) -> DataFrame:
    """A training table over ``events`` in which every failure class is present and learnable.

    A hash of the event picks the class of a row, further hashes draw its sensors: from the safe region, or from
    the zone in which only that class's rule applies (worn tool, weak cooling at low speed, too much power, strain
    on a worn tool).
    """
    key = F.col("event_id")
    kind = (hash_integer(key, "class") % 5).cast("int")
    names = ["none", "twf", "hdf", "pwf", "osf"]
    variant = F.element_at(F.array(*map(F.lit, "LMH")), (hash_integer(key, "variant") % 3 + 1).cast("int"))

    def drawn(sensor: str, safe: tuple[float, float], **zones: tuple[float, float]):
        """A draw between two bounds, which depend on the class."""
        low, high = F.lit(safe[0]), F.lit(safe[1])
        for name, zone in zones.items():
            low = F.when(kind == names.index(name), F.lit(zone[0])).otherwise(low)
            high = F.when(kind == names.index(name), F.lit(zone[1])).otherwise(high)
        return low + hash_fraction(key, sensor) * (high - low)

    limit = F.lit(C.WEAR_DEFAULT)
    for name, wear in C.WEAR_LIMITS.items():
        limit = F.when(variant == name, F.lit(wear)).otherwise(limit)
    air = drawn("air", (296.0, 304.0))
    gap = drawn("gap", (9.4, 11.8), hdf=(7.4, C.HDF_MAX_GAP - 0.2))
    speed = drawn("speed", (1420.0, 1750.0), hdf=(1280.0, C.HDF_MAX_RPM - 5.0), pwf=(1600.0, 1900.0), osf=(1150.0, 1220.0))
    torque = drawn("torque", (32.0, 46.0), pwf=(60.0, 72.0), osf=(68.0, 70.0))
    worn = limit + drawn("wear", (1.0, 15.0))
    wear = F.when(kind == names.index("twf"), worn).otherwise(drawn("wear", (5.0, 150.0), osf=(192.0, 199.0)))
    layout = {
        "UDI": key + 1,
        "Product ID": features.product_id(variant, key),
        "Type": variant,
        "Air temperature [K]": F.bround(air, 1),
        "Process temperature [K]": F.bround(air + gap, 1),
        "Rotational speed [rpm]": speed.cast("int"),
        "Torque [Nm]": F.bround(torque, 1),
        "Tool wear [min]": wear.cast("int"),
        "Machine failure": (kind != 0).cast("int"),
        **{name.upper(): (kind == number).cast("int") for number, name in enumerate(names) if number},
        "RNF": F.lit(0),
    }
    return source.select(*[column.alias(name) for name, column in layout.items()])
