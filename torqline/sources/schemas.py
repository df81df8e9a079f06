"""Declared schemas: nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


_LONG, _INT, _DOUBLE, _STR = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()

TRAINING = _struct(
    ("UDI", _LONG, False),
    ("Product ID", _STR, False),
    ("Type", _STR, False),
    ("Air temperature [K]", _DOUBLE, True),
    ("Process temperature [K]", _DOUBLE, True),
    ("Rotational speed [rpm]", _INT, True),
    ("Torque [Nm]", _DOUBLE, True),
    ("Tool wear [min]", _INT, True),
    ("Machine failure", _INT, False),
    ("TWF", _INT, False),
    ("HDF", _INT, False),
    ("PWF", _INT, False),
    ("OSF", _INT, False),
    ("RNF", _INT, False),
)

READINGS = _struct(
    ("id", _LONG, False),
    ("timestamp", T.TimestampType(), False),
    ("reading_number", _LONG, False),
    ("machine_id", _STR, False),
    ("machine_type", _STR, False),
    ("air_temperature_kelvin", _DOUBLE, False),
    ("process_temperature_kelvin", _DOUBLE, False),
    ("rotational_speed_rpm", _DOUBLE, False),
    ("torque_nm", _DOUBLE, False),
    ("tool_wear_minutes", _DOUBLE, False),
    ("power_kw", _DOUBLE, False),
    ("temp_diff_kelvin", _DOUBLE, False),
    ("mechanical_stress", _DOUBLE, False),
    ("predicted_failure", _INT, False),
    ("predicted_failure_type", _STR, True),
    ("failure_probability", _DOUBLE, False),
    ("injected_failure", _INT, False),
    ("mode", _STR, False),
    ("target", _STR, False),
    ("effective_failure_rate", _DOUBLE, False),
)

REQUEST = _struct(
    ("machine_type", _STR, True),
    ("air_temperature_kelvin", _DOUBLE, True),
    ("process_temperature_kelvin", _DOUBLE, True),
    ("rotational_speed_rpm", _DOUBLE, True),
    ("torque_nm", _DOUBLE, True),
    ("tool_wear_minutes", _DOUBLE, True),
)
BATCH_REQUEST = _struct(("request_id", _LONG, False), ("readings", T.ArrayType(REQUEST), False))

EVENTS = _struct(
    ("event_id", _LONG, True),
    ("ts", T.TimestampNTZType(), True),
    ("user_id", _LONG, True),
    ("event_type", _STR, True),
    ("value", _DOUBLE, True),
    ("props", _STR, True),
)

RUNS = T.StructType(
    [
        T.StructField("run_id", _STR, False),
        T.StructField("experiment", _STR, False),
        T.StructField("tags", T.MapType(_STR, _STR), False),
        T.StructField("params", T.MapType(_STR, _STR), False),
        T.StructField("metrics", T.MapType(_STR, _DOUBLE), False),
    ]
)
MODEL_VERSIONS = _struct(("model", _STR, False), ("version", _STR, False), ("run_id", _STR, True), ("path", _STR, True))
ALIASES = _struct(("model", _STR, False), ("alias", _STR, False), ("version", _STR, False))
AUDIT_LOG = _struct(
    ("timestamp", _STR, False),
    ("drift_detected", T.BooleanType(), False),
    ("retrain_triggered", T.BooleanType(), False),
    ("error", _STR, True),
)
# One export of a drift check: the first check whose readings it took, and whether it is complete.
EXPORTS = _struct(("first_check", _LONG, False), ("done", T.BooleanType(), False))
RETRAIN_REQUESTS = _struct(("timestamp", _STR, False), ("batch_id", _LONG, False))
