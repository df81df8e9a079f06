"""Rule-based failure labels as column expressions (no UDF, no join needed for three limits)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from torqline import config as C
from torqline.functions.features import watts


def limit_for(machine_type: Column, limits: dict[str, float], default: float) -> Column:
    """Per-variant limit with a default for variants outside the table."""
    branches = F
    for variant, limit in limits.items():
        branches = branches.when(machine_type == variant, F.lit(limit))
    return branches.otherwise(F.lit(default))


def physics_conditions(
    machine_type: str = "machine_type",
) -> dict[str, Column]:
    """The four rules on the unrounded reading, before any gate."""
    variant, rpm, torque, wear = (
        F.col(machine_type),
        F.col("rotational_speed_rpm"),
        F.col("torque_nm"),
        F.col("tool_wear_minutes"),
    )
    gap = F.col("process_temperature_kelvin") - F.col("air_temperature_kelvin")
    power = watts(torque, rpm)
    return {
        "twf": wear >= limit_for(variant, C.WEAR_LIMITS, C.WEAR_DEFAULT),
        "hdf": (rpm < C.HDF_MAX_RPM) & (gap < C.HDF_MAX_GAP),
        "pwf": (power < C.PWF_MIN_WATTS) | (power > C.PWF_MAX_WATTS),
        "osf": torque * wear > limit_for(variant, C.OSF_LIMITS, C.OSF_DEFAULT),
    }


def failure_flags(gate: Column, machine_type: str = "machine_type") -> dict[str, Column]:
    """Flags 0/1, all 0 where ``gate`` is false; random failures carry no signature."""
    flags = {
        name: F.when(gate & condition, F.lit(1)).otherwise(F.lit(0))
        for name, condition in physics_conditions(machine_type).items()
    }
    flags["rnf"] = F.lit(0)
    return flags


def with_failure_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(failure_flags(F.col("injected_failure") != 0))


def failure_type() -> Column:
    """First active flag in priority order, else ``none``; rnf is ignored."""
    return F.coalesce(*[F.when(F.col(name) == 1, F.lit(name)) for name in C.FLAG_PRIORITY], F.lit("none"))


def physics_type(machine_type: str = "machine_type") -> Column:
    """First rule that fires on the sensors alone, else ``none``."""
    conditions = physics_conditions(machine_type)
    return F.coalesce(*[F.when(conditions[name], F.lit(name)) for name in C.FLAG_PRIORITY], F.lit("none"))


def encode_class(name: Column) -> Column:
    """Class name to index; null for a name outside the class list."""
    position = F.array_position(F.array(*[F.lit(c) for c in C.FAILURE_CLASSES]), name)
    return F.when(position > 0, (position - 1).cast("int"))


def decode_class(index: Column) -> Column:
    """Class index to name, with ``none`` reported as null."""
    names = F.array(*[F.lit(c) for c in C.FAILURE_CLASSES])
    return F.nullif(F.try_element_at(names, index.cast("int") + 1), F.lit("none"))
