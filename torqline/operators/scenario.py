"""Scenario data as table jobs: failure-rate schedules, fault shifts and row resampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from torqline import config as C
from torqline.functions.hashing import hash_fraction, hash_integer


def failure_rate(mode: Column, index: Column, length: Column) -> Column:
    """Failure rate of the reading at zero-based ``index`` in a run of ``length`` readings."""
    base = F.lit(C.BASE_FAILURE_RATE)
    progress = index.cast("double") / F.greatest(length - 1, F.lit(1).cast("long")).cast("double")
    ramp = base + progress * (F.lit(C.RAMP_PEAK_RATE) - base)
    # floor(length / 2) without a division that could turn fractional
    spike = F.when(index >= F.shiftright(length, 1), F.lit(C.SPIKE_RATE)).otherwise(base)
    return F.when(mode == "gradual-drift", ramp).when(mode == "sudden-spike", spike).otherwise(base)


def chosen_for_fault(key: Column, rate: Column, salt: str = "fault") -> Column:
    """True for about ``rate`` of the rows, decided by a hash of the key so reruns agree."""
    return hash_fraction(key, salt) < rate


def fault_shift(df: DataFrame, chosen: Column, key: str = "id", gap: Column | None = None) -> DataFrame:
    """Shift the sensors of chosen rows towards a failure zone.

    A fixed share gets a narrow temperature gap, the others lose speed and gain torque; a row
    never gets both. ``gap`` defaults to the mean gap; pass ``8.2 + 0.3 * randn()`` to spread it.
    """
    gap = F.lit(C.FAULT_GAP_MEAN) if gap is None else gap
    narrow = chosen & (hash_fraction(F.col(key), "hdf") < C.HDF_FRACTION)
    slow = chosen & ~narrow
    air, process = F.col("air_temperature_kelvin"), F.col("process_temperature_kelvin")
    rpm, torque = F.col("rotational_speed_rpm"), F.col("torque_nm")
    return df.withColumns(
        {
            "process_temperature_kelvin": F.when(narrow, air + gap).otherwise(process),
            "rotational_speed_rpm": F.when(
                slow, F.greatest(F.lit(C.FAULT_RPM_FLOOR), rpm + C.FAULT_RPM_SHIFT)
            ).otherwise(rpm),
            "torque_nm": F.when(slow, F.greatest(F.lit(0.0), torque + C.FAULT_TORQUE_ADD)).otherwise(torque),
        }
    )


def round_generated(df: DataFrame) -> DataFrame:
    """Output rounding of generated rows: one decimal, whole rpm and minutes."""
    tenths = ["air_temperature_kelvin", "process_temperature_kelvin", "torque_nm"]
    whole = ["rotational_speed_rpm", "tool_wear_minutes"]
    return df.withColumns(
        {
            **{name: F.bround(F.col(name), 1) for name in tenths},
            **{name: F.bround(F.col(name), 0).cast("int") for name in whole},
        }
    )


def bootstrap(baseline: DataFrame, draws: DataFrame, size: int, index: str, key: str) -> DataFrame:
    """One whole baseline row per draw, with replacement, so joint correlations survive.

    ``baseline`` carries a dense 1-based ``index``; hashed picks spread the equi-join keys
    evenly, so no key is hot whatever the draws look like.
    """
    picked = draws.withColumn(index, hash_integer(F.col(key), "draw") % F.lit(size).cast("long") + 1)
    return picked.join(baseline, index)
