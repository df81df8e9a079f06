"""Feature engineering and column contracts (one function shared by training, drift and scoring)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from torqline import config as C

SNAKE_TO_AI4I = {snake: original for original, snake in C.AI4I_TO_SNAKE.items()}
SNAKE_TO_AI4I["machine_type"] = SNAKE_TO_AI4I.pop("type")


def watts(torque: Column, rpm: Column) -> Column:
    """Mechanical power; the operand order fixes the last bits of the result."""
    return torque * rpm * F.lit(2.0) * F.lit(C.PI) / F.lit(60.0)


def derived_features(torque="torque_nm", rpm="rotational_speed_rpm", wear="tool_wear_minutes") -> dict[str, Column]:
    return {
        "power_kw": watts(F.col(torque), F.col(rpm)) / F.lit(1000.0),
        "temp_diff_kelvin": F.col("process_temperature_kelvin") - F.col("air_temperature_kelvin"),
        "mechanical_stress": F.col(torque) * F.col(wear),
    }


def to_snake_names(df: DataFrame) -> DataFrame:
    """AI4I names to snake_case; absent names are skipped and other columns pass through."""
    return df.withColumnsRenamed(C.AI4I_TO_SNAKE)


def to_ai4i_names(df: DataFrame) -> DataFrame:
    """Request names to AI4I names."""
    return df.withColumnsRenamed(SNAKE_TO_AI4I)


def to_request_names(df: DataFrame) -> DataFrame:
    """AI4I names to request names, where the variant is called ``machine_type``."""
    return df.withColumnsRenamed({original: snake for snake, original in SNAKE_TO_AI4I.items()})


def engineer_features(df: DataFrame) -> DataFrame:
    """Rename to the snake_case contract and add the three derived features."""
    return to_snake_names(df).withColumns(derived_features())


def feature_slice(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(*C.FEATURES, *extra)


def with_type_column(df: DataFrame) -> DataFrame:
    """Readings store the variant as ``machine_type``; the feature contract calls it ``type``."""
    return df.withColumnRenamed("machine_type", "type")


def target_kind(failure_type: Column) -> Column:
    return F.when(failure_type.isNull(), F.lit("binary")).otherwise(F.lit("multiclass"))


def product_id(machine_type: Column, position: Column) -> Column:
    """Variant letter followed by 20000 + 1-based position in the batch, at least five digits."""
    return F.format_string("%s%05d", machine_type, position + F.lit(C.PRODUCT_BASE))


def round_half_even(value: Column, digits: int) -> Column:
    return F.bround(value, digits)
