"""Features, labels and the input contract."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from torqline import config as C
from torqline.functions import features, labels, quality

COLUMNS = (
    "machine_type string, air_temperature_kelvin double, process_temperature_kelvin double, "
    "rotational_speed_rpm double, torque_nm double, tool_wear_minutes double, injected_failure int"
)


def flags(spark, *row):
    df = labels.with_failure_flags(spark.createDataFrame([row], COLUMNS))
    result = df.withColumn("failure_type", labels.failure_type()).first()
    return [result[f] for f in ("twf", "hdf", "pwf", "osf", "rnf")], result["failure_type"]


def test_engineered_values(spark):
    raw = spark.createDataFrame(
        [("M", 300.0, 310.0, 1500, 40.0, 100, "kept")],
        "Type string, `Air temperature [K]` double, `Process temperature [K]` double, `Rotational speed [rpm]` int, "
        "`Torque [Nm]` double, `Tool wear [min]` int, other string",
    )
    row = features.engineer_features(raw).first()
    assert row["power_kw"] == pytest.approx(6.28318, abs=1e-12)
    assert row["temp_diff_kelvin"] == 10.0 and row["mechanical_stress"] == 4000.0 and row["other"] == "kept"
    assert set(C.FEATURES) <= set(row.asDict())
    assert raw.columns[0] == "Type"


@pytest.mark.parametrize(
    "row, expected, name",
    [
        (("L", 300.0, 310.0, 1500.0, 40.0, 100.0, 1), [0, 0, 0, 0, 0], "none"),
        (("L", 300.0, 310.0, 1500.0, 40.0, 200.0, 1), [1, 0, 0, 0, 0], "twf"),
        (("M", 300.0, 310.0, 1500.0, 40.0, 219.0, 1), [0, 0, 0, 0, 0], "none"),
        (("X", 300.0, 310.0, 1500.0, 40.0, 239.0, 1), [0, 0, 0, 0, 0], "none"),
        (("X", 300.0, 310.0, 1500.0, 50.0, 230.0, 1), [0, 0, 0, 1, 0], "osf"),
        (("L", 300.0, 308.5, 1379.0, 40.0, 100.0, 1), [0, 1, 0, 0, 0], "hdf"),
        (("L", 300.0, 308.5, 1380.0, 40.0, 100.0, 1), [0, 0, 0, 0, 0], "none"),
        (("L", 300.0, 310.0, 1500.0, 20.0, 100.0, 1), [0, 0, 1, 0, 0], "pwf"),
        (("L", 300.0, 310.0, 1500.0, 60.0, 100.0, 1), [0, 0, 1, 0, 0], "pwf"),
        (("H", 300.0, 310.0, 1400.0, 60.0, 217.0, 1), [0, 0, 0, 1, 0], "osf"),
        (("L", 300.0, 308.0, 1300.0, 70.0, 210.0, 1), [1, 1, 1, 1, 0], "twf"),
        (("L", 300.0, 308.0, 1300.0, 70.0, 210.0, 0), [0, 0, 0, 0, 0], "none"),
    ],
)
def test_flags_and_priority(spark, row, expected, name):
    assert flags(spark, *row) == (expected, name)


def test_flag_counts_of_the_readings_view(spark):
    from torqline.sources import readings as rd

    counted = (
        labels.with_failure_flags(rd.readings(spark, "/root/testdata/sf0.01"))
        .agg(F.sum("injected_failure"), *[F.sum(f) for f in ("twf", "hdf", "pwf", "osf")])
        .first()
    )
    assert tuple(counted) == (735, 132, 64, 686, 242)


def test_encode_decode(spark):
    names = [*C.FAILURE_CLASSES, "rnf", None]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    index = labels.encode_class(F.col("name"))
    rows = {r["name"]: (r["i"], r["back"]) for r in df.select("name", index.alias("i"), labels.decode_class(index).alias("back")).collect()}
    assert [rows[n][0] for n in names] == [0, 1, 2, 3, 4, None, None]
    assert rows["hdf"][1] == "hdf" and rows["none"][1] is None and rows["rnf"][1] is None


VALID = ["M", 300.0, 310.0, 1500.0, 40.0, 100.0]
FIELDS = ["machine_type", *C.SENSORS]


@pytest.mark.parametrize(
    "change, bad",
    [
        ({}, []),
        ({"machine_type": "Q"}, ["machine_type"]),
        ({"machine_type": "LM"}, ["machine_type"]),
        ({"machine_type": None}, ["machine_type"]),
        ({"air_temperature_kelvin": 270.0}, ["air_temperature_kelvin"]),
        ({"process_temperature_kelvin": 320.0}, ["process_temperature_kelvin"]),
        ({"rotational_speed_rpm": 0.0}, ["rotational_speed_rpm"]),
        ({"torque_nm": 0.0}, []),
        ({"torque_nm": 100.0, "tool_wear_minutes": 260.1}, ["torque_nm", "tool_wear_minutes"]),
        ({"tool_wear_minutes": 260.0}, []),
        ({"tool_wear_minutes": float("nan")}, ["tool_wear_minutes"]),
        ({"torque_nm": None}, ["torque_nm"]),
    ],
)
def test_contract(spark, change, bad):
    row = [change.get(name, value) for name, value in zip(FIELDS, VALID)]
    df = spark.createDataFrame([row], COLUMNS.rsplit(",", 1)[0])
    assert quality.valid_readings(df).count() == (0 if bad else 1)
    assert [r["reasons"] for r in quality.quarantine(df).collect()] == ([bad] if bad else [])


def test_incomplete_rows(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),)], "x double")
    assert quality.drop_incomplete(df, ["x"]).count() == 1
