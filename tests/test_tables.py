"""ETL, tool life, promotion and scoring on small fixtures."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from torqline import config as C
from torqline.operators import etl, registry, scoring, tool_life
from torqline.session import scratch_path
from torqline.sources import readings as rd
from torqline.sources import sinks, tables


def test_two_exports_give_dense_unique_keys(spark, readings):
    path = scratch_path(spark, "training")
    sinks.write_training(etl.export_layout(readings.where("id < 400"), ranges=5), path)
    start = etl.next_udi(tables.load_training_table(spark, path)).first()["starting_udi"]
    sinks.append_training(etl.export_layout(readings.where("id >= 400"), start, ranges=3), path)
    table = tables.load_training_table(spark, path)
    stats = table.agg(F.count("UDI"), F.countDistinct("UDI"), F.min("UDI"), F.max("UDI")).first()
    n = readings.count()
    assert start == 401 and tuple(stats) == (n, n, 1, n)
    assert table.where("UDI = 401").first()["Product ID"].endswith("20001")


def test_empty_table_starts_at_one(spark):
    from torqline.sources import schemas

    row = etl.next_udi(spark.createDataFrame([], schemas.TRAINING)).first()
    assert tuple(row) == (0, None, 1)


def test_empty_export_has_null_shares(spark, readings):
    row = etl.export_summary(etl.export_layout(readings.where("id < 0"))).first()
    assert row["rows"] == 0 and row["twf_share"] is None


def test_purge_keeps_everything_else(spark, readings):
    path = scratch_path(spark, "purged")
    gone = readings.where("id % 3 = 0")
    assert etl.purge_exported(readings, gone, path) == gone.count()
    left = spark.read.parquet(path)
    assert left.count() + gone.count() == readings.count()
    assert left.join(gone, "id").count() == 0
    nothing = gone.limit(0)
    assert etl.purge_exported(readings, nothing, scratch_path(spark, "purged")) == 0


def test_replayed_batch_does_not_repeat_rows(spark, readings):
    path = scratch_path(spark, "batches")
    for _ in range(2):
        sinks.write_batch(readings.where("id < 10"), path, 7)
    sinks.write_batch(readings.where("id >= 10 AND id < 15"), path, 8)
    assert spark.read.parquet(path).count() == 15


def test_newest_readings_break_ties_by_id(spark):
    df = spark.sql("SELECT id, TIMESTAMP'2024-01-01' AS timestamp FROM range(20)")
    assert [r["id"] for r in etl.newest_readings(df, 3).collect()] == [19, 18, 17]


@pytest.mark.parametrize("ranges", [1, 6])
def test_tool_cycles_equal_pandas(spark, readings, ranges):
    # One machine owns half of all rows.
    hot = readings.withColumn("machine_id", F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.col("machine_id")))
    hot = hot.withColumn("tool_wear_minutes", F.expr("CAST((id * 7) % 100 AS DOUBLE)"))
    pdf = hot.select("id", "machine_id", "tool_wear_minutes").toPandas().sort_values(["machine_id", "id"])
    drops = pdf.groupby("machine_id")["tool_wear_minutes"].diff() < 0
    pdf["cycle"] = drops.groupby(pdf["machine_id"]).cumsum()
    grouped = pdf.groupby(["machine_id", "cycle"])["tool_wear_minutes"].agg(["min", "max", "count"])
    expected = {key: tuple(map(float, row)) for key, row in zip(grouped.index, grouped.to_numpy())}
    rows = tool_life.tool_life_cycles(hot, ranges).collect()
    got = {(r["machine_id"], r["cycle"]): (r["min_wear"], r["max_wear"], float(r["readings"])) for r in rows}
    assert got == expected


@pytest.mark.parametrize(
    "new, production, floor, improvement, floor_ok",
    [
        (0.70, None, 0.60, True, True),
        (0.90, 0.85, 0.85, True, True),
        (0.80, 0.85, 0.60, False, True),
        (0.85, 0.85, 0.60, False, True),
        (0.50, 0.40, 0.60, True, False),
    ],
)
def test_gates(spark, new, production, floor, improvement, floor_ok):
    df = spark.createDataFrame([(new, production)], "new double, old double")
    row = df.select(
        registry.passes_improvement(F.col("new"), F.col("old")), registry.passes_floor(F.col("new"), F.lit(floor))
    ).first()
    assert tuple(row) == (improvement, floor_ok)


def test_promotion_report(spark):
    versions = spark.createDataFrame(
        [
            ("m-binary", "9", "r9"),
            ("m-binary", "10", "r10"),
            ("fresh-multiclass", "1", "r1"),
            ("unmeasured-binary", "1", "gone"),
            ("half-binary", "1", "bare"),
            ("half-binary", "2", "r10"),
        ],
        "model string, version string, run_id string",
    )
    aliases = spark.createDataFrame(
        [("m-binary", "production", "9"), ("half-binary", "production", "1"), ("m-binary", "other", "10")],
        "model string, alias string, version string",
    )
    runs = spark.createDataFrame(
        [("r9", {"f1_test": 0.86}), ("r10", {"f1_test": 0.9}), ("r1", {"f1_test": 0.5}), ("bare", {"x": 1.0})],
        "run_id string, metrics map<string,double>",
    )
    rows = {r["model"]: r for r in registry.promotion_report(versions, aliases, runs, auto=True).collect()}
    assert rows["m-binary"]["candidate_version"] == "10" and rows["m-binary"]["decision"] == "PROMOTED"
    assert rows["m-binary"]["delta"] == pytest.approx(0.04)
    assert rows["fresh-multiclass"]["decision"] == "NOT PROMOTED" and rows["fresh-multiclass"]["gate_improvement"]
    assert rows["unmeasured-binary"]["decision"] == "NO METRIC"
    assert rows["half-binary"]["production_metric_missing"] and rows["half-binary"]["decision"] == "PROMOTED"


def gate(failure, p):
    return lambda df: df.withColumns({"machine_failure": F.lit(failure), "failure_probability": F.lit(p)})


def detail(index):
    return lambda df: df.withColumn("class_index", F.lit(index))


@pytest.mark.parametrize(
    "gate_model, detail_model, failure, kind",
    [
        (gate(0, 0.1), detail(2), 0, None),
        (gate(1, 0.9), detail(2), 1, "osf"),
        (gate(1, 0.9), detail(1), 1, None),
        (gate(1, 0.9), None, 1, None),
    ],
)
def test_gate_and_detail(readings, gate_model, detail_model, failure, kind):
    scored = scoring.gate_and_detail(readings.select("id").limit(5), gate_model, detail_model)
    rows = scoring.response(scored, "id", version="17").collect()
    assert len(rows) == 5
    assert {(r["machine_failure"], r["failure_type"], r["model_name"]) for r in rows} == {
        (failure, kind, C.BINARY_MODEL)
    }


def test_detail_runs_on_positives_only(readings):
    def half(df):
        return df.withColumns({"machine_failure": (F.col("id") % 2).cast("int"), "failure_probability": F.lit(0.5)})

    def fails_on_even(df):
        return df.withColumn("class_index", F.when(F.col("id") % 2 == 1, F.lit(0)).otherwise(F.raise_error(F.lit("negative row"))))

    scored = scoring.gate_and_detail(readings.select("id"), half, fails_on_even)
    assert scored.where("failure_type = 'hdf'").count() == scored.where("machine_failure = 1").count()


def test_empty_request_gives_no_row(spark):
    from torqline.sources import schemas

    requests = spark.createDataFrame([(1, []), (2, [("L", 300.0, 310.0, 1500.0, 40.0, 1.0)])], schemas.BATCH_REQUEST)
    assert [r["request_id"] for r in scoring.explode_batches(requests).collect()] == [2]


def test_stored_readings_keep_their_schema(spark, readings):
    path = scratch_path(spark, "readings")
    sinks.insert_readings(readings, path)
    everything = rd.load_readings(spark, path)
    newest = everything.agg(F.max("timestamp")).first()[0]
    assert everything.count() == readings.count()
    assert rd.load_readings(spark, path, since=str(newest)).count() == 0
