from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from torqline.functions import quality
from torqline.operators import drift, etl
from torqline.plans import jobs
from torqline.session import scratch_path
from torqline.sources import readings as rd
from torqline.sources import schemas, sinks, tables
from torqline.streaming.drift_watch import DriftWatch
from torqline.streaming.scoring import NotOfTheData, failing_rows, start_scoring
from torqline.streaming.tool_state import current_tools, start_tool_state, tool_pieces


def gate(df):
    return df.withColumnRenamed("predicted_failure", "machine_failure")


def detail(df):
    return df.withColumn("class_index", F.lit(2))


def test_scoring_stream_splits_rejects_and_resumes(spark, readings):
    path = scratch_path(spark, "stream")
    bad = rd.with_bad_rows(readings).drop("predicted_failure_type", "target")
    schema = bad.schema

    def run():
        stream = spark.readStream.schema(schema).parquet(f"{path}/in")
        start_scoring(stream, lambda: (gate, detail), f"{path}/out", f"{path}/rejected", f"{path}/cp").awaitTermination()

    bad.where("id < 600").write.parquet(f"{path}/in")
    run()
    bad.where("id >= 600").write.mode("append").parquet(f"{path}/in")
    run()
    scored, rejected = spark.read.parquet(f"{path}/out"), spark.read.parquet(f"{path}/rejected")
    assert scored.count() == quality.valid_readings(bad).count()
    assert scored.count() + rejected.count() == readings.count()
    assert scored.select("batch_id").distinct().count() == 2
    assert rejected.where(F.size("reasons") == 0).count() == 0
    assert scored.where("predicted_failure = 1 AND predicted_failure_type <> 'osf'").count() == 0
    assert scored.where("predicted_failure = 0 AND target <> 'binary'").count() == 0


@pytest.fixture
def watch(spark, readings):
    path = scratch_path(spark, "watch")
    baseline = quality.drop_incomplete(rd.drift_projection(readings.where("id < 500")))
    return DriftWatch(spark, baseline, f"{path}/readings", f"{path}/training", f"{path}/audit", f"{path}/requests")


def audit(watch):
    log = watch.spark.read.schema(schemas.AUDIT_LOG).json(watch.audit)
    return [(r["drift_detected"], r["retrain_triggered"]) for r in log.orderBy("timestamp").collect()]


def shifted(readings):
    return readings.withColumns(
        {name: F.col(name) + 50.0 for name in ("torque_nm", "tool_wear_minutes", "power_kw", "mechanical_stress")}
    )


def test_no_drift_only_logs(watch, readings):
    sinks.insert_readings(readings.where("id < 500"), watch.readings)
    assert watch.check(0) is False
    assert audit(watch) == [(False, False)]
    assert watch.live_readings().count() == 500


def test_export_always_without_drift_requests_nothing(watch, readings):
    watch.export_always = True
    sinks.insert_readings(readings.where("id < 500"), watch.readings)
    assert watch.check(0) is False
    assert audit(watch) == [(False, False)]
    assert watch.live_readings().count() == 0
    assert tables.load_training_table(watch.spark, watch.training).count() == 500


def test_drift_exports_requests_and_purges(watch, readings):
    sinks.insert_readings(shifted(readings.where("id < 400")), watch.readings)
    assert watch.check(0) is True
    sinks.insert_readings(shifted(readings.where("id >= 400")), watch.readings)
    assert watch.live_readings().count() == readings.count() - 400
    assert watch.check(1) is True
    table = tables.load_training_table(watch.spark, watch.training)
    stats = table.agg(F.count("UDI"), F.countDistinct("UDI"), F.max("UDI")).first()
    assert tuple(stats) == (readings.count(),) * 3
    assert audit(watch) == [(True, True), (True, True)]
    assert watch.spark.read.json(watch.requests).count() == 2


def exported(watch):
    """(reading, check) of the training rows, whose keys must be dense."""
    rows = watch.spark.read.parquet(watch.training).select("UDI", "reading_id", "export_batch").collect()
    assert sorted(r["UDI"] for r in rows) == list(range(1, len(rows) + 1))
    return sorted((r["reading_id"], r["export_batch"]) for r in rows)


def test_stream_checks_over_several_triggers(watch, readings):
    """Checks without drift gather; the first one with drift hands over what gathered, the next only what is new."""
    steps = [readings.where("id < 300"), readings.where("id BETWEEN 300 AND 499")]
    steps += [shifted(readings.where("id BETWEEN 500 AND 899")), shifted(readings.where("id >= 900"))]
    for rows in steps:
        sinks.insert_readings(rows, watch.readings)
        watch.start(f"{watch.audit}-cp").awaitTermination()
    assert audit(watch) == [(False, False), (False, False), (True, True), (True, True)]
    ids = [r["id"] for r in readings.select("id").collect()]
    assert exported(watch) == sorted((i, 2 if i < 900 else 3) for i in ids)


def test_a_stream_check_judges_as_a_check_of_the_table(watch, readings, monkeypatch):
    """Counts merged over checks give the verdict per column that all their readings give."""
    seen = []
    real = drift.drift_verdict
    monkeypatch.setattr(drift, "drift_verdict", lambda rows, threshold: seen.append(rows.collect()) or real(rows, threshold))
    watch.threshold = 2.0
    for n, rows in enumerate([readings.where("id < 200"), shifted(readings.where("id BETWEEN 200 AND 399"))]):
        sinks.insert_readings(rows, watch.readings)
        watch.check_batch(rows, n)
    watch.check(5)
    merged, whole = ({r["feature"]: r for r in rows} for rows in seen[1:])
    assert set(merged) == set(whole) and len(merged) == 9
    for name, row in whole.items():
        assert merged[name]["method"] == row["method"] and merged[name]["drifted"] == row["drifted"]
        assert merged[name]["value"] == pytest.approx(row["value"], rel=1e-9, abs=1e-12)
        assert (merged[name]["n_ref"], merged[name]["n_cur"]) == (row["n_ref"], row["n_cur"])


def test_replayed_stream_checks_change_nothing(watch, readings):
    first, second = shifted(readings.where("id < 400")), shifted(readings.where("id >= 400"))
    for rows, number in ((first, 0), (second, 1), (second, 1)):
        assert watch.check_batch(rows, number) is True
    ids = [r["id"] for r in readings.select("id").collect()]
    assert exported(watch) == sorted((i, int(i >= 400)) for i in ids)
    assert len(audit(watch)) == 2


def test_rows_of_an_export_that_failed_go_with_the_next(watch, readings, monkeypatch):
    """An export that dies after its rows were written, and one that dies before: no row twice, none lost."""
    write, calls = sinks.write_batch, []

    def failing(df, path, batch_id, *rest, **more):
        after = path == watch.training and batch_id == 0
        if path == watch.training and batch_id == 1 and 1 not in calls:
            calls.append(1)
            raise OSError("full")
        write(df, path, batch_id, *rest, **more)
        if after and 0 not in calls:
            calls.append(0)
            raise OSError("lost")

    monkeypatch.setattr(sinks, "write_batch", failing)
    parts = [shifted(readings.where(f"id % 3 = {n}")) for n in range(3)]
    for number, rows in enumerate(parts):
        assert watch.check_batch(rows, number) is True
    assert sorted(calls) == [0, 1]
    assert audit(watch) == [(True, False), (True, False), (True, True)]
    assert exported(watch) == [(r["id"], 2) for r in readings.select("id").orderBy("id").collect()]


def test_a_stream_check_reads_folders_of_open_checks_only(watch, readings):
    for number in range(4):
        sinks.write_batch(readings.where(f"id % 4 = {number}"), f"{watch.state}/readings", number, "check")
    live = watch._kept("readings", 2, 3)
    plan = live._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(check" in plan and "Join" not in plan
    assert {f.split("check=")[1][0] for f in live.inputFiles()} >= {"2", "3"}
    assert sorted({r["id"] % 4 for r in live.collect()}) == [2, 3]


def test_replayed_check_does_not_repeat_rows(watch, readings):
    sinks.insert_readings(shifted(readings), watch.readings)
    live = watch.live_readings()
    watch.export(live, 0)
    watch.export(live, 0)
    assert tables.load_training_table(watch.spark, watch.training).count() == readings.count()


def test_replay_after_new_readings_keeps_what_was_exported(watch, readings):
    sinks.insert_readings(shifted(readings.where("id < 400")), watch.readings)
    assert watch.check(0) is True
    sinks.insert_readings(shifted(readings.where("id >= 400 AND id < 450")), watch.readings)
    assert watch.check(0) is True
    table = tables.load_training_table(watch.spark, watch.training)
    assert tuple(table.agg(F.count("UDI"), F.countDistinct("UDI"), F.max("UDI")).first()) == (450, 450, 450)
    assert watch.live_readings().count() == 0 and len(audit(watch)) == 1


def test_exports_follow_the_rows_of_the_batch_job(watch, readings):
    sinks.insert_readings(shifted(readings.where("id < 500")), watch.readings)
    jobs.export_readings(watch.spark, watch.readings, watch.training)
    assert watch.live_readings().count() == 0
    sinks.insert_readings(shifted(readings.where("id >= 500")), watch.readings)
    assert watch.check(0) is True and audit(watch) == [(True, True)]
    table = tables.load_training_table(watch.spark, watch.training)
    n = readings.count()
    assert tuple(table.agg(F.count("UDI"), F.countDistinct("UDI"), F.max("UDI")).first()) == (n, n, n)


def scoring_run(spark, bad, path, scorers):
    stream = spark.readStream.schema(bad.schema).parquet(f"{path}/in")
    query = start_scoring(stream, scorers, f"{path}/out", f"{path}/rejected", f"{path}/cp", retries=1, wait_seconds=0.1)
    query.awaitTermination()


def test_without_a_model_nothing_is_rejected(spark, readings):
    """No version yet, or a scorer that fails whatever it gets: the run ends and the next one scores the same rows."""
    path = scratch_path(spark, "stream")
    bad = rd.with_bad_rows(readings).drop("predicted_failure_type", "target")
    bad.write.parquet(f"{path}/in")
    asked = []

    def broken(df):
        raise RuntimeError("no model")

    def none_yet():
        asked.append(1)
        raise RuntimeError("no production version")

    for scorers, message in ((none_yet, "no production version"), (lambda: (broken, detail), "no model")):
        with pytest.raises(Exception, match=message):
            scoring_run(spark, bad, path, scorers)
        rejected = tables.if_present(lambda: spark.read.parquet(f"{path}/rejected"))
        assert rejected is None or rejected.count() == 0
    assert len(asked) == 2
    scoring_run(spark, bad, path, lambda: (gate, detail))
    rejected = spark.read.parquet(f"{path}/rejected")
    assert rejected.where("exists(reasons, r -> r LIKE 'scoring failed%')").count() == 0
    assert spark.read.parquet(f"{path}/out").count() == quality.valid_readings(bad).count()
    assert spark.read.parquet(f"{path}/out").count() + rejected.count() == readings.count()


def test_one_poisoned_row_leaves_the_others_scored(spark, readings):
    path = scratch_path(spark, "stream")
    clean = quality.valid_readings(readings).drop("predicted_failure_type", "target")
    clean.write.parquet(f"{path}/in")
    poisoned = [r["id"] for r in clean.orderBy("id").select("id").limit(500).collect()][123::300]

    def fragile(df):
        checked = F.when(F.col("id").isin(poisoned), F.raise_error(F.lit("no such torque"))).otherwise(F.col("predicted_failure"))
        return df.withColumn("machine_failure", checked.cast("int")).drop("predicted_failure")

    scoring_run(spark, clean, path, lambda: (fragile, detail))
    rejected = spark.read.parquet(f"{path}/rejected")
    assert sorted(r["id"] for r in rejected.collect()) == poisoned
    assert all("no such torque" in r["reasons"][0] for r in rejected.collect())
    assert spark.read.parquet(f"{path}/out").count() == clean.count() - len(poisoned)


def test_many_failing_rows_are_not_of_the_data(spark):
    def attempt(part):
        if part.count():
            raise ValueError("always")

    with pytest.raises(NotOfTheData, match="more than 3 rows"):
        failing_rows(spark.range(40), attempt, limit=3)
    assert failing_rows(spark.range(0), attempt) == []


def test_a_batch_written_again_without_rows_has_none(spark, readings):
    path = scratch_path(spark, "batches")
    for batch_id in (3, 4):
        sinks.write_batch(readings.where("id < 5"), path, batch_id, "batch_id")
    sinks.write_batch(readings.where("id < 0"), path, 3, "batch_id")
    assert [tuple(r) for r in spark.read.parquet(path).groupBy("batch_id").count().collect()] == [(4, 5)]


def test_failed_export_is_retried(watch, readings, monkeypatch):
    sinks.insert_readings(shifted(readings), watch.readings)

    def broken(*_args, **_kwargs):
        raise OSError("storage is away")

    with monkeypatch.context() as patch:
        patch.setattr(etl, "export_layout", broken)
        assert watch.check(0) is True
    assert audit(watch) == [(True, False)] and watch.live_readings().count() == readings.count()
    assert watch.check(1) is True
    assert audit(watch) == [(True, False), (True, True)] and watch.live_readings().count() == 0


def test_tool_state_over_several_batches(spark, readings):
    """Small chunks and three micro-batches give the state of one pass over everything."""
    path = scratch_path(spark, "tools")
    hot = readings.withColumns(
        {
            "machine_id": F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("machine_id")),
            "tool_wear_minutes": F.expr("CAST((id * 7) % 100 AS DOUBLE)"),
        }
    )
    for low in (0, 300, 700):
        part = hot.where((F.col("id") >= low) & (F.col("id") < {0: 300, 300: 700, 700: 10**9}[low]))
        sinks.insert_readings(part.coalesce(1), f"{path}/in")
        stream = rd.stream_readings(spark, f"{path}/in")
        start_tool_state(stream, f"{path}/out", f"{path}/cp", chunk_ids=128).awaitTermination()
    pdf = hot.select("id", "machine_id", "tool_wear_minutes").toPandas().sort_values("id")
    expected = {
        machine: (int((rows["tool_wear_minutes"].diff() < 0).sum()), float(rows["tool_wear_minutes"].iloc[-1]), len(rows))
        for machine, rows in pdf.groupby("machine_id")
    }
    got = {r["machine_id"]: (r["tool_changes"], r["current_wear"], r["readings"]) for r in current_tools(spark, f"{path}/out").collect()}
    assert got == expected


def test_tool_pieces_are_built_in_and_shuffled_once(spark):
    """A micro-batch of nearly as many chunks as readings costs no Python call and no state access for each of them."""
    rows = [("a", 0, 5.0), ("a", 1, 3.0), ("a", 2, None), ("a", 3, 1.0), ("a", 9, 0.0), ("b", 8, float("nan"))]
    rows += [(None, 4, 2.0), (None, 5, 1.0), ("a", 1, 3.0)]
    pieces = tool_pieces(spark.createDataFrame(rows, "machine_id string, id long, tool_wear_minutes double"), 8)
    plan = pieces._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan and "Pandas" not in plan
    got = {(r[0], r[1]): tuple(r[2:]) for r in pieces.collect()}
    assert got == {
        ("a", 0): (5.0, 1.0, 3, 1, 5),
        ("a", 1): (0.0, 0.0, 9, 0, 1),
        ("b", 1): (None, None, 8, 0, 1),
        (None, 0): (2.0, 1.0, 5, 1, 2),
    }
