from __future__ import annotations

from pyspark.sql import functions as F

from torqline import config as C
from torqline.functions import quality
from torqline.operators import drift
from torqline.plans import jobs
from torqline.session import scratch_path
from torqline.sources import readings as rd
from torqline.sources import sinks, tables
from torqline.sources.model_store import ModelStore


def test_export_train_promote(spark, sf_dir, readings):
    path = scratch_path(spark, "jobs")
    sinks.insert_readings(readings, f"{path}/readings")
    late = "2024-01-20 00:00:00"
    first = jobs.export_readings(spark, f"{path}/readings", f"{path}/training")
    n = readings.count()
    assert first.summary.first()["rows"] == n and first.preview.count() == 3 and first.purged == 0
    newer = readings.where(F.col("timestamp") > F.lit(late).cast("timestamp_ntz")).count()
    second = jobs.export_readings(
        spark, f"{path}/readings", f"{path}/training", since=late, purged_readings=f"{path}/left"
    )
    assert second.purged == newer and rd.load_readings(spark, f"{path}/left").count() == n - newer
    table = tables.load_training_table(spark, f"{path}/training")
    assert tuple(table.agg(F.count("UDI"), F.max("UDI")).first()) == (n + newer, n + newer)

    store = ModelStore(spark, f"{path}/store")
    quick = {"numTrees": 5, "maxDepth": 8}
    version, scores = jobs.train_and_log(spark, f"{path}/training", store, "rf_binary", overrides=quick)
    assert version == "1" and 0 <= scores["f1_test"] <= 1
    tuned, _ = jobs.train_and_log(
        spark, f"{path}/training", store, "svm_binary", tune=True, trials=1, overrides={"fourierFeatures": 8, "maxIter": 2}
    )
    assert tuned == "2"
    logged = {r["experiment"]: r for r in store.runs().collect()}
    assert logged["predictive-maintenance/svm/binary"]["params"]["tuned"] == "True"
    assert logged["predictive-maintenance/random-forest/binary"]["metrics"]["f1_test"] == scores["f1_test"]
    dry = jobs.promote(store).first()
    assert dry["model"] == C.BINARY_MODEL and dry["candidate_version"] == "2" and store.aliases().count() == 0


def test_drift_report_parts(spark, readings):
    path = scratch_path(spark, "report")
    older = quality.drop_incomplete(rd.drift_projection(readings.where("id < 500")))
    newer = quality.drop_incomplete(rd.drift_projection(readings.where("id >= 500")))
    sinks.write_drift_report(drift.drift_report(older, newer), path)
    assert spark.read.parquet(f"{path}/columns").count() == 9
    assert spark.read.parquet(f"{path}/verdict").count() == 1
    bars = spark.read.parquet(f"{path}/histograms").groupBy("feature").agg(F.sum("n_ref"), F.sum("n_cur")).collect()
    assert len(bars) == 8 and {tuple(b)[1:] for b in bars} == {(500, 500)}
    for side in ("reference", "current"):
        assert spark.read.parquet(f"{path}/summary_{side}").count() == 8
        assert spark.read.parquet(f"{path}/categories_{side}").count() == 1
