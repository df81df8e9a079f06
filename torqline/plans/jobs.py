"""The batch entry points: export readings, train a model, report on promotion."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from torqline import config as C
from torqline.functions.quality import drop_incomplete
from torqline.operators import drift, etl, registry
from torqline.sources import readings as rd
from torqline.sources import sinks, tables
from torqline.sources.model_store import ModelStore
from torqline.training.experiments import EXPERIMENTS
from torqline.training.model import train_model
from torqline.training.tuning import tune_and_train


@dataclass
class ExportResult:
    """What an export did: its summary and first rows, and how many readings were purged."""

    summary: DataFrame
    preview: DataFrame
    purged: int = 0


def export_readings(
    spark: SparkSession,
    readings: str,
    training: str,
    since: str | None = None,
    append: bool = True,
    purged_readings: str | None = None,
) -> ExportResult:
    """Readings of one table to training rows of another.

    With ``append`` the rows follow those that exist; otherwise, or when there are none, they
    start a table at ``training``. The table has the layout of the drift watch: a part per batch and the id of the reading in each row.
    Batches of this job are numbered below zero by their first key, so the same export run again
    replaces itself. With ``purged_readings`` the readings that stay are written there, after the
    export is safely stored; exactly the exported ids are left out.
    """
    source = rd.load_readings(spark, readings, since)
    existing = tables.if_present(lambda: tables.load_training_table(spark, training)) if append else None
    if existing is not None:
        start = etl.next_udi(existing).first()["starting_udi"]
    else:
        start = 1
    batch = etl.export_layout(source, start, keep_id=True)
    sinks.write_batch(batch, training, -start, fresh=existing is None)
    result = ExportResult(etl.export_summary(batch), etl.export_preview(batch))
    if purged_readings:
        everything = rd.load_readings(spark, readings)
        result.purged = etl.purge_exported(everything, source.select("id"), purged_readings)
    return result


def check_drift(
    spark: SparkSession,
    baseline_csv: str,
    readings: str,
    since: str | None = None,
    threshold: float = C.DRIFT_SHARE_THRESHOLD,
    rows: int | None = None,
    report: str | None = None,
) -> DataFrame:
    """Drift of the stored readings after ``since`` against a baseline file; the verdict in one row.

    All readings are judged, or the newest ``rows`` of them if asked for. Incomplete rows of either side do not
    count; ``low_sample`` says that too few are left. With ``report`` all parts of the report are written there.
    """
    baseline = tables.reference_features(tables.load_baseline_csv(spark, baseline_csv))
    source = rd.load_readings(spark, readings, since)
    judged = etl.newest_readings(source, rows) if rows else source
    current = drop_incomplete(rd.drift_projection(judged))
    if report:
        sinks.write_drift_report(drift.drift_report(baseline, current), report)
    return drift.drift_verdict(drift.drift_by_column(baseline, current), threshold)


def train_and_log(
    spark: SparkSession,
    training: str,
    store: ModelStore,
    experiment_name: str,
    tune: bool = False,
    trials: int = 30,
    window: int = C.TRAINING_WINDOW,
    overrides: dict | None = None,
) -> tuple[str, dict[str, float]]:
    """Train one experiment on the newest rows and log it; returns the new version and metrics."""
    experiment = EXPERIMENTS[experiment_name].with_params(**(overrides or {}))
    rows = etl.training_window(tables.load_training_table(spark, training), window)
    if tune:
        model, scores, params = tune_and_train(rows, experiment, trials)
    else:
        model, scores, params = train_model(rows, experiment)
    return store.log_run(experiment, model, scores, params), scores


def promote(store: ModelStore, auto: bool = False) -> DataFrame:
    """The promotion report; with ``auto`` the aliases of passing candidates move."""
    report = registry.promotion_report(store.versions(), store.aliases(), store.runs(), auto=auto)
    if auto:
        # One row per model name, of which there are two.
        for row in report.where("decision = 'PROMOTED'").select("model", "candidate_version").collect():
            store.set_alias(row["model"], row["candidate_version"])
    return report
