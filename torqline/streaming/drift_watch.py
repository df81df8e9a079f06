"""Repeated drift checks that export, request retraining and keep an audit log."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from torqline import config as C
from torqline.functions.quality import drop_incomplete
from torqline.operators import drift, etl
from torqline.operators.prefix import range_cuts
from torqline.sources import readings as rd
from torqline.sources import schemas, sinks, tables


_NUMBERS = "feature string, value double, n_ref long, n_cur long, check long"
_CATEGORIES = "feature string, category string, n_ref long, n_cur long, check long"


@dataclass
class DriftWatch:
    """One drift check per micro-batch of new readings.

    ``baseline`` holds the nine features of the frozen reference. A check judges all readings that no earlier
    check exported, or the newest ``current_rows`` of them if asked to.

    A watch of a stream reads new readings only. It keeps the readings of each micro-batch, and how often each value
    occurs among them, under the number of its check below ``state`` (a folder beside the training table if none is
    given). A check merges the counts of the checks since the last export with those of the reference, which are
    counted once; an export hands over the readings of the same checks. Both read the folders of these checks alone.
    Exports are noted before and after their rows are written; rows of one that did not end are taken back by
    the next. A replayed check writes the same readings, counts and rows again, in the place of its own.

    ``check`` without a stream judges the whole readings table instead. Exported readings count as purged there: the
    training rows carry the id they came from, so a single write both hands a reading over and takes it out of
    later checks. A replay leaves out what other checks exported only, so it writes its own rows again, with those
    that arrived since, and neither loses nor repeats one.
    """

    spark: SparkSession
    baseline: DataFrame
    readings: str
    training: str
    audit: str
    requests: str
    current_rows: int | None = None
    threshold: float = C.DRIFT_SHARE_THRESHOLD
    export_always: bool = False
    report: str | None = None
    state: str | None = None

    def __post_init__(self) -> None:
        self.state = self.state or f"{self.training.rstrip('/')}-watch"
        self._cuts: dict[str, list[float]] | None = None

    # --- checks of the whole table -----------------------------------------------------------------------------

    def live_readings(self, batch_id: int | None = None) -> DataFrame:
        """Readings that no check but ``batch_id`` has exported."""
        stored = rd.load_readings(self.spark, self.readings)
        exported = tables.if_present(lambda: tables.load_exported_ids(self.spark, self.training, batch_id))
        return stored if exported is None else etl.surviving_readings(stored, exported)

    def check(self, batch_id: int) -> bool:
        """Run one check of the whole table; returns whether drift was found.

        A failing drift test raises. A failing export is kept in the audit row and left to the next check.
        """
        live = self.live_readings(batch_id)
        return self._conclude(batch_id, self._by_column(live), live, lambda: self.export(live, batch_id))

    def _judged(self, live: DataFrame) -> DataFrame:
        judged = etl.newest_readings(live, self.current_rows) if self.current_rows else live
        return drop_incomplete(rd.drift_projection(judged))

    def _by_column(self, live: DataFrame) -> DataFrame:
        return drift.drift_by_column(self.baseline, self._judged(live))

    def _conclude(self, batch_id: int, by_column: DataFrame, live: DataFrame, export: Callable[[], None]) -> bool:
        verdict = drift.drift_verdict(by_column, self.threshold).first()
        if self.report:
            sinks.write_drift_report(drift.drift_report(self.baseline, self._judged(live)), f"{self.report}/{batch_id}")
        drifted = bool(verdict["drift_detected"])
        requested, failure = False, None
        if drifted or self.export_always:
            try:
                export()
                if drifted:
                    sinks.request_retrain(self.spark, self.requests, batch_id)
                    requested = True
            except Exception as error:  # noqa: BLE001 - rows stay live, the next check exports them
                failure = f"{type(error).__name__}: {error}"[:2000]
        sinks.append_audit(self.spark, self.audit, batch_id, drifted, requested, failure)
        return drifted

    def export(self, live: DataFrame, batch_id: int) -> None:
        """Append all live readings to the training table under the number of this check."""
        before = tables.if_present(lambda: self.spark.read.parquet(self.training))
        start = 1
        if before is not None:
            start = etl.next_udi(before.where(F.col("export_batch") != batch_id)).first()["starting_udi"]
        sinks.write_batch(etl.export_layout(live, start, keep_id=True), self.training, batch_id)

    # --- checks of a stream ------------------------------------------------------------------------------------

    def keep(self, batch: DataFrame, batch_id: int) -> None:
        """Store the readings of a micro-batch and the counts of their values under the number of its check."""
        sinks.write_batch(batch.select(*schemas.READINGS.fieldNames()), f"{self.state}/readings", batch_id, "check")
        rows = self._kept("readings", batch_id, batch_id)
        self._store_counts(drop_incomplete(rd.drift_projection(rows)), False, batch_id)

    def _store_counts(self, rows: DataFrame, ref: bool, number: int) -> None:
        side, whole = drift.one_side(rows, [*C.FEATURES], ref), {name: [] for name in C.NUMERIC_FEATURES}
        numbers = drift.numeric_counts(side, C.NUMERIC_FEATURES, whole).drop("range")
        sinks.write_batch(numbers, f"{self.state}/numbers", number, "check")
        sinks.write_batch(drift.category_counts(side, ["type"]), f"{self.state}/categories", number, "check")

    def keep_reference(self) -> dict[str, list[float]]:
        """Count the reference, once for a watch, as check -1; returns the cuts that spread its values."""
        if self._cuts is None:
            self._store_counts(self.baseline, True, -1)
            self._cuts = range_cuts(self.baseline, C.NUMERIC_FEATURES)
        return self._cuts

    def _kept(self, part: str, first: int, last: int, reference: bool = False) -> DataFrame:
        """What checks ``first`` to ``last`` kept, and the reference if asked for: a filter on folders, not on rows."""
        layouts = {
            "readings": T.StructType([*schemas.READINGS.fields, T.StructField("check", T.LongType())]),
            "numbers": _NUMBERS,
            "categories": _CATEGORIES,
        }
        wanted = F.col("check").between(first, last)
        if reference:
            wanted = wanted | (F.col("check") == -1)
        return self.spark.read.schema(layouts[part]).parquet(f"{self.state}/{part}").where(wanted).drop("check")

    def _exports(self, batch_id: int) -> list[Row]:
        """(check, first_check, done) of the exports before ``batch_id`` that matter: the last complete one and later."""
        path = f"{self.state}/exports"
        noted = tables.if_present(
            lambda: self.spark.read.schema(T.StructType([*schemas.EXPORTS.fields, T.StructField("check", T.LongType())])).json(path)
        )
        if noted is None:
            return []
        earlier = noted.where(F.col("check") < batch_id)
        last = earlier.agg(F.max(F.when(F.col("done"), F.col("check"))).alias("check")).first()["check"]
        if last is not None:
            earlier = earlier.where(F.col("check") >= last)
        return earlier.orderBy("check").collect()  # one, and those that failed since

    def check_batch(self, batch: DataFrame, batch_id: int) -> bool:
        """Run the check of one micro-batch; returns whether drift was found. Failures as in ``check``."""
        cuts = self.keep_reference()
        self.keep(batch, batch_id)
        exports = self._exports(batch_id)
        first = 1 + max((row["check"] for row in exports if row["done"]), default=-1)
        live = self._kept("readings", first, batch_id)
        if self.current_rows:
            by_column = self._by_column(live)
        else:
            counts = [self._kept(part, first, batch_id, reference=True) for part in ("numbers", "categories")]
            by_column = drift.drift_from_counts(*counts, cuts)

        def export() -> None:
            sinks.note_export(self.spark, f"{self.state}/exports", batch_id, first, False)
            for row in exports:
                if not row["done"]:
                    # What a failed export may have left is taken back: its readings are among these.
                    nothing = etl.export_layout(live.limit(0), 1, keep_id=True)
                    sinks.write_batch(nothing, self.training, row["check"])
            self.export(live, batch_id)
            sinks.note_export(self.spark, f"{self.state}/exports", batch_id, first, True)

        return self._conclude(batch_id, by_column, live, export)

    def start(
        self, checkpoint: str, trigger: dict | None = None, files_per_trigger: int | None = None
    ) -> StreamingQuery:
        """Check whenever new readings arrive, at the pace of the trigger."""

        def handle(batch: DataFrame, batch_id: int) -> None:
            self.check_batch(batch, batch_id)

        stream = rd.stream_readings(self.spark, self.readings, files_per_trigger)
        writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start()


def start_window_counts(
    stream: DataFrame,
    baseline: DataFrame,
    output: str,
    checkpoint: str,
    window: str = "1 day",
    delay: str = "1 hour",
    trigger: dict | None = None,
) -> list[StreamingQuery]:
    """Count values and categories per event-time window; closed windows are appended.

    The counts are what ``drift_from_window_counts`` compares with a reference, so drift per
    window needs no second look at the readings. Late rows within ``delay`` still count.
    """
    whole = {name: [] for name in C.NUMERIC_FEATURES}
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    instant = stream.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    timed = instant.withWatermark("timestamp", delay).withColumnRenamed("machine_type", "type")
    tagged = timed.select(
        *C.FEATURES, F.window("timestamp", window).alias("window"), zero.alias("is_ref"), one.alias("is_cur")
    )
    counts = {
        "numbers": drift.numeric_counts(tagged, C.NUMERIC_FEATURES, whole, ["window"]).drop("range"),
        "categories": drift.category_counts(tagged, ["type"], ["window"]),
    }
    return [
        frame.withColumn("window", F.col("window.start"))
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", f"{output}/{name}")
        .option("checkpointLocation", f"{checkpoint}/{name}")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
        for name, frame in counts.items()
    ]


def drift_of_closed_windows(spark: SparkSession, baseline: DataFrame, output: str) -> DataFrame:
    """Drift of every window counted so far against the baseline.

    A window counts once the watermark has closed it; the last one stays open until later readings arrive.
    """
    cuts, whole = range_cuts(baseline, C.NUMERIC_FEATURES), {name: [] for name in C.NUMERIC_FEATURES}
    pair = drift.one_side(baseline, [*C.FEATURES], True)
    return drift.drift_from_window_counts(
        drift.numeric_counts(pair, C.NUMERIC_FEATURES, whole).drop("range"),
        spark.read.parquet(f"{output}/numbers"),
        drift.category_counts(pair, ["type"]),
        spark.read.parquet(f"{output}/categories"),
        "window",
        cuts,
    )
