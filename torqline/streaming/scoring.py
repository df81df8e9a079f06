"""Streaming form of the per-reading loop: validate, engineer, score, store."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from torqline import config as C
from torqline.functions import features, quality
from torqline.operators.scoring import Scorer, gate_and_detail
from torqline.sources.model_store import ModelStore
from torqline.sources.sinks import write_batch
from torqline.training.model import CalibratedModel


@dataclass
class ProductionModels:
    """The production models of a store, reloaded between micro-batches when an alias moves.

    Each model reloads on its own; one that fails to load keeps serving its old version and
    the error is kept in ``errors``.
    """

    store: ModelStore
    loaded: dict[str, tuple[str, CalibratedModel]] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)

    def refresh(self) -> None:
        for name in (C.BINARY_MODEL, C.MULTICLASS_MODEL):
            try:
                target = self.store.production(name)
                if target and self.loaded.get(name, ("",))[0] != target[0]:
                    self.loaded[name] = (target[0], CalibratedModel.load(self.store.spark, target[1]))
                self.errors.pop(name, None)
            except Exception as error:  # noqa: BLE001 - whatever went wrong, the old model serves on
                self.errors[name] = str(error)

    def version(self, name: str) -> str | None:
        return self.loaded[name][0] if name in self.loaded else None

    def scorers(self) -> tuple[Scorer, Scorer | None]:
        """Gate and detail scorer; without a gate there is nothing to serve."""
        if C.BINARY_MODEL not in self.loaded:
            raise RuntimeError(f"no production version of {C.BINARY_MODEL}: {self.errors.get(C.BINARY_MODEL)}")
        detail = self.loaded.get(C.MULTICLASS_MODEL)
        return _on_features(self.loaded[C.BINARY_MODEL][1].as_gate), _on_features(detail[1].as_detail) if detail else None


def _on_features(scorer: Scorer) -> Scorer:
    """Readings call the variant ``machine_type``, models ``type``."""

    def scored(df: DataFrame) -> DataFrame:
        return scorer(df.withColumn("type", F.col("machine_type"))).drop("type")

    return scored


def score_readings(df: DataFrame, gate: Scorer, detail: Scorer | None) -> DataFrame:
    """Valid readings with features and the stored form of their prediction."""
    engineered = df.withColumns(features.derived_features())
    scored = gate_and_detail(engineered, gate, detail)
    return scored.withColumnsRenamed(
        {"machine_failure": "predicted_failure", "failure_type": "predicted_failure_type"}
    ).withColumn("target", features.target_kind(F.col("predicted_failure_type")))


class NotOfTheData(RuntimeError):
    """Scoring failed for a reason that does not lie in single rows."""


# More failing rows than this in one micro-batch are no fault of the rows.
FAILING_ROWS = 64
_SPLITS = 60


def failing_rows(
    rows: DataFrame, attempt: Callable[[DataFrame], None], limit: int = FAILING_ROWS
) -> list[tuple[Column, str]]:
    """Filters on ``rows`` for the rows that ``attempt`` fails on, one by one, each with its error.

    A part that fails is halved by one more bit of a hash of its rows until one row is left (or equal rows): about
    2 log2(rows) attempts for each failing row. ``attempt`` must run the job, not only plan it. If it fails on no rows at all, or on more
    than ``limit`` parts, that is raised as ``NotOfTheData``.
    """
    try:
        attempt(rows.limit(0))
    except Exception as error:
        raise NotOfTheData(f"{type(error).__name__}: {error}"[:500]) from error
    # Maps have no hash; what is equal otherwise stays together.
    plain = [f.name for f in rows.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    drawn = F.xxhash64(*[F.col(f"`{name}`") for name in plain])
    found: list[tuple[Column, str]] = []

    def search(bits: int, value: int) -> None:
        here = drawn.bitwiseAND(F.lit((1 << bits) - 1)) == F.lit(value)
        part = rows.where(here)
        try:
            attempt(part)
            return
        except Exception as error:  # noqa: BLE001 - any error of any scorer
            message = f"{type(error).__name__}: {error}"
        if bits == _SPLITS or part.limit(2).count() < 2:
            found.append((here, message))
            if len(found) > limit:
                raise NotOfTheData(f"scoring fails on more than {limit} rows, last with {message}"[:500])
            return
        search(bits + 1, value)
        search(bits + 1, value | 1 << bits)

    search(0, 0)
    return found


def start_scoring(
    stream: DataFrame,
    scorers: Callable[[], tuple[Scorer, Scorer | None]],
    output: str,
    rejected: str,
    checkpoint: str,
    trigger: dict | None = None,
    retries: int = 2,
    wait_seconds: float = 1.0,
) -> StreamingQuery:
    """Score a stream of readings into ``output``; contract violations go to ``rejected``.

    So do single readings whose scoring fails, with the error as their reason: a micro-batch that fails is halved
    until they are found, and the others are scored. What is no fault of the rows (no model yet, a scorer that fails on
    nothing at all or on many rows) rejects none of them: it is tried again ``retries`` times and then ends the
    run, whose next start takes the same micro-batch up again.

    ``scorers`` is asked before every attempt, which is where models are swapped. Batches
    are written under their number, so one that is replayed replaces its own rows, also by none.
    """

    def score(batch: DataFrame, batch_id: int) -> None:
        refused, valid = quality.quarantine(batch), quality.valid_readings(batch)
        gate, detail = scorers()
        try:
            write_batch(score_readings(valid, gate, detail), output, batch_id, "batch_id")
        except Exception:  # noqa: BLE001 - whatever went wrong, the rows it went wrong with are looked for

            def attempt(part: DataFrame) -> None:
                score_readings(part, gate, detail).write.format("noop").mode("overwrite").save()

            for here, message in failing_rows(valid, attempt):
                reason = F.lit(f"scoring failed: {message}"[:500])
                refused = refused.unionByName(valid.where(here).withColumn("reasons", F.array(reason)))
                valid = valid.where(~here)
            write_batch(score_readings(valid, gate, detail), output, batch_id, "batch_id")
        write_batch(refused, rejected, batch_id, "batch_id")

    def handle(batch: DataFrame, batch_id: int) -> None:
        # Read once for the valid and the rejected branch; recomputed from the source if lost.
        batch = batch.persist()
        try:
            for turn in range(retries + 1):
                try:
                    return score(batch, batch_id)
                except Exception:  # noqa: BLE001 - the last one ends the run
                    if turn == retries:
                        raise
                    time.sleep(wait_seconds)
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def reloading_scorers(spark: SparkSession, root: str) -> Callable[[], tuple[Scorer, Scorer | None]]:
    models = ProductionModels(ModelStore(spark, root))

    def current() -> tuple[Scorer, Scorer | None]:
        models.refresh()
        return models.scorers()

    return current
