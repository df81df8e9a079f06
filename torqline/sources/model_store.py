"""Runs, model versions and aliases as append-only tables next to the saved models."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from torqline import config as C
from torqline.sources import schemas
from torqline.sources.sinks import utc_now
from torqline.sources.tables import if_present
from torqline.training.experiments import Experiment
from torqline.training.model import CalibratedModel

_ALIAS_LOG = "model string, alias string, version string, set_at string"


class ModelStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _read(self, name: str, schema) -> DataFrame:
        stored = if_present(lambda: self.spark.read.schema(schema).parquet(f"{self.root}/{name}"))
        return self.spark.createDataFrame([], schema) if stored is None else stored

    def _append(self, name: str, row: tuple, schema) -> None:
        frame = self.spark.createDataFrame([row], schema)
        frame.coalesce(1).write.mode("append").parquet(f"{self.root}/{name}")

    def runs(self) -> DataFrame:
        return self._read("runs", schemas.RUNS)

    def versions(self) -> DataFrame:
        return self._read("model_versions", schemas.MODEL_VERSIONS)

    def aliases(self) -> DataFrame:
        """The last version each alias was set to."""
        log = self._read("aliases", _ALIAS_LOG)
        return log.groupBy("model", "alias").agg(F.max_by("version", "set_at").alias("version"))

    def log_run(
        self,
        experiment: Experiment,
        model: CalibratedModel,
        metrics: dict[str, float],
        params: dict,
        developer: str = "unknown",
    ) -> str:
        """Save the model, then record its run, then its version; returns the version.

        A failure on the way leaves at most files no table points to.
        """
        run_id = uuid.uuid4().hex
        path = f"{self.root}/models/{run_id}"
        model.save(path)
        tags = {
            "model_family": experiment.family,
            "target_type": "multiclass" if experiment.multiclass else "binary",
            "target": experiment.target,
            "experiment_name": experiment.experiment_path,
            "developer": developer,
        }
        texts = {name: str(value) for name, value in params.items()}
        values = {name: float(value) for name, value in metrics.items() if value is not None}
        self._append("runs", (run_id, experiment.experiment_path, tags, texts, values), schemas.RUNS)
        newest = self.versions().where(F.col("model") == experiment.model_name)
        last = newest.agg(F.max(F.col("version").cast("int"))).first()[0]
        version = str((last or 0) + 1)
        self._append("model_versions", (experiment.model_name, version, run_id, path), schemas.MODEL_VERSIONS)
        return version

    def set_alias(self, model: str, version: str, alias: str = C.PRODUCTION_ALIAS) -> None:
        self._append("aliases", (model, alias, version, utc_now()), _ALIAS_LOG)

    def production(self, model: str) -> tuple[str, str] | None:
        """Version and path of the production model."""
        current = self.aliases().where((F.col("model") == model) & (F.col("alias") == C.PRODUCTION_ALIAS))
        row = current.join(self.versions(), ["model", "version"]).select("version", "path").first()
        return (row["version"], row["path"]) if row else None
