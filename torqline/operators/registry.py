"""Model versions, aliases and the promotion report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from torqline import config as C


def newest_versions(versions: DataFrame) -> DataFrame:
    """Newest version per model, compared as integers ("10" is newer than "9").

    A maximum of structs combines before the shuffle, so a model with very many versions is
    no heavier than the others.
    """
    newest = F.max(F.struct(F.col("version").cast("int").alias("number"), F.col("run_id")))
    return versions.groupBy("model").agg(newest.alias("newest")).select(
        "model", F.col("newest.number").cast("string").alias("candidate_version"), "newest.run_id"
    )


def version_metrics(versions: DataFrame, runs: DataFrame, metric: str, output: str) -> DataFrame:
    """Versions with a metric of the run that made them; null when run or metric is missing."""
    values = runs.select("run_id", F.try_element_at("metrics", F.lit(metric)).alias(output))
    return versions.join(values, "run_id", "left")


def passes_improvement(new: Column, production: Column) -> Column:
    """Strictly better than production, or nothing to compare with."""
    return F.when(production.isNull(), F.lit(True)).otherwise(new > production)


def passes_floor(new: Column, floor: Column) -> Column:
    return new >= floor


def default_floor(model: Column) -> Column:
    return F.when(model.contains("binary"), F.lit(C.BINARY_F1_FLOOR)).otherwise(F.lit(C.MULTICLASS_F1_FLOOR))


def promotion_report(
    versions: DataFrame,
    aliases: DataFrame,
    runs: DataFrame,
    metric: str = "f1_test",
    auto: bool = False,
    floor: Column | None = None,
) -> DataFrame:
    """Candidate against production for every model at once, with gates and decision.

    A candidate without the metric cannot be judged and is reported as such. Production
    without the metric passes the first gate, as a missing production does, but is flagged.
    """
    candidates = version_metrics(newest_versions(versions), runs, metric, "new_metric").drop("run_id")
    production = (
        aliases.where(F.col("alias") == C.PRODUCTION_ALIAS)
        .select("model", F.col("version").alias("production_version"))
        .join(
            versions.select("model", F.col("version").alias("production_version"), "run_id"),
            ["model", "production_version"],
            "left",
        )
    )
    production = version_metrics(production, runs, metric, "production_metric").drop("run_id")
    new, old = F.col("new_metric"), F.col("production_metric")
    passed = F.col("gate_improvement") & F.col("gate_floor")
    decision = (
        F.when(new.isNull(), F.lit("NO METRIC"))
        .when(~passed, F.lit("NOT PROMOTED"))
        .otherwise(F.lit("PROMOTED" if auto else "WOULD PROMOTE"))
    )
    return (
        candidates.join(production, "model", "left")
        .withColumn("floor", default_floor(F.col("model")) if floor is None else floor)
        .withColumn("gate_improvement", passes_improvement(new, old))
        .withColumn("gate_floor", passes_floor(new, F.col("floor")))
        .withColumn("production_metric_missing", F.col("production_version").isNotNull() & old.isNull())
        .withColumn("decision", decision)
        .withColumn("delta", F.when(passed, new - old))
    )
