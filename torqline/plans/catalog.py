"""Registered queries: every operator run over whole tables, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from torqline import config as C
from torqline.functions import features, labels, quality
from torqline.operators import drift, etl, metrics, registry, scenario, scoring, tool_life
from torqline.operators.prefix import dense_sequence
from torqline.plans import jobs
from torqline.session import scratch_path
from torqline.sources import readings as rd
from torqline.sources import schemas, sinks, tables
from torqline.sources.model_store import ModelStore
from torqline.streaming import drift_watch
from torqline.streaming import scoring as stream_scoring
from torqline.streaming.drift_watch import DriftWatch
from torqline.streaming.tool_state import current_tools, start_tool_state
from torqline.training import sampling
from torqline.training.calibration import argmax_index, average_probabilities, calibrated_probabilities
from torqline.training.experiments import EXPERIMENTS, Experiment
from torqline.training.model import SCORED_PER_TASK, scored_per_task, spread_rows, train_model
from torqline.training.tuning import tune_model
from torqline.training.vectors import one_hot_columns, scaled_columns

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- inputs shared by the queries ------------------------------------------------------


def _halfway(source: DataFrame) -> int:
    """First id of the newer half; ids are dense from 0."""
    return (source.agg(F.max("id")).first()[0] + 1) // 2


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    source = rd.readings(spark, sf_dir)
    middle = _halfway(source)
    return source.where(F.col("id") < middle), source.where(F.col("id") >= middle)


def _ai4i(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = rd.readings(spark, sf_dir).select("id", "machine_type", *C.SENSORS)
    return features.to_ai4i_names(source.withColumnRenamed("id", "UDI"))


def _training_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All readings in the training layout."""
    return etl.export_layout(rd.readings(spark, sf_dir))


def _drift_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    reference, current = _halves(spark, sf_dir)
    return (
        quality.drop_incomplete(rd.drift_projection(reference)),
        quality.drop_incomplete(rd.drift_projection(current)),
    )


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with the true class (``label``) and the stored prediction (``prediction``)."""
    source = labels.with_failure_flags(rd.readings(spark, sf_dir))
    return source.withColumns(
        {
            "failure_type": labels.failure_type(),
            "predicted_type": F.coalesce("predicted_failure_type", F.lit("none")),
        }
    )


def _rule_gate(df: DataFrame) -> DataFrame:
    """Stand-in for a binary model: the stored probability."""
    return df.withColumn("machine_failure", F.col("predicted_failure"))


def _rule_detail(df: DataFrame) -> DataFrame:
    """Stand-in for a multiclass model: the physics rules on the sensors."""
    return df.withColumn("class_index", labels.encode_class(labels.physics_type()))


# --- features -----------------------------------------------------------------------------


@query
def engineer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.engineer_features(_ai4i(spark, sf_dir))


@query
def rename_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.to_snake_names(_training_table(spark, sf_dir))


@query
def inverse_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ai4i(spark, sf_dir)


@query
def request_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.to_request_names(_ai4i(spark, sf_dir))


@query
def feature_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    sliced = features.feature_slice(features.with_type_column(rd.readings(spark, sf_dir)), "injected_failure")
    return sliced.drop("injected_failure")


@query
def one_hot_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = features.with_type_column(rd.readings(spark, sf_dir))
    dirty = features.with_type_column(rd.with_bad_rows(rd.readings(spark, sf_dir)))
    return one_hot_columns(clean, dirty, "id")


@query
def standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scaling stage of the learners over the numeric features."""
    source = features.with_type_column(rd.readings(spark, sf_dir)).select("id", *C.FEATURES)
    scaled = scaled_columns(source, "id")
    return scaled.select("id", *[F.round(name, 6).alias(name) for name in C.NUMERIC_FEATURES])


# --- quality ---------------------------------------------------------------------------------


@query
def valid_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = rd.with_bad_rows(rd.readings(spark, sf_dir)).select("id", "machine_type", *C.SENSORS)
    return quality.valid_readings(source)


@query
def quarantine_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = rd.with_bad_rows(rd.readings(spark, sf_dir))
    return quality.quarantine(source).select("id", F.array_join("reasons", ",").alias("reasons"))


@query
def drop_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = features.with_type_column(rd.with_bad_rows(rd.readings(spark, sf_dir)))
    return quality.drop_incomplete(features.feature_slice(source, "id"))


@query
def since_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = quality.since_filter(rd.readings(spark, sf_dir), "2024-01-15 00:00:00")
    return source.select("id", "timestamp", "machine_id", "torque_nm")


@query
def target_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rd.readings(spark, sf_dir).select(
        "id",
        features.target_kind(F.col("predicted_failure_type")).alias("target"),
        F.lit(C.BINARY_MODEL).alias("model_name"),
    )


# --- labels ------------------------------------------------------------------------------------


@query
def failure_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = labels.with_failure_flags(rd.readings(spark, sf_dir))
    return flagged.select("id", "twf", "hdf", "pwf", "osf", "rnf")


@query
def failure_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir).select("id", "failure_type")


@query
def label_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = _labelled(spark, sf_dir).withColumn("class_index", labels.encode_class(F.col("failure_type")))
    return encoded.select("id", "class_index")


@query
def label_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = labels.encode_class(F.col("predicted_type"))
    return _labelled(spark, sf_dir).select("id", labels.decode_class(index).alias("failure_type"))


@query
def failures_by_cause(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = quality.valid_readings(rd.with_bad_rows(rd.readings(spark, sf_dir)))
    engineered = valid.withColumns(features.derived_features())
    typed = labels.with_failure_flags(engineered).withColumn("failure_type", labels.failure_type())
    return typed.groupBy("failure_type", "machine_type").agg(
        F.count(F.lit(1)).alias("readings"),
        F.sum("injected_failure").cast("long").alias("failures"),
        F.round(F.avg("power_kw"), 6).alias("avg_power_kw"),
        F.round(F.max("mechanical_stress"), 6).alias("max_stress"),
    )


# --- etl -----------------------------------------------------------------------------------------


def _existing_and_batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    older, newer = _halves(spark, sf_dir)
    existing = etl.export_layout(older)
    start = etl.next_udi(existing).first()["starting_udi"]
    return existing, etl.export_layout(newer, start)


@query
def next_udi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return etl.next_udi(etl.export_layout(rd.readings(spark, sf_dir)))


@query
def sequence_udi(spark: SparkSession, sf_dir: str) -> DataFrame:
    older, newer = _halves(spark, sf_dir)
    start = etl.next_udi(etl.export_layout(older)).first()["starting_udi"]
    return dense_sequence(newer.select("id"), "id", "udi", start)


@query
def product_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = dense_sequence(rd.readings(spark, sf_dir).select("id", "machine_type"), "id", "position")
    return numbered.select("id", features.product_id(F.col("machine_type"), F.col("position")).alias("product_id"))


@query
def export_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _existing_and_batch(spark, sf_dir)[1]


@query
def export_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = etl.export_summary(_existing_and_batch(spark, sf_dir)[1])
    shares = [name for name in summary.columns if name.endswith(("_share", "_rate"))]
    return summary.withColumns({name: F.round(name, 9) for name in shares})


@query
def export_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return etl.export_preview(_existing_and_batch(spark, sf_dir)[1])


@query
def append_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write a first batch, append the second and read the table back."""
    existing, batch = _existing_and_batch(spark, sf_dir)
    path = scratch_path(spark, "training")
    sinks.write_training(existing, path)
    sinks.append_training(batch, path)
    return tables.load_training_table(spark, path)


@query
def purge_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    older, _ = _halves(spark, sf_dir)
    everything = rd.readings(spark, sf_dir).select("id", "timestamp", "machine_id")
    return etl.surviving_readings(everything, older.select("id"))


@query
def training_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return etl.training_window(_training_table(spark, sf_dir), rows=5_000)


@query
def newest_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = etl.newest_readings(rd.readings(spark, sf_dir), rows=2_500)
    return newest.select("id", "timestamp", "machine_id", *C.SENSORS)


@query
def baseline_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A frozen baseline as a CSV round trip, in the feature space of the models."""
    path = scratch_path(spark, "baseline-csv")
    etl.export_layout(rd.readings(spark, sf_dir)).write.option("header", True).csv(path)
    return tables.reference_features(tables.load_baseline_csv(spark, path))


@query
def baseline_sensor_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "baseline-csv")
    etl.export_layout(rd.readings(spark, sf_dir)).write.option("header", True).csv(path)
    return tables.sensor_rows(tables.load_baseline_csv(spark, path))


@query
def readings_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored readings, written and read back through the declared schema, newest part only."""
    path = scratch_path(spark, "readings")
    sinks.insert_readings(rd.readings(spark, sf_dir), path)
    return rd.load_readings(spark, path, since="2024-01-10 12:00:00")


@query
def drift_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rd.drift_projection(rd.readings(spark, sf_dir))


# --- drift -------------------------------------------------------------------------------------------


@query
def ecdf_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    ecdf = drift.paired_ecdf(*_drift_pair(spark, sf_dir))
    return ecdf.select("feature", "value", "n_ref", "n_cur", "cum_ref", "cum_cur")


def _numeric_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.numeric_statistics(drift.paired_ecdf(*_drift_pair(spark, sf_dir)))


@query
def ks_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = drift.kolmogorov_p(F.col("ks"), F.col("n_ref"), F.col("n_cur"))
    return _numeric_statistics(spark, sf_dir).select(
        "feature", F.round("ks", 9).alias("ks"), F.round(p, 9).alias("p_value")
    )


@query
def wasserstein_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numeric_statistics(spark, sf_dir).select("feature", F.round("wasserstein", 9).alias("wasserstein"))


def _category_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["machine_type", "event_type"]
    source = rd.events(spark, sf_dir).withColumn(
        "machine_type", F.expr("CASE WHEN event_id % 10 < 6 THEN 'L' WHEN event_id % 10 < 9 THEN 'M' ELSE 'H' END")
    )
    middle = _halfway(source.withColumnRenamed("event_id", "id"))
    reference, current = source.where(F.col("event_id") < middle), source.where(F.col("event_id") >= middle)
    return drift.category_statistics(drift.category_counts(drift.tagged_union(reference, current, columns), columns))


@query
def chi2_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = drift.chi2_p(F.col("chi2"), F.col("n_values") - 1)
    return _category_statistics(spark, sf_dir).select(
        "feature", F.round("chi2", 9).alias("chi2"), F.round(p, 9).alias("p_value")
    )


@query
def js_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _category_statistics(spark, sf_dir).select("feature", F.round("js", 9).alias("js"))


def _rounded(by_column: DataFrame) -> DataFrame:
    return by_column.withColumn("value", F.round("value", 9))


@query
def drift_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(drift.drift_by_column(*_drift_pair(spark, sf_dir)))


@query
def drift_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdict = drift.drift_verdict(drift.drift_by_column(*_drift_pair(spark, sf_dir)))
    return verdict.withColumn("drift_share", F.round("drift_share", 9))


def _untidy_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both halves with NaN, infinities and nulls planted by id; power is missing throughout the newer one."""
    row_id, infinite = F.col("id"), F.lit(float("inf"))
    torque = F.when(row_id % 41 == 0, F.lit(float("nan"))).when(row_id % 43 == 0, infinite)
    speed = F.when(row_id % 37 == 0, -infinite).when(row_id % 47 != 0, F.col("rotational_speed_rpm"))
    older, newer = (
        half.withColumns({"torque_nm": torque.otherwise(F.col("torque_nm")), "rotational_speed_rpm": speed})
        for half in _halves(spark, sf_dir)
    )
    newer = newer.withColumn("power_kw", F.lit(None).cast("double"))
    return rd.drift_projection(older), rd.drift_projection(newer)


@query
def drift_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drift where values are missing or not finite, and one feature has no current value at all."""
    return _rounded(drift.drift_by_column(*_untidy_pair(spark, sf_dir)))


@query
def drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch check of stored readings against a baseline file; the columns part of its report, read back."""
    older, newer = _halves(spark, sf_dir)
    path = scratch_path(spark, "drift-job")
    etl.export_layout(older).write.option("header", True).csv(f"{path}/baseline")
    sinks.insert_readings(newer, f"{path}/readings")
    jobs.check_drift(spark, f"{path}/baseline", f"{path}/readings", report=f"{path}/report").collect()
    return _rounded(spark.read.parquet(f"{path}/report/columns"))


@query
def drift_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    bins = drift.histograms(*_drift_pair(spark, sf_dir))
    return bins.withColumns({name: F.round(name, 6) for name in ("bin_start", "bin_end")})


@query
def column_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = rd.with_bad_rows(rd.readings(spark, sf_dir)).select(*C.NUMERIC_FEATURES)
    summary = drift.numeric_summary(source)
    return summary.withColumns({name: F.round(name, 6) for name in ("mean", "std", "min", "max", "p25", "p50", "p75")})


@query
def category_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.category_summary(_labelled(spark, sf_dir), ["machine_type", "mode", "predicted_failure_type"])


LINEITEM_SPLIT = "1998-01-01"


@query
def drift_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drift operators on another table: shipments before and after a date."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    cut = F.lit(LINEITEM_SPLIT).cast(items.schema["l_shipdate"].dataType)
    return _rounded(
        drift.drift_by_column(
            items.where(F.col("l_shipdate") < cut),
            items.where(F.col("l_shipdate") >= cut),
            ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
            ["l_returnflag", "l_linestatus"],
        )
    )


@query
def drift_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day against the first one."""
    source = rd.readings(spark, sf_dir)
    first_day = source.agg(F.min("timestamp").cast("date")).first()[0]
    projected = features.with_type_column(source).select(
        *C.FEATURES, F.col("timestamp").cast("date").alias("day")
    )
    reference = projected.where(F.col("day") == F.lit(first_day)).drop("day")
    current = projected.where(F.col("day") > F.lit(first_day))
    return _rounded(drift.drift_by_window(reference, current, "day")).drop("threshold")


# --- training data ------------------------------------------------------------------------------------


def _train_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = _labelled(spark, sf_dir).select("id", "injected_failure", "failure_type")
    return sampling.with_split(labelled, "id").where(~F.col("is_test"))


@query
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = sampling.with_split(rd.readings(spark, sf_dir).select("id", "injected_failure"), "id")
    return split.withColumn("is_test", F.col("is_test").cast("int"))


@query
def stratified_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.with_cv_fold(_train_rows(spark, sf_dir), "id").select("id", "fold")


@query
def imbalance_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratio = sampling.imbalance_ratio(_train_rows(spark, sf_dir), "injected_failure")
    return ratio.withColumn("imbalance_ratio", F.round("imbalance_ratio", 9))


@query
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = sampling.class_weights(_train_rows(spark, sf_dir), "failure_type")
    return weights.withColumn("weight", F.round("weight", 9))


@query
def type_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.type_vocabulary(features.with_type_column(rd.readings(spark, sf_dir)))


# --- metrics --------------------------------------------------------------------------------------------


def _confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion(_labelled(spark, sf_dir), "failure_type", "predicted_type")


def _round_all(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 9) for name in names})


@query
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _confusion(spark, sf_dir)


@query
def binary_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = metrics.confusion(rd.readings(spark, sf_dir), "injected_failure", "predicted_failure")
    return _round_all(metrics.binary_scores(counts), "precision", "recall", "f1")


@query
def class_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_all(metrics.class_scores(_confusion(spark, sf_dir)), "precision", "recall", "f1")


@query
def macro_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_all(metrics.macro_scores(_confusion(spark, sf_dir)), "precision", "recall", "f1")


@query
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    area = metrics.roc_auc(rd.readings(spark, sf_dir), "injected_failure", "failure_probability")
    return _round_all(area, "roc_auc")


@query
def brier_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = metrics.brier_binary(F.col("injected_failure"), F.col("failure_probability"))
    return rd.readings(spark, sf_dir).agg(F.round(score, 9).alias("brier_score"))


def _class_probabilities(predicted_index: Column) -> Column:
    """The stored probability for the predicted class, the rest shared by the other four."""
    p = F.col("failure_probability")
    rest = (F.lit(1.0) - p) / F.lit(4.0)
    return F.array(*[F.when(predicted_index == k, p).otherwise(rest) for k in range(len(C.FAILURE_CLASSES))])


@query
def brier_multiclass(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _labelled(spark, sf_dir).select(
        labels.encode_class(F.col("failure_type")).alias("label"),
        _class_probabilities(labels.encode_class(F.col("predicted_type"))).alias("probabilities"),
    )
    score = metrics.brier_multiclass(F.col("label"), F.col("probabilities"), len(C.FAILURE_CLASSES))
    return rows.agg(F.round(score, 9).alias("brier_score"))


@query
def argmax_prediction(spark: SparkSession, sf_dir: str) -> DataFrame:
    probabilities = _class_probabilities(labels.encode_class(F.col("predicted_type")))
    return _labelled(spark, sf_dir).select("id", argmax_index(probabilities).alias("prediction"))


@query
def calibration_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    bins = metrics.calibration_bins(rd.readings(spark, sf_dir), "injected_failure", "failure_probability")
    return _round_all(bins, "mean_predicted", "observed_rate")


@query
def overfit_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 on the training rows against F1 on the held-out rows, per mode."""
    split = sampling.with_split(rd.readings(spark, sf_dir), "id")
    counts = metrics.confusion(split, "injected_failure", "predicted_failure", by=["mode", "is_test"])
    scores = metrics.binary_scores(counts, by=["mode", "is_test"])
    sides = scores.groupBy("mode").agg(
        F.max(F.when(~F.col("is_test"), F.col("f1"))).alias("f1_train"),
        F.max(F.when(F.col("is_test"), F.col("f1"))).alias("f1_test"),
    )
    judged = sides.withColumns(metrics.overfit(F.col("f1_train"), F.col("f1_test")))
    return _round_all(judged, "f1_train", "f1_test", "overfit_delta")


SIGMOIDS = [(-4.0, 1.5), (-3.0, 1.0), (-5.0, 2.5)]


@query
def calibrate_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sigmoid, renormalise and average: the arithmetic of a three-fold calibration."""
    scores = _class_probabilities(labels.encode_class(F.col("predicted_type")))
    classes = len(C.FAILURE_CLASSES)
    folds = [calibrated_probabilities(F.col("scores"), [sigmoid] * classes) for sigmoid in SIGMOIDS]
    rows = _labelled(spark, sf_dir).select("id", scores.alias("scores"))
    averaged = rows.select("id", average_probabilities(folds, classes).alias("p"))
    return averaged.select(
        "id", *[F.round(F.col("p")[k], 9).alias(f"p_{name}") for k, name in enumerate(C.FAILURE_CLASSES)]
    )


# --- promotion --------------------------------------------------------------------------------------------


def _registry_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A model registry computed from ``orders``: a model per customer, a version per order."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    kind = F.when(F.col("o_custkey") % 2 == 0, F.lit("binary-")).otherwise(F.lit("multiclass-"))
    rows = orders.select(
        F.concat(kind, F.col("o_custkey").cast("string")).alias("model"),
        F.col("o_custkey").alias("customer"),
        F.col("o_orderkey").alias("order"),
        (F.col("o_totalprice") / F.lit(500000.0)).alias("f1"),
    )
    order_text = F.col("order").cast("string")
    versions = rows.select(
        "model",
        order_text.alias("version"),
        F.when(F.col("order") % 17 != 0, F.concat(F.lit("run_"), order_text)).alias("run_id"),
    )
    measured = F.create_map(F.lit("f1_test"), F.round("f1", 4), F.lit("brier_score"), F.lit(0.1))
    bare = F.create_map(F.lit("brier_score"), F.lit(0.2))
    runs = rows.select(
        F.concat(F.lit("run_"), order_text).alias("run_id"),
        F.when(F.col("order") % 11 != 0, measured).otherwise(bare).alias("metrics"),
    )
    aliases = (
        rows.where(F.col("customer") % 3 != 0)
        .groupBy("model")
        .agg(F.min("order").cast("string").alias("version"))
        .select("model", F.lit(C.PRODUCTION_ALIAS).alias("alias"), "version")
    )
    return versions, aliases, runs


@query
def promotion_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = registry.promotion_report(*_registry_tables(spark, sf_dir))
    return report.withColumn("delta", F.round("delta", 9))


# --- scoring ------------------------------------------------------------------------------------------------


@query
def gate_detail_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scoring.gate_and_detail(rd.readings(spark, sf_dir), _rule_gate, _rule_detail)
    return scoring.response(scored, "id", version="1")


@query
def gate_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No detail model: the type stays null and nothing fails."""
    scored = scoring.gate_and_detail(rd.readings(spark, sf_dir), _rule_gate, None)
    return scoring.response(scored, "id", version="1")


def _batch_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of eight consecutive readings; ids are unique, so no request is longer."""
    source = rd.readings(spark, sf_dir)
    reading = F.struct("id", "machine_type", *C.SENSORS, "predicted_failure", "failure_probability")
    return (
        source.groupBy(F.expr("id div 8").alias("request_id"))
        .agg(F.sort_array(F.collect_list(reading)).alias("readings"))
    )


@query
def batch_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    exploded = scoring.explode_batches(_batch_requests(spark, sf_dir))
    scored = scoring.gate_and_detail(exploded, _rule_gate, _rule_detail)
    return scoring.response(scored, "request_id", "position", version="1").drop("model_name", "model_version")


@query
def batch_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    exploded = scoring.explode_batches(_batch_requests(spark, sf_dir))
    return scoring.batch_totals(scoring.gate_and_detail(exploded, _rule_gate, None))


@query
def alert_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rd.readings(spark, sf_dir).select("id", scoring.alert_level(F.col("failure_probability")).alias("alert"))


@query
def prediction_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = ["machine_type", "mode"]
    counts = metrics.confusion(rd.readings(spark, sf_dir), "injected_failure", "predicted_failure", by=by)
    return _round_all(metrics.binary_scores(counts, by=by), "precision", "recall", "f1")


# --- scenario -------------------------------------------------------------------------------------------------


@query
def failure_rate_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All schedules side by side over the reading numbers of the table."""
    source = rd.readings(spark, sf_dir)
    length = F.lit(source.agg(F.count(F.lit(1))).first()[0]).cast("long")
    index = F.col("reading_number") - 1
    modes = {"flat": "normal", "ramp": "gradual-drift", "step": "sudden-spike", "other": "unheard-of"}
    rates = [scenario.failure_rate(F.lit(mode), index, length).alias(name) for name, mode in modes.items()]
    return source.select("reading_number", *rates, F.col("effective_failure_rate"))


@query
def fault_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = rd.readings(spark, sf_dir)
    rate = F.col("effective_failure_rate")
    needed = source.select("id", *C.SENSORS, scenario.chosen_for_fault(F.col("id"), rate).alias("chosen"))
    shifted = scenario.round_generated(scenario.fault_shift(needed, F.col("chosen")))
    return shifted.withColumn("chosen", F.col("chosen").cast("int"))


@query
def bootstrap_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    older, newer = _halves(spark, sf_dir)
    sensors = ["machine_type", *C.SENSORS[:4]]
    baseline = dense_sequence(older.select("id", *sensors), "id", "row_index").drop("id")
    return scenario.bootstrap(baseline, newer.select("id"), older.count(), "row_index", "id")


@query
def tool_life_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tool_life.tool_life_cycles(rd.readings(spark, sf_dir))


# --- training (results depend on random draws inside the learners) -------------------------------------------

# Experiments whose query trains on every row of its table, not on the newest of them.
WHOLE_TABLE = {"xgb_multiclass"}


def _window_for(spark: SparkSession, sf_dir: str, experiment: Experiment) -> DataFrame:
    """The newest training rows, or all of ``WHOLE_TABLE``; the multiclass target needs a table with all classes."""
    if experiment.multiclass:
        table = rd.failure_pattern(rd.events(spark, sf_dir))
    else:
        table = _training_table(spark, sf_dir)
    return table if experiment.name in WHOLE_TABLE else etl.training_window(table)


def _training_query(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        experiment = EXPERIMENTS[name]
        _, scores, _ = train_model(_window_for(spark, sf_dir, experiment), experiment)
        rows = [(name, metric, float(value)) for metric, value in scores.items()]
        return spark.createDataFrame(rows, "experiment string, metric string, value double")

    return run


for _name in EXPERIMENTS:
    QUERIES[f"train_{_name}"] = _training_query(_name)


@query
def tune_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    experiment = EXPERIMENTS["lgbm_binary"]
    table = _window_for(spark, sf_dir, experiment)
    _, trials = tune_model(table, experiment)
    rows = [(i, float(t["stepSize"]), int(t["minInstancesPerNode"]), t["mean_f1"]) for i, t in enumerate(trials)]
    return spark.createDataFrame(rows, "trial int, step_size double, min_instances int, mean_f1 double")


def _trained(spark: SparkSession, sf_dir: str, name: str):
    experiment = EXPERIMENTS[name]
    return experiment, *train_model(_window_for(spark, sf_dir, experiment), experiment)


@query
def log_and_promote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train two versions of a model, log both and report on promoting the newer one."""
    store = ModelStore(spark, scratch_path(spark, "models"))
    for name in ("logreg_binary", "rf_binary"):
        experiment, model, scores, params = _trained(spark, sf_dir, name)
        version = store.log_run(experiment, model, scores, params)
        if name == "logreg_binary":
            store.set_alias(experiment.model_name, version)
    return registry.promotion_report(store.versions(), store.aliases(), store.runs())


@query
def score_batch_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gate and detail with trained models instead of rules."""
    _, gate, _, _ = _trained(spark, sf_dir, "rf_binary")
    _, detail, _, _ = _trained(spark, sf_dir, "rf_multiclass")
    source = features.with_type_column(rd.readings(spark, sf_dir)).select("id", *C.FEATURES)
    rows = source.count()
    source = spread_rows(source, rows, "id", scored_per_task(spark, rows, SCORED_PER_TASK))
    return scoring.response(scoring.gate_and_detail(source, gate.as_gate, detail.as_detail), "id", version="1")


# --- streaming ---------------------------------------------------------------------------------------------


@query
def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as a stream through validation and scoring; the stored predictions."""
    raw = rd.readings_from_events(rd.stream_events(spark, sf_dir), readings_in_run=1)
    unscored = rd.with_bad_rows(raw).drop("predicted_failure_type", "target", *C.DERIVED)
    path = scratch_path(spark, "stream-score")
    running = stream_scoring.start_scoring(
        unscored, lambda: (_stream_gate, _rule_detail), f"{path}/scored", f"{path}/rejected", f"{path}/checkpoint"
    )
    running.awaitTermination()
    scored = spark.read.parquet(f"{path}/scored")
    return scored.select("id", "predicted_failure", "predicted_failure_type", "failure_probability", "target")


def _stream_gate(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("predicted_failure", "machine_failure")


@query
def stream_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of drift checks over all new readings: audit log of what each one did."""
    older, newer = _halves(spark, sf_dir)
    path = scratch_path(spark, "stream-drift")
    sinks.insert_readings(newer, f"{path}/readings")
    baseline = quality.drop_incomplete(rd.drift_projection(older))
    watch = DriftWatch(
        spark,
        baseline,
        f"{path}/readings",
        f"{path}/training",
        f"{path}/audit",
        f"{path}/requests",
        threshold=0.2,
        export_always=True,
    )
    watch.start(f"{path}/checkpoint").awaitTermination()
    log = spark.read.schema(schemas.AUDIT_LOG).json(f"{path}/audit")
    exported = tables.load_training_table(spark, f"{path}/training").count()
    return log.select("drift_detected", "retrain_triggered", F.lit(exported).cast("long").alias("exported_rows"))


@query
def stream_window_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drift per event-time day from counts kept by a stream; the last day is still open."""
    source = rd.readings(spark, sf_dir)
    first_day = source.agg(F.min("timestamp").cast("date")).first()[0]
    later = F.col("timestamp").cast("date") > F.lit(first_day)
    baseline = rd.drift_projection(source.where(~later))
    path = scratch_path(spark, "stream-windows")
    stream = rd.readings_from_events(rd.stream_events(spark, sf_dir), readings_in_run=1).where(later)
    for running in drift_watch.start_window_counts(stream, baseline, f"{path}/counts", f"{path}/checkpoint"):
        running.awaitTermination()
    by_window = drift_watch.drift_of_closed_windows(spark, baseline, f"{path}/counts")
    return _rounded(by_window.withColumn("day", F.col("window").cast("date"))).drop("window", "threshold")


@query
def stream_tool_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "stream-tools")
    stream = rd.readings_from_events(rd.stream_events(spark, sf_dir), readings_in_run=1)
    start_tool_state(stream, f"{path}/state", f"{path}/checkpoint").awaitTermination()
    return current_tools(spark, f"{path}/state")
