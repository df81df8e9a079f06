"""Properties of physical plans that decide how the jobs behave at scale."""

from __future__ import annotations

import re

from torqline.functions import labels, quality
from torqline.operators import drift, etl, metrics, tool_life
from torqline.operators.prefix import dense_sequence
from torqline.session import scratch_path
from torqline.sources import readings as rd
from torqline.sources import sinks


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def single_partition_windows(text: str) -> int:
    return len(re.findall(r"Arguments: SinglePartition", text))


def test_rules_are_plain_expressions(readings):
    text = plan(labels.with_failure_flags(readings).select("id", "twf", "hdf", "pwf", "osf"))
    assert "Python" not in text and "Exchange" not in text and "Join" not in text


def test_filters_and_columns_reach_the_scan(spark, readings):
    path = scratch_path(spark, "readings")
    sinks.insert_readings(readings, path)
    stored = rd.load_readings(spark, path, since="2024-01-15 00:00:00").select("id", "torque_nm")
    text = plan(stored)
    assert "GreaterThan(timestamp," in text
    assert "ReadSchema: struct<id:bigint,timestamp:timestamp,torque_nm:double>" in text
    bounds = plan(quality.valid_readings(rd.load_readings(spark, path)).select("id"))
    assert "LessThan(torque_nm,100.0)" in bounds and "LessThanOrEqual(tool_wear_minutes,260.0)" in bounds


def test_time_filter_reaches_the_event_scan(readings):
    assert "GreaterThan(ts," in plan(quality.since_filter(readings, "2024-01-15 00:00:00").select("id"))


def test_top_k_is_not_a_full_sort(readings):
    text = plan(etl.newest_readings(readings, 10))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_numbering_sorts_ranges_not_the_table(readings):
    text = plan(dense_sequence(readings.select("id"), "id", "udi", ranges=8))
    # The only single-partition exchange carries one row per range.
    rows_window = re.search(r"Window\n.*?\n", text)
    assert rows_window and single_partition_windows(text) <= 1
    assert "hashpartitioning(__range" in text


def test_drift_scans_numeric_features_once_per_side(readings):
    older = rd.drift_projection(readings.where("id < 500"))
    newer = rd.drift_projection(readings.where("id >= 500"))
    result = drift.numeric_statistics(drift.paired_ecdf(older, newer, ranges=4))
    result.collect()
    text = plan(result)
    assert single_partition_windows(text) == 0
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    final = text.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final


def test_auc_and_tool_life_have_no_table_wide_window(readings):
    auc = metrics.roc_auc(readings, "injected_failure", "failure_probability", ranges=4)
    # One exchange for the ranges, one for the final sum: both carry a few rows.
    assert single_partition_windows(plan(auc)) <= 2
    assert single_partition_windows(plan(tool_life.tool_life_cycles(readings, ranges=4))) == 0


def test_purge_is_one_anti_join(readings):
    text = plan(etl.surviving_readings(readings, readings.where("id < 100").select("id")))
    assert "LeftAnti" in text and "NestedLoop" not in text
