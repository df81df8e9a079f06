"""Seconds per headline query; prints one JSON line.

Every query runs once to warm the JVM and the file cache and is then measured over a full
write of its result to a no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

from torqline.plans.catalog import QUERIES  # noqa: E402
from torqline.session import build_session  # noqa: E402

HEADLINE = [
    "failures_by_cause",
    "engineer_features",
    "valid_readings",
    "quarantine_reasons",
    "failure_flags",
    "failure_type",
    "sequence_udi",
    "export_layout",
    "export_summary",
    "append_union",
    "purge_anti",
    "training_window",
    "newest_readings",
    "ecdf_pair",
    "ks_drift",
    "wasserstein_drift",
    "drift_by_column",
    "drift_verdict",
    "drift_histogram",
    "column_summary",
    "drift_lineitem",
    "drift_by_day",
    "class_weights",
    "macro_scores",
    "roc_auc",
    "brier_multiclass",
    "promotion_report",
    "gate_detail_rules",
    "batch_explode",
    "prediction_quality",
    "fault_shift",
    "bootstrap_rows",
    "tool_life_cycles",
    "stream_score",
    "stream_tool_state",
]


def run(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "torqline-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        run(spark, name, sf_dir)
        seconds[name] = round(run(spark, name, sf_dir), 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
