from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from torqline import config as C
from torqline.functions import stats
from torqline.operators import drift
from torqline.sources import readings as rd

SLOW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def frame(spark, values, column="x"):
    return spark.createDataFrame([(float(v),) for v in values], f"{column} double")


def brute(reference, current):
    """KS distance, Wasserstein integral over the merged grid, and both normalised."""
    grid = np.unique(np.concatenate([reference, current]))
    f_ref = np.searchsorted(np.sort(reference), grid, side="right") / len(reference)
    f_cur = np.searchsorted(np.sort(current), grid, side="right") / len(current)
    gap = np.abs(f_ref - f_cur)
    distance = float((gap[:-1] * np.diff(grid)).sum())
    return gap.max(), distance / max(np.std(reference), C.WASSERSTEIN_NORM_FLOOR)


@SLOW
@given(
    a=st.lists(st.integers(-50, 50), min_size=1, max_size=60),
    b=st.lists(st.integers(-50, 50), min_size=1, max_size=60),
    ranges=st.integers(1, 6),
)
def test_distances_equal_brute_force(spark, a, b, ranges):
    ecdf = drift.paired_ecdf(frame(spark, a), frame(spark, b), ["x"], ranges)
    row = drift.numeric_statistics(ecdf).first()
    ks, wasserstein = brute(np.array(a, float), np.array(b, float))
    assert row["ks"] == pytest.approx(ks, abs=1e-12)
    assert row["wasserstein"] == pytest.approx(wasserstein, rel=1e-9, abs=1e-12)
    assert (row["n_ref"], row["n_cur"], row["n_values"]) == (len(a), len(b), len(set(a) | set(b)))


def test_frame_against_itself_has_no_distance(spark):
    same = frame(spark, range(200))
    row = drift.numeric_statistics(drift.paired_ecdf(same, same, ["x"], 4)).first()
    assert row["ks"] == 0 and row["wasserstein"] == 0 and row["js"] == pytest.approx(0, abs=1e-9)


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("x", [0.0, 0.1, 0.5, 1.0, 1.7, 2.5, 4.0, 7.0])
def test_erfc(spark, x):
    assert one(spark, stats.erfc(F.lit(x))) == pytest.approx(math.erfc(x), abs=1e-14)


# Critical values from printed tables of the chi-squared distribution.
@pytest.mark.parametrize(
    "statistic, degrees, p",
    [
        (3.841459, 1, 0.05),
        (5.991465, 2, 0.05),
        (7.814728, 3, 0.05),
        (9.487729, 4, 0.05),
        (11.070498, 5, 0.05),
        (18.307038, 10, 0.05),
        (24.995790, 15, 0.05),
        (6.634897, 1, 0.01),
        (0.0, 3, 1.0),
        (124.342, 100, 0.05),
    ],
)
def test_chi_squared_tail(spark, statistic, degrees, p):
    assert one(spark, stats.chi2_p(F.lit(statistic), F.lit(degrees))) == pytest.approx(p, abs=2e-4 if degrees > 80 else 1e-6)


def test_kolmogorov_tail(spark):
    def p(d, n):
        return one(spark, stats.kolmogorov_p(F.lit(d), F.lit(n), F.lit(n)))

    # 1.3581 is the 5 % point of the limiting distribution.
    assert p(1.358099 / math.sqrt(500), 1000) == pytest.approx(0.05, abs=1e-5)
    assert p(0.0, 100) == 1.0
    assert p(1.0, 100) == pytest.approx(0.0, abs=1e-12)


def pair(spark, n, shift=0.0, values=50):
    rows = [(float(i % values), "a" if i % 2 else "b") for i in range(n)]
    moved = [(v + shift, k) for v, k in rows]
    return tuple(spark.createDataFrame(r, "x double, k string") for r in (rows, moved))


@pytest.mark.parametrize(
    "n, values, numeric_test, category_test",
    [
        (1000, 50, drift.KS, drift.Z_TEST),
        (1001, 50, drift.WASSERSTEIN, drift.JENSEN_SHANNON),
        (1000, 5, drift.CHI2, drift.Z_TEST),
        (1000, 2, drift.Z_TEST, drift.Z_TEST),
        (1001, 5, drift.JENSEN_SHANNON, drift.JENSEN_SHANNON),
    ],
)
def test_choice_of_test(spark, n, values, numeric_test, category_test):
    result = drift.drift_by_column(*pair(spark, n, values=values), ["x"], ["k"])
    rows = {r["feature"]: r for r in result.collect()}
    assert rows["x"]["method"] == numeric_test and rows["k"]["method"] == category_test
    assert not rows["x"]["drifted"] and not rows["k"]["drifted"]


@pytest.mark.parametrize("n", [400, 1500])
def test_shift_is_found(spark, n):
    rows = drift.drift_by_column(*pair(spark, n, shift=25.0), ["x"], ["k"]).collect()
    assert {r["feature"]: r["drifted"] for r in rows} == {"x": True, "k": False}


def test_two_proportions(spark):
    reference = spark.createDataFrame([("a",)] * 300 + [("b",)] * 200, "k string")
    current = spark.createDataFrame([("a",)] * 250 + [("b",)] * 250, "k string")
    pair_frame = drift.tagged_union(reference, current, ["k"])
    row = drift.choose_tests(drift.category_statistics(drift.category_counts(pair_frame, ["k"]))).first()
    z = (0.6 - 0.5) / math.sqrt(0.55 * 0.45 * (2 / 500))
    assert row["method"] == drift.Z_TEST
    assert row["value"] == pytest.approx(math.erfc(abs(z) / math.sqrt(2)), abs=1e-12)


def test_category_unknown_to_the_reference_drifts(spark):
    reference = spark.createDataFrame([("a",)] * 50 + [("b",)] * 50, "k string")
    current = spark.createDataFrame([("a",)] * 50 + [("c",)] * 50, "k string")
    counts = drift.category_counts(drift.tagged_union(reference, current, ["k"]), ["k"])
    row = drift.choose_tests(drift.category_statistics(counts)).first()
    assert row["method"] == drift.CHI2 and row["value"] == 0.0 and row["drifted"]


def test_verdict_counts_and_threshold(spark):
    rows = [(f"c{i}", i < 3, 20) for i in range(9)]
    by_column = spark.createDataFrame(rows, "feature string, drifted boolean, n_cur long")
    at = drift.drift_verdict(by_column, 0.33).first()
    assert (at["drifted_columns"], at["total_columns"], at["drift_detected"]) == (3, 9, True)
    assert at["low_sample"]
    assert not drift.drift_verdict(by_column.where("feature <> 'c0'"), 0.33).first()["drift_detected"]


def test_ranges_do_not_change_results(spark, readings):
    from torqline.sources.readings import drift_projection

    older = drift_projection(readings.where("id < 500"))
    newer = drift_projection(readings.where("id >= 500"))
    plain = drift.drift_by_column(older, newer, ranges=1).withColumn("value", F.round("value", 9))
    ranged = drift.drift_by_column(older, newer, ranges=9).withColumn("value", F.round("value", 9))
    assert sorted(plain.collect()) == sorted(ranged.collect())


def test_chi_squared_tail_at_any_degrees(spark):
    """Against the finite sum (even degrees) and the recurrence in the degrees (odd ones), in logarithms."""

    def tail(x, d):
        h, total = x / 2, math.erfc(math.sqrt(x / 2)) if d % 2 else 0.0
        for j in range(d // 2):
            k = j + (0.5 if d % 2 else 0.0)
            total += math.exp(-h + k * math.log(h) - math.lgamma(k + 1))
        return total

    cases = [(x, d) for d in (1, 2, 3, 79, 80, 81, 82, 200, 333, 2000) for x in (0.5 * d, 1.0 * d, 1.2 * d + 3, 1.5 * d + 9)]
    df = spark.createDataFrame(cases, "x double, d int")
    for r in df.select("x", "d", stats.chi2_p(F.col("x"), F.col("d")).alias("p")).collect():
        assert r["p"] == pytest.approx(min(1.0, tail(r["x"], r["d"])), rel=1e-7, abs=1e-12), r


def test_missing_and_infinite_values_and_an_empty_side(spark):
    inf, nan = float("inf"), float("nan")
    values = [float(i % 50) for i in range(300)] + [inf, -inf, nan, None] * 20
    ref = spark.createDataFrame([(v, 1.0, "a") for v in values], "x double, y double, type string")
    cur = spark.createDataFrame([(v, None, "a") for v in values[::-1]], "x double, y double, type string")
    for ranges in (None, 1, 8):
        got = {r["feature"]: r for r in drift.drift_by_column(ref, cur, ["x", "y"], ["type"], ranges).collect()}
        assert (got["x"]["n_ref"], got["x"]["n_cur"]) == (300, 300) and not got["x"]["drifted"]
        assert got["y"]["value"] is None and got["y"]["drifted"] is False and got["y"]["n_cur"] == 0
    verdict = drift.drift_verdict(drift.drift_by_column(ref, cur.limit(0), ["x", "y"], ["type"])).first()
    assert verdict["low_sample"] and not verdict["drift_detected"] and verdict["total_columns"] == 3


def test_cuts_of_another_partitioning_change_nothing(spark, readings):
    source = rd.drift_projection(readings).withColumn("window", F.lit(1))
    counts = [
        drift.numeric_counts(drift.one_side(source, C.NUMERIC_FEATURES, ref, "window"), C.NUMERIC_FEATURES,
                             {c: [] for c in C.NUMERIC_FEATURES}, by).drop("range")
        for ref, by in ((True, []), (False, ["window"]))
    ]
    kinds = [drift.category_counts(drift.one_side(source, ["type"], ref, "window"), ["type"], by) for ref, by in ((True, []), (False, ["window"]))]
    results = []
    for parts, ranges in ((1, 2), (3, 7), (7, 16)):
        cuts = drift.range_cuts(source.repartition(parts), C.NUMERIC_FEATURES, ranges)
        rows = drift.drift_from_window_counts(counts[0], counts[1], kinds[0], kinds[1], "window", cuts).collect()
        results.append({r["feature"]: round(r["value"], 9) for r in rows})
    assert results[0] == results[1] == results[2]
