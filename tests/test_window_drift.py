"""Drift per window by look-ups in an index of the reference, against plain arithmetic."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from torqline import config as C
from torqline.operators import drift, etl
from torqline.operators.prefix import last_before, with_range


def brute(reference, current):
    """Largest gap, area between the curves by the spread, Jensen-Shannon distance and chi-squared of two samples."""
    grid = np.unique(np.concatenate([reference, current]))
    f = np.searchsorted(np.sort(reference), grid, side="right") / len(reference)
    g = np.searchsorted(np.sort(current), grid, side="right") / len(current)
    p = np.array([(reference == x).mean() for x in grid])
    q = np.array([(current == x).mean() for x in grid])
    middle = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        js = (np.where(p > 0, p * np.log(p / middle), 0) + np.where(q > 0, q * np.log(q / middle), 0)).sum() / 2
        chi2 = math.inf if (p == 0).any() else ((q - p) ** 2 / p).sum() * len(current)
    area = (np.abs(f - g)[:-1] * np.diff(grid)).sum()
    norm = max(np.std(reference), C.WASSERSTEIN_NORM_FLOOR)
    return np.abs(f - g).max(), area / norm, math.sqrt(max(js, 0)), chi2, len(grid)


def statistics(reference, current, ranges, monkeypatch):
    """What is handed to the choice of tests, per window and feature."""
    with monkeypatch.context() as patch:
        patch.setattr(drift, "choose_tests", lambda rows, by: rows)
        found = drift.drift_by_window(reference, current, "day", ["x", "y"], ["kind"], ranges).collect()
    return {(r["day"], r["feature"]): r for r in found}


@pytest.mark.parametrize(("size", "values", "ranges"), [(40, 6, 1), (300, 40, 5), (5000, 100_000, 7)])
def test_windows_match_plain_arithmetic(spark, monkeypatch, size, values, ranges):
    rng = np.random.default_rng(size)
    ref = [(float(rng.integers(values)), 3.5, "abc"[rng.integers(3)]) for _ in range(size)]
    cur = []
    for day in range(9):
        shift = [0, 0, values // 3, -values, 2 * values, 0.25, 0, 0, 0][day]
        for _ in range(1 if day == 7 else 5 + 20 * day):
            cur.append((day, float(rng.integers(values)) + shift, 3.5 if day < 6 else 3.5 + day, "abcd"[rng.integers(4 if day == 8 else 3)]))
    cur += [(9, math.nan, None, "a"), (9, math.inf, None, None), (None, 1.0, 1.0, "a")]
    schema = "x double, y double, kind string"
    got = statistics(spark.createDataFrame(ref, schema), spark.createDataFrame(cur, f"day int, {schema}"), ranges, monkeypatch)
    assert set(got) == {(day, name) for day in range(10) for name in ("x", "y", "kind")}
    for day in range(9):
        for k, name in ((0, "x"), (1, "y"), (2, "kind")):
            r, a, b = got[day, name], np.array([row[k] for row in ref]), np.array([row[k + 1] for row in cur if row[0] == day])
            number = {v: i for i, v in enumerate(sorted({*a.tolist(), *b.tolist()}))}
            if name == "kind":
                plain = brute(np.array([number[v] for v in a.tolist()], float), np.array([number[v] for v in b.tolist()], float))
            else:
                plain = brute(a, b)
                assert r["ks"] == pytest.approx(plain[0], abs=1e-12)
                assert r["wasserstein"] == pytest.approx(plain[1], rel=1e-9, abs=1e-9)
            assert r["js"] == pytest.approx(plain[2], abs=1e-7)
            assert r["chi2"] == pytest.approx(plain[3], rel=1e-9, abs=1e-9)
            assert (r["n_values"], r["n_ref"], r["n_cur"]) == (plain[4], len(a), len(b))
            top = max(number, key=number.get)
            assert (r["p_ref"], r["p_cur"]) == pytest.approx(((a == top).mean(), (b == top).mean()))
    assert [got[9, n]["n_cur"] for n in ("x", "y", "kind")] == [0, 0, 1]


def test_the_reference_is_not_repeated_for_windows(spark, monkeypatch):
    """A reference of 200,000 values and 40 windows of 20: rows in the plan follow the sum, not the product."""
    ref = spark.range(200_000).select((F.col("id") * 0.5).alias("x"), F.lit("a").alias("kind"))
    cur = spark.range(800).select((F.col("id") % 40).alias("day"), (F.col("id") * 125.25).alias("x"), F.lit("a").alias("kind"))
    found = drift.drift_by_window(ref, cur, "day", ["x"], ["kind"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "collect_set" not in plan and "CartesianProduct" not in plan
    rows = {(r["day"], r["feature"]): r for r in found.collect()}
    assert len(rows) == 80 and {r["n_ref"] for r in rows.values()} == {200_000}
    a = np.arange(200_000) * 0.5
    for day in (0, 39):
        b = np.arange(day, 800, 40) * 125.25
        grid = np.unique(np.concatenate([a, b]))
        gap = np.abs(np.searchsorted(a, grid, side="right") / len(a) - np.searchsorted(b, grid, side="right") / len(b))
        assert rows[day, "x"]["value"] == pytest.approx((gap[:-1] * np.diff(grid)).sum() / np.std(a), rel=1e-9)


@pytest.mark.parametrize("cuts", [[], [10.0], [5.0, 10.0, 20.0, 90.0]])
def test_last_before(spark, cuts):
    rng = np.random.default_rng(4)
    index = sorted({(k, float(v)) for k in "ab" for v in rng.integers(20, 70, 15)})
    asked = [(k, float(v), i) for i, (k, v) in enumerate((k, v) for k in "abc" for v in rng.integers(0, 100, 40))]
    left = spark.createDataFrame([(*r, f"{r[0]}{r[1]}") for r in index], "k string, v double, name string")
    right = spark.createDataFrame(asked, "k string, v double, i long")
    left, right = (with_range(df, "v", cuts, "part") for df in (left, right))
    got = last_before(left, right, ["k"], "v", "part", ["name"], (-1, len(cuts))).collect()
    assert len(got) == len(asked)
    for r in got:
        before = [v for k, v in index if k == r["k"] and v <= r["v"]]
        assert r["name"] == (f"{r['k']}{max(before)}" if before else None)


@pytest.mark.parametrize("spread", [1, 10**6, 10**14])
def test_newest_rows_read_little_more_than_they_return(spark, tmp_path, spread):
    """Also with one key far ahead of all others, and with ties at the cut."""
    path = str(tmp_path / "t")
    key = F.when(F.col("id") == 7, F.lit(9 * 10**18)).otherwise(F.floor(F.col("id") / 3).cast("long") * spread)
    table = spark.range(60_000).select(key.alias("UDI"), "id", F.when(F.col("id") % 5 > 0, F.timestamp_micros(F.col("id") * 10**6)).alias("at"))
    table.repartition(6).write.parquet(path)
    table = spark.read.parquet(path)
    for rows, name in ((1, "UDI"), (500, "UDI"), (500, "at"), (47_999, "at")):
        newest = etl.newest_rows(table, rows, name, "id")
        plan = newest._jdf.queryExecution().executedPlan().toString()
        assert f"GreaterThanOrEqual({name}" in plan
        cut = etl.newest_cut(table, rows, name)
        assert rows <= table.where(cut).count() <= 2 * rows + 3
        expected = table.orderBy(F.desc(name), F.desc("id")).limit(rows)
        assert [r["id"] for r in newest.select("id").collect()] == [r["id"] for r in expected.select("id").collect()]
    assert etl.newest_cut(table, 60_000, "UDI") is None and etl.newest_rows(table, 60_000, "at").count() == 60_000
    assert etl.newest_rows(table.where("id < 0"), 5, "UDI").count() == 0


def test_newest_rows_of_clock_times(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5000).select(F.timestamp_micros(F.col("id") * 7_000_001).cast("timestamp_ntz").alias("at"), "id").write.parquet(path)
    newest = etl.newest_rows(spark.read.parquet(path), 50, "at")
    assert "GreaterThanOrEqual(at" in newest._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["id"] for r in newest.collect()) == list(range(4950, 5000))
