"""Running sums over ranges against plain Python, with hot values and many ranges."""

from __future__ import annotations

from itertools import accumulate

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from torqline.operators import metrics
from torqline.operators.prefix import dense_sequence, range_cuts, running_sums, with_range

SLOW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SLOW
@given(ids=st.sets(st.integers(-(2**40), 2**40), min_size=1, max_size=60), ranges=st.integers(1, 7))
def test_sequence_is_dense_and_ordered(spark, ids, ranges):
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    rows = dense_sequence(df, "id", "udi", start=101, ranges=ranges).collect()
    assert {r["id"]: r["udi"] for r in rows} == {i: 101 + n for n, i in enumerate(sorted(ids))}


@SLOW
@given(
    values=st.dictionaries(st.integers(0, 200), st.integers(0, 1000), min_size=1, max_size=50),
    ranges=st.integers(1, 9),
)
def test_running_sums(spark, values, ranges):
    df = spark.createDataFrame([(float(v), n) for v, n in values.items()], "value double, n long")
    cuts = range_cuts(df, ["value"], ranges)["value"]
    summed = running_sums(with_range(df, "value", cuts, "range"), "value", {"cum": "n"}, "range")
    rows = sorted(summed.collect(), key=lambda r: r["value"])
    order = sorted(values)
    assert [r["cum"] for r in rows] == list(accumulate(values[v] for v in order))
    assert [r["next_value"] for r in rows] == [float(v) for v in order[1:]] + [None]
    assert {r["total_cum"] for r in rows} == {sum(values.values())}


def test_hot_value_takes_one_range_and_the_rest_stay_balanced(spark):
    df = spark.sql("SELECT CASE WHEN id % 3 = 0 THEN 500.0D ELSE CAST(id AS DOUBLE) END AS v FROM range(3000)")
    cuts = range_cuts(df, ["v"], 10)["v"]
    assert len(cuts) == len(set(cuts)) <= 9
    sizes = with_range(df.distinct(), "v", cuts, "range").groupBy("range").count().collect()
    assert max(r["count"] for r in sizes) < 1000


@SLOW
@given(
    rows=st.lists(st.tuples(st.integers(0, 1), st.integers(0, 12)), min_size=2, max_size=60),
    ranges=st.integers(1, 5),
)
def test_auc_equals_pair_counting(spark, rows, ranges):
    df = spark.createDataFrame([(label, score / 12) for label, score in rows], "label int, score double")
    got = metrics.roc_auc(df, ranges=ranges).first()[0]
    positives = [s for label, s in rows if label]
    negatives = [s for label, s in rows if not label]
    if not positives or not negatives:
        assert got is None
        return
    wins = sum((p > n) + 0.5 * (p == n) for p in positives for n in negatives)
    assert abs(got - wins / (len(positives) * len(negatives))) < 1e-12
