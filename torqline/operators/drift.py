"""Distribution drift between a reference and a current sample.

All numeric features go through one unpivot and one shuffle into counts per distinct value;
every statistic of every feature then comes from one aggregate over those counts.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from torqline import config as C
from torqline.functions.stats import chi2_p, kolmogorov_p, normal_two_sided_p
from torqline.operators.prefix import finite, last_before, range_cuts, running_sums, with_ranges, written

KS, CHI2, Z_TEST = "K-S p_value", "chi-square p_value", "Z-test p_value"
WASSERSTEIN, JENSEN_SHANNON = "Wasserstein distance (normed)", "Jensen-Shannon distance"
# Statistics that categories do not have.
_NUMBERS_ONLY = ["ks", "distance", "std_ref", "wasserstein"]


def tagged_union(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """Both samples in one frame; ``is_ref`` and ``is_cur`` are 0/1 so that sums count a side."""
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    left = reference.select(*columns, one.alias("is_ref"), zero.alias("is_cur"))
    right = current.select(*columns, zero.alias("is_ref"), one.alias("is_cur"))
    return left.unionByName(right)


def numeric_counts(
    pair: DataFrame, columns: list[str], cuts: dict[str, list[float]], by: list[str] | None = None
) -> DataFrame:
    """feature, range, value, n_ref, n_cur: one row per distinct finite value of a feature.

    NaN and the infinities count as missing.
    """
    by = by or []
    ranged = with_ranges(pair, {name: cuts[name] for name in columns}, {name: f"__range_{name}" for name in columns})
    # Numbers instead of names while rows are many: shorter keys to hash and to shuffle.
    cells = [
        F.struct(
            F.lit(number).alias("code"),
            F.col(f"__range_{name}").alias("range"),
            finite(F.col(name)).alias("value"),
        )
        for number, name in enumerate(columns)
    ]
    counts = (
        ranged.select("is_ref", "is_cur", *by, F.inline(F.array(*cells)))
        .where(F.col("value").isNotNull())
        .groupBy(*by, "code", "range", "value")
        .agg(F.sum("is_ref").alias("n_ref"), F.sum("is_cur").alias("n_cur"))
    )
    names = F.array(*[F.lit(name) for name in columns])
    return counts.select(*by, names[F.col("code")].alias("feature"), "range", "value", "n_ref", "n_cur")


def category_counts(pair: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """feature, category, n_ref, n_cur."""
    by = by or []
    cells = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category")) for c in columns]
    return (
        pair.select("is_ref", "is_cur", *by, F.inline(F.array(*cells)))
        .where(F.col("category").isNotNull())
        .groupBy(*by, "feature", "category")
        .agg(F.sum("is_ref").alias("n_ref"), F.sum("is_cur").alias("n_cur"))
    )


def paired_ecdf(
    reference: DataFrame,
    current: DataFrame,
    columns: list[str] = C.NUMERIC_FEATURES,
    ranges: int | None = None,
) -> DataFrame:
    """Counts and running counts of both samples at every distinct value of every feature.

    ``total_*`` are the group sizes, ``next_value`` the following distinct value and
    ``weighted_ref`` the sum of the reference values.
    """
    pair = tagged_union(reference, current, columns)
    return ecdf_from_counts(numeric_counts(pair, columns, range_cuts(pair, columns, ranges)))


def ecdf_from_counts(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    return running_sums(
        counts,
        "value",
        {"cum_ref": "n_ref", "cum_cur": "n_cur"},
        "range",
        by=[*(by or []), "feature"],
        overall={"weighted_ref": F.col("value") * F.col("n_ref")},
    )


def _share_terms(p: Column, q: Column) -> Column:
    """Jensen-Shannon contribution of one category with shares p and q."""
    middle = (p + q) / 2.0
    left = F.when(p > 0, p * F.ln(p / middle)).otherwise(F.lit(0.0))
    right = F.when(q > 0, q * F.ln(q / middle)).otherwise(F.lit(0.0))
    return (left + right) / 2.0


def _chi2_terms(n_ref: Column, n_cur: Column, total_ref: Column, total_cur: Column) -> Column:
    """Goodness-of-fit contribution; a category the reference never showed is infinitely unlikely."""
    expected = n_ref.cast("double") / F.nullif(total_ref, F.lit(0)) * total_cur
    return F.when(n_ref == 0, F.when(n_cur == 0, F.lit(0.0)).otherwise(F.lit(float("inf")))).otherwise(
        (n_cur - expected) * (n_cur - expected) / F.nullif(expected, F.lit(0.0))
    )


def _count_statistics(total_ref: Column, total_cur: Column) -> dict[str, Column]:
    """Statistics that only look at counts per distinct value or category."""
    p, q = F.col("n_ref") / F.nullif(total_ref, F.lit(0)), F.col("n_cur") / F.nullif(total_cur, F.lit(0))
    return {
        "js": F.sqrt(F.greatest(F.sum(_share_terms(p, q)), F.lit(0.0))),
        "chi2": F.sum(_chi2_terms(F.col("n_ref"), F.col("n_cur"), total_ref, total_cur)),
        "n_values": F.count(F.lit(1)),
        "n_ref": F.sum("n_ref"),
        "n_cur": F.sum("n_cur"),
        # Share of one of two values on each side, for the two-proportion test.
        "p_ref": F.max_by(p, F.col("order_key")),
        "p_cur": F.max_by(q, F.col("order_key")),
    }


def numeric_statistics(ecdf: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One row per numeric feature with every statistic a test may need."""
    by = by or []
    total_ref, total_cur = F.col("total_cum_ref"), F.col("total_cum_cur")
    # A side without a usable value has no distribution: what compares with it is null.
    no_ref, no_cur = F.nullif(total_ref, F.lit(0)), F.nullif(total_cur, F.lit(0))
    gap = F.abs(F.col("cum_ref") / no_ref - F.col("cum_cur") / no_cur)
    width = F.coalesce(F.col("next_value") - F.col("value"), F.lit(0.0))
    mean = F.col("weighted_ref") / no_ref
    spread = F.sum(F.col("n_ref") * (F.col("value") - mean) * (F.col("value") - mean)) / F.nullif(
        F.sum("n_ref"), F.lit(0)
    )
    stats = (
        ecdf.withColumn("order_key", F.col("value"))
        .groupBy(*by, "feature")
        .agg(
            F.max(gap).alias("ks"),
            F.sum(gap * width).alias("distance"),
            F.sqrt(spread).alias("std_ref"),
            *[column.alias(name) for name, column in _count_statistics(total_ref, total_cur).items()],
        )
    )
    norm = F.greatest(F.col("std_ref"), F.lit(C.WASSERSTEIN_NORM_FLOOR))
    return stats.withColumn("wasserstein", F.col("distance") / norm).withColumn("numeric", F.lit(True))


def category_statistics(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    keys = [*(by or []), "feature"]
    # A second small aggregate gives the group sizes: a handful of categories per feature.
    totals = counts.groupBy(*keys).agg(F.sum("n_ref").alias("total_ref"), F.sum("n_cur").alias("total_cur"))
    return (
        counts.join(totals, keys)
        .withColumn("order_key", F.col("category"))
        .groupBy(*keys)
        .agg(*[c.alias(name) for name, c in _count_statistics(F.col("total_ref"), F.col("total_cur")).items()])
        .withColumns({name: F.lit(None).cast("double") for name in _NUMBERS_ONLY})
        .withColumn("numeric", F.lit(False))
    )


def _pooled_z() -> Column:
    n_ref, n_cur = F.col("n_ref").cast("double"), F.col("n_cur").cast("double")
    zero = F.lit(0.0)
    pooled = (F.col("p_ref") * n_ref + F.col("p_cur") * n_cur) / F.nullif(n_ref + n_cur, zero)
    error = F.sqrt(pooled * (1.0 - pooled) * (1.0 / F.nullif(n_ref, zero) + 1.0 / F.nullif(n_cur, zero)))
    return F.coalesce((F.col("p_ref") - F.col("p_cur")) / F.nullif(error, F.lit(0.0)), F.lit(0.0))


def choose_tests(statistics: DataFrame, by: list[str] | None = None) -> DataFrame:
    """feature, method, value, threshold, drifted.

    Small references get p-value tests, larger ones distances. Numeric features with few
    distinct values are compared like categories. Where a side has no usable value, ``value`` is null and
    nothing drifted: the small-sample flag of the verdict tells.
    """
    small = F.col("n_ref") <= C.SMALL_REFERENCE
    as_numbers = F.col("numeric") & (F.col("n_values") > C.FEW_VALUES)
    method = (
        F.when(as_numbers & small, F.lit(KS))
        .when(as_numbers, F.lit(WASSERSTEIN))
        .when(small & (F.col("n_values") <= 2), F.lit(Z_TEST))
        .when(small, F.lit(CHI2))
        .otherwise(F.lit(JENSEN_SHANNON))
    )
    value = (
        F.when((F.col("n_ref") == 0) | (F.col("n_cur") == 0), F.lit(None).cast("double"))
        .when(F.col("method") == KS, kolmogorov_p(F.col("ks"), F.col("n_ref"), F.col("n_cur")))
        .when(F.col("method") == WASSERSTEIN, F.col("wasserstein"))
        .when(F.col("method") == Z_TEST, normal_two_sided_p(_pooled_z()))
        .when(F.col("method") == CHI2, chi2_p(F.col("chi2"), F.col("n_values") - 1))
        .otherwise(F.col("js"))
    )
    distance = F.col("method").contains("distance")
    threshold = F.when(distance, F.lit(C.DISTANCE_THRESHOLD)).otherwise(F.lit(C.P_VALUE_THRESHOLD))
    drifted = F.when(distance, F.col("value") > F.col("threshold")).otherwise(F.col("value") < F.col("threshold"))
    return (
        statistics.withColumn("method", method)
        .withColumn("value", value)
        .withColumn("threshold", threshold)
        .withColumn("drifted", F.coalesce(drifted, F.lit(False)))
        .select(*(by or []), "feature", "method", "value", "threshold", "drifted", "n_ref", "n_cur")
    )


def drift_statistics(
    reference: DataFrame,
    current: DataFrame,
    numeric: list[str] = C.NUMERIC_FEATURES,
    categorical: list[str] = ("type",),
    ranges: int | None = None,
) -> DataFrame:
    numeric, categorical = list(numeric), list(categorical)
    parts = []
    if numeric:
        parts.append(numeric_statistics(paired_ecdf(reference, current, numeric, ranges)))
    if categorical:
        pair = tagged_union(reference, current, categorical)
        parts.append(category_statistics(category_counts(pair, categorical)))
    return reduce(DataFrame.unionByName, parts)


def drift_by_column(
    reference: DataFrame,
    current: DataFrame,
    numeric: list[str] = C.NUMERIC_FEATURES,
    categorical: list[str] = ("type",),
    ranges: int | None = None,
) -> DataFrame:
    return choose_tests(drift_statistics(reference, current, numeric, categorical, ranges))


def drift_from_counts(numbers: DataFrame, categories: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """Per-column drift from counts of values and categories, as kept batch by batch: counts of one value add up.

    ``cuts`` name the numeric features and only spread the work.
    """
    sums = [F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur")]
    values = value_range(numbers.groupBy("feature", "value").agg(*sums), cuts)
    kinds = categories.groupBy("feature", "category").agg(*sums)
    return choose_tests(numeric_statistics(ecdf_from_counts(values)).unionByName(category_statistics(kinds)))


def drift_by_window(
    reference: DataFrame,
    current: DataFrame,
    window: str,
    numeric: list[str] = C.NUMERIC_FEATURES,
    categorical: list[str] = ("type",),
    ranges: int | None = None,
) -> DataFrame:
    """Per-column drift of every window of ``current`` against one frozen reference."""
    numeric, categorical = list(numeric), list(categorical)
    cuts, whole = range_cuts(current, numeric, ranges), {name: [] for name in numeric}
    return drift_from_window_counts(
        numeric_counts(one_side(reference, numeric, ref=True), numeric, whole).drop("range"),
        numeric_counts(one_side(current, numeric, False, window), numeric, whole, [window]).drop("range"),
        category_counts(one_side(reference, categorical, ref=True), categorical),
        category_counts(one_side(current, categorical, False, window), categorical, [window]),
        window,
        cuts,
        categorical,
        current,
    )


def value_range(counts: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """Adds ``range``, the place of ``value`` among the cuts of its feature."""
    values = {f"__value_{n}": F.when(F.col("feature") == name, F.col("value")) for n, name in enumerate(cuts)}
    places = {f"__value_{n}": f"__place_{n}" for n in range(len(cuts))}
    ranged = with_ranges(counts.withColumns(values), dict(zip(values, cuts.values())), places)
    own = [F.when(F.col("feature") == name, F.col(f"__place_{n}")) for n, name in enumerate(cuts)]
    return ranged.select(*counts.columns, F.coalesce(*own, F.lit(0)).alias("range"))


def one_side(df: DataFrame, columns: list[str], ref: bool, *extra: str) -> DataFrame:
    flag = F.lit(int(ref)).cast("long")
    return df.select(*columns, *extra, flag.alias("is_ref"), (1 - flag).alias("is_cur"))


def reference_index(counts: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """The empirical distribution of every feature of a reference, with prefix integrals, one row per distinct value.

    ``below`` is the share of the reference up to ``value`` and ``before`` that below it; ``moment`` sums value times
    share up to it, so that the integral of the distribution function up to any x whose last entry this is is
    ``below * x - moment``. ``total`` counts the feature's rows. Ranges are those of ``cuts``.
    """
    ranged = value_range(counts.select("feature", "value", "n_ref"), cuts).withColumn("part", F.col("value") * F.col("n_ref"))
    sums = running_sums(ranged, "value", {"cum": "n_ref", "partial": "part"}, "range", by=["feature"])
    total = F.col("total_cum")
    return sums.select(
        "feature",
        "range",
        "value",
        F.col("value").alias("at"),
        F.col("n_ref").alias("here"),
        ((F.col("cum") - F.col("n_ref")) / total).alias("before"),
        (F.col("cum") / total).alias("below"),
        (F.col("partial") / total).alias("moment"),
        total.alias("total"),
    )


def _index_totals(index: DataFrame) -> DataFrame:
    """One row per feature: size, distinct values, spread and the largest value with its share."""
    share = F.col("here") / F.col("total")
    mean = index.groupBy("feature").agg(F.sum(F.col("at") * share).alias("mean"))
    off = F.col("at") - F.col("mean")
    return (
        index.join(F.broadcast(mean), "feature")
        .groupBy("feature")
        .agg(
            F.sum("here").alias("total_ref"),
            F.count(F.lit(1)).alias("values_ref"),
            F.sqrt(F.sum(off * off * share)).alias("std_ref"),
            F.max("at").alias("top_ref"),
            F.max_by(share, F.col("at")).alias("p_top"),
        )
    )


def _seen(once: Column) -> dict[str, Column]:
    """What the values that a window has contribute; ``once`` marks one row of each."""
    total_ref, total_cur = F.col("total_ref"), F.col("total_cur")
    p, q = F.col("n_ref") / F.nullif(total_ref, F.lit(0)), F.col("n_cur") / F.nullif(total_cur, F.lit(0))
    top = F.struct(F.col("order_key").alias("key"), p.alias("p"), q.alias("q"))
    return {
        "js_seen": F.sum(F.when(once, _share_terms(p, q))),
        "chi2_seen": F.sum(F.when(once, _chi2_terms(F.col("n_ref"), F.col("n_cur"), total_ref, total_cur))),
        "met": F.sum(F.when(once, F.col("n_ref"))),
        "fresh": F.sum(F.when(once & (F.col("n_ref") == 0), 1)),
        "n_cur": F.sum(F.when(once, F.col("n_cur"))),
        "top": F.max(F.when(once, top)),
    }


def _with_unseen(seen: DataFrame, windows: DataFrame, window: str, totals: DataFrame, features: list[str]) -> DataFrame:
    """Statistics of every window and feature: what was seen, and the rest of the reference in closed form."""
    every = windows.select(window, F.explode(F.array(*[F.lit(name) for name in features])).alias("feature"))
    rows = every.join(F.broadcast(totals), "feature", "left").join(seen, [window, "feature"], "left")
    zero = F.lit(0).cast("long")
    total, n_cur = F.coalesce("total_ref", zero), F.coalesce("n_cur", zero)
    # Reference rows whose values the window never shows: each adds the same per row.
    unmet = (total - F.coalesce("met", zero)) / F.nullif(total, F.lit(0))
    alone = F.col("top").isNull() | (F.col("top_ref") > F.col("top.key"))
    return rows.withColumns(
        {
            "js": F.sqrt(F.greatest(F.coalesce("js_seen", F.lit(0.0)) + F.coalesce(unmet, F.lit(0.0)) * (math.log(2) / 2), F.lit(0.0))),
            "chi2": F.coalesce("chi2_seen", F.lit(0.0)) + n_cur * unmet,
            "n_values": F.coalesce("values_ref", zero) + F.coalesce("fresh", zero),
            "n_ref": total,
            "n_cur": n_cur,
            "p_ref": F.when(alone, F.col("p_top")).otherwise(F.col("top.p")),
            "p_cur": F.when(alone, F.lit(0.0)).otherwise(F.col("top.q")),
        }
    ).drop("total_ref", "values_ref", "top_ref", "p_top", "js_seen", "chi2_seen", "met", "fresh", "top")


def _window_numbers(
    index: DataFrame, totals: DataFrame, current: DataFrame, window: str, cuts: dict[str, list[float]]
) -> DataFrame:
    """Per window and feature, from its own values: what ``_seen`` counts, the largest gap and the area between the curves.

    Between two values of a window its share c is constant, and the reference's F crosses it at most once, at x(c). With
    S(v, c) the area between F and c from x(c) to v, negative before x(c), the area between the curves is the sum over
    the values v of S(v, c before v) - S(v, c). So a value needs F up to v, from the index by value, and the crossings of
    two shares, from the index by share.
    """
    by = [window, "feature"]
    counts = current.groupBy(*by, "value").agg(F.sum("n_cur").alias("n_cur"))
    own = running_sums(value_range(counts, cuts), "value", {"cum": "n_cur"}, "range", by=by)
    own = own.select(*by, "range", "value", "n_cur", "cum", F.col("total_cum").alias("total_cur"))
    parts = 1 + max(map(len, cuts.values()), default=0)
    entry = ["at", "here", "before", "below", "moment"]
    found = last_before(index, own, ["feature"], "value", "range", entry, (-1, parts - 1))
    met = F.coalesce(F.col("at") == F.col("value"), F.lit(False))
    zero = F.lit(0.0)
    found = found.join(F.broadcast(totals.select("feature", "total_ref")), "feature", "left").select(
        *by,
        "value",
        "n_cur",
        "total_cur",
        "total_ref",
        F.when(met, F.col("here")).otherwise(F.lit(0).cast("long")).alias("n_ref"),
        ((F.col("cum") - F.col("n_cur")) / F.col("total_cur")).alias("c_before"),
        (F.col("cum") / F.col("total_cur")).alias("c"),
        F.coalesce(F.when(met, F.col("before")).otherwise(F.col("below")), zero).alias("f_before"),
        F.coalesce("below", zero).alias("f"),
        F.coalesce(F.col("below") * F.col("value") - F.col("moment"), zero).alias("area"),
    )
    sides = F.array(
        F.struct(F.lit(True).alias("once"), F.col("c_before").alias("share")),
        F.struct(F.lit(False).alias("once"), F.col("c").alias("share")),
    )
    # The first entry whose share reaches c is the last one at or before -c on the axis turned round.
    turned = lambda share: {"axis": -share, "part": F.floor(-share * parts).cast("int")}
    events = found.select("*", F.inline(sides)).withColumns(turned(F.col("share")))
    by_share = index.withColumns(turned(F.col("below"))).select(
        "feature", "axis", "part", F.col("at").alias("x"), F.col("below").alias("f_x"), F.col("moment").alias("m_x")
    )
    crossed = last_before(by_share, events, ["feature"], "axis", "part", ["x", "f_x", "m_x"], (-parts, 0))
    value, x, share = F.col("value"), F.col("x"), F.col("share")
    inner = share * (x - value) - (F.col("f_x") * x - F.col("m_x") - F.col("area"))
    area = F.when(value >= x, inner).otherwise(-inner)
    gap = F.greatest(F.abs(F.col("f") - F.col("c")), F.abs(F.col("f_before") - F.col("c_before")))
    return (
        crossed.withColumn("order_key", value)
        .groupBy(*by)
        .agg(
            F.max(gap).alias("ks"),
            F.sum(F.when(F.col("once"), area).otherwise(-area)).alias("distance"),
            *[column.alias(name) for name, column in _seen(F.col("once")).items()],
        )
    )


def _window_categories(reference: DataFrame, totals: DataFrame, current: DataFrame, window: str) -> DataFrame:
    by = [window, "feature"]
    counts = current.groupBy(*by, "category").agg(F.sum("n_cur").alias("n_cur"))
    sums = counts.groupBy(*by).agg(F.sum("n_cur").alias("total_cur"))
    rows = counts.join(sums, by).join(reference.select("feature", "category", "n_ref"), ["feature", "category"], "left")
    rows = rows.join(F.broadcast(totals.select("feature", "total_ref")), "feature", "left")
    rows = rows.withColumns({"n_ref": F.coalesce("n_ref", F.lit(0).cast("long")), "order_key": F.col("category")})
    return rows.groupBy(*by).agg(*[column.alias(name) for name, column in _seen(F.lit(True)).items()])


def drift_from_window_counts(
    ref_numbers: DataFrame,
    cur_numbers: DataFrame,
    ref_categories: DataFrame,
    cur_categories: DataFrame,
    window: str,
    cuts: dict[str, list[float]],
    categorical: list[str] = ("type",),
    windows: DataFrame | None = None,
) -> DataFrame:
    """Drift per window from counts, as kept by a stream or computed in a batch.

    Counts are kept by value alone; ``cuts`` only spread the work and may differ from call to call. The reference is
    indexed once; a window looks up its own values in it, so the work grows with the reference plus the values of all
    windows, not with their product. A window without a usable value of a feature has a row for it all the same;
    ``windows`` names them, else those of the counts are taken.
    """
    index = written(reference_index(ref_numbers, cuts), "reference-index")
    totals = _index_totals(index)
    if windows is None:
        windows = cur_numbers.select(window).unionByName(cur_categories.select(window))
    windows = windows.select(window).where(F.col(window).isNotNull()).distinct()
    seen = _window_numbers(index, totals, cur_numbers, window, cuts)
    numbers = _with_unseen(seen, windows, window, totals, list(cuts))
    norm = F.greatest(F.col("std_ref"), F.lit(C.WASSERSTEIN_NORM_FLOOR))
    numbers = numbers.withColumn("wasserstein", F.col("distance") / norm).withColumn("numeric", F.lit(True))
    kinds = ref_categories.groupBy("feature", "category").agg(F.sum("n_ref").alias("n_ref"))
    sums = kinds.groupBy("feature").agg(
        F.sum("n_ref").alias("total_ref"),
        F.count(F.lit(1)).alias("values_ref"),
        F.max("category").alias("top_ref"),
        (F.max_by("n_ref", "category") / F.sum("n_ref")).alias("p_top"),
    )
    categories = _with_unseen(_window_categories(kinds, sums, cur_categories, window), windows, window, sums, list(categorical))
    categories = categories.withColumns({name: F.lit(None).cast("double") for name in _NUMBERS_ONLY})
    return choose_tests(numbers.unionByName(categories.withColumn("numeric", F.lit(False))), [window])


def drift_verdict(by_column: DataFrame, threshold: float = C.DRIFT_SHARE_THRESHOLD) -> DataFrame:
    """One row: drifted columns, their share of all columns, and the verdict."""
    flag = F.col("drifted").cast("int")
    share = F.avg(flag)
    return by_column.agg(
        F.sum(flag).cast("long").alias("drifted_columns"),
        F.count(F.lit(1)).alias("total_columns"),
        share.alias("drift_share"),
        (share >= F.lit(threshold)).alias("drift_detected"),
        (F.coalesce(F.max("n_cur"), F.lit(0)) < C.MIN_SAMPLE).alias("low_sample"),
    )


def histograms(
    reference: DataFrame,
    current: DataFrame,
    columns: list[str] = C.NUMERIC_FEATURES,
    bins: int = C.HISTOGRAM_BINS,
) -> DataFrame:
    """Side-by-side equal-width histograms over the joint range of both samples."""
    pair = tagged_union(reference, current, columns)
    cells = [F.struct(F.lit(c).alias("feature"), finite(F.col(c)).alias("value")) for c in columns]
    long = pair.select("is_ref", "is_cur", F.inline(F.array(*cells))).where(F.col("value").isNotNull())
    # One row per feature, whatever the input size: safe to broadcast.
    edges = long.groupBy("feature").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    position = F.floor((F.col("value") - F.col("low")) / F.nullif(F.col("high") - F.col("low"), F.lit(0.0)) * bins)
    # The joint maximum belongs to the last bin; a constant feature has one bin.
    number = F.least(F.coalesce(position, F.lit(0)), F.lit(bins - 1)).cast("long")
    counted = (
        long.join(F.broadcast(edges), "feature")
        .withColumn("bin", number)
        .groupBy("feature", "bin", "low", "high")
        .agg(F.sum("is_ref").alias("n_ref"), F.sum("is_cur").alias("n_cur"))
    )
    width = (F.col("high") - F.col("low")) / F.lit(float(bins))
    return counted.select(
        "feature",
        "bin",
        (F.col("low") + F.col("bin") * width).alias("bin_start"),
        (F.col("low") + (F.col("bin") + 1) * width).alias("bin_end"),
        "n_ref",
        "n_cur",
    )


def numeric_summary(df: DataFrame, columns: list[str] = C.NUMERIC_FEATURES, ranges: int | None = None) -> DataFrame:
    """Count, nulls, distinct values, moments and exact quartiles of numeric columns.

    Moments and quartiles both come from the counts per distinct value, so the raw rows are
    shuffled (after map-side combining) once for all columns.
    """
    empty = df.limit(0)
    ecdf = paired_ecdf(df, empty, columns, ranges)
    n, value = F.col("n_ref"), F.col("value")
    total = F.col("total_cum_ref")
    mean = F.col("weighted_ref") / total

    def quartile(share: float) -> Column:
        return F.min(F.when(F.col("cum_ref") >= F.ceil(total * F.lit(share)), value))

    stats = ecdf.groupBy("feature").agg(
        F.sum("n_ref").alias("rows"),
        F.count(F.lit(1)).alias("distinct_values"),
        F.first(mean).alias("mean"),
        F.sqrt(F.sum(n * (value - mean) * (value - mean)) / F.nullif(F.sum("n_ref") - 1, F.lit(0))).alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        quartile(0.25).alias("p25"),
        quartile(0.5).alias("p50"),
        quartile(0.75).alias("p75"),
    )
    missing = df.agg(
        *[F.sum(finite(F.col(c)).isNull().cast("long")).alias(c) for c in columns]
    ).unpivot([], columns, "feature", "nulls")
    return stats.join(missing, "feature", "right")


def category_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, nulls, distinct values and most frequent value (the smallest on ties)."""
    cells = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category")) for c in columns]
    counts = df.select(F.inline(F.array(*cells))).groupBy("feature", "category").agg(F.count(F.lit(1)).alias("n"))
    present = F.col("category").isNotNull()
    return counts.groupBy("feature").agg(
        F.sum(F.when(present, F.col("n")).otherwise(0)).alias("rows"),
        F.sum(F.when(~present, F.col("n")).otherwise(0)).alias("nulls"),
        F.count("category").alias("distinct_values"),
        F.min(F.when(present, F.struct(-F.col("n"), F.col("category"))))["category"].alias("most_frequent"),
    )


def drift_report(reference: DataFrame, current: DataFrame, ranges: int | None = None) -> dict[str, DataFrame]:
    """The parts of a full drift report over the model features."""
    columns = drift_by_column(reference, current, ranges=ranges)
    return {
        "columns": columns,
        "verdict": drift_verdict(columns),
        "histograms": histograms(reference, current),
        "summary_reference": numeric_summary(reference, ranges=ranges),
        "summary_current": numeric_summary(current, ranges=ranges),
        "categories_reference": category_summary(reference, ["type"]),
        "categories_current": category_summary(current, ["type"]),
    }
