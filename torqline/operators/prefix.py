"""Distributed running sums.

A window without partition keys sorts a whole table in one task. Here the ordered axis is
first cut into ranges; each range is summed on its own and then shifted by the total of the
ranges before it. The cuts are read once from quantile sketches and become literals of the plan, so the
range of a row depends on nothing but its value: a task that runs again after a lost executor
puts every row where it was before. The sketches only balance the ranges, they never change
results.
"""

from __future__ import annotations

from math import ceil

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from torqline import config as C
from torqline.session import scratch_path


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read from there: several readers, and a lost executor, repeat nothing."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def finite(value: Column) -> Column:
    """``value`` as a double; null for null, NaN and the infinities."""
    number = value.cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def range_cuts(
    df: DataFrame, columns: list[str], ranges: int | None = None, rows_per_range: int = C.ROWS_PER_RANGE
) -> dict[str, list[float]]:
    """Ascending cut points per column that split the rows into about equal ranges.

    One pass counts the rows and folds every column's finite values into a mergeable quantile sketch. There are as
    many ranges as shuffle partitions, whatever the size; a second pass makes up to ``RANGE_GRID`` of them where that
    leaves each more than ``rows_per_range``. So the driver holds O(partitions) numbers, however many rows there
    are. With ``ranges`` that many are made. A value that holds many rows takes up whole ranges that
    collapse, and every other range keeps at most about its share of rows.
    """
    spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows, cuts = _sketched_cuts(df, columns, ranges or spread)
    want = min(C.RANGE_GRID, ceil(rows / rows_per_range))
    return _sketched_cuts(df, columns, want)[1] if not ranges and want > spread else cuts


def _sketched_cuts(df: DataFrame, columns: list[str], steps: int) -> tuple[int, dict[str, list[float]]]:
    """The number of rows and about equal-sized ranges of each column; the error of a cut is about half a range."""
    size = F.lit(min(65_535, max(200, 4 * steps)))
    folded = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count(finite(F.col(name))).alias(f"__has_{name}") for name in columns],
        *[F.kll_sketch_agg_double(finite(F.col(name)), size).alias(name) for name in columns],
    )
    shares = F.array(*[F.lit(step / steps) for step in range(1, steps)]).cast("array<double>")
    cuts = [
        F.when(F.col(f"__has_{name}") > 0, F.kll_sketch_get_quantile_double(F.col(name), shares)).alias(name)
        for name in (columns if steps > 1 else [])
    ]
    found = folded.select("__rows", *cuts).first()
    return found["__rows"], {name: sorted(set(found[name] or [])) if steps > 1 else [] for name in columns}


def with_ranges(df: DataFrame, cuts: dict[str, list[float]], outputs: dict[str, str]) -> DataFrame:
    """Add the number of the range each column's value falls in (binary search on the JVM), under ``outputs``.

    The numbers are never null. A nullable join key would get a null filter on one of the two
    branches that share a shuffle, and the shuffle would then run twice.
    """
    whole = {outputs[name]: F.lit(0) for name, own in cuts.items() if not own}
    cut = [name for name, own in cuts.items() if own]
    if not cut:
        return df.withColumns(whole)
    axes = {name: f"__{outputs[name]}_axis" for name in cut}
    bucketizer = Bucketizer(
        splitsArray=[[float("-inf"), *cuts[name], float("inf")] for name in cut],
        inputCols=list(axes.values()),
        outputCols=[outputs[name] for name in cut],
        handleInvalid="keep",
    )
    ranged = bucketizer.transform(df.withColumns({axis: F.col(name).cast("double") for name, axis in axes.items()}))
    ranged = ranged.drop(*axes.values())
    return ranged.withColumns({outputs[name]: F.coalesce(F.col(outputs[name]).cast("int"), F.lit(-1)) for name in cut} | whole)


def with_range(df: DataFrame, column: str, cuts: list[float], output: str) -> DataFrame:
    """``with_ranges`` for one column."""
    return with_ranges(df, {column: cuts}, {column: output})


def running_sums(
    df: DataFrame,
    order: str,
    sums: dict[str, str],
    bucket: str,
    by: list[str] | None = None,
    overall: dict[str, Column] | None = None,
) -> DataFrame:
    """Inclusive running sums of ``sums`` (output -> input) along ``order``, per ``by`` group.

    ``order`` must be unique within a group. Adds, for every row, the running sums, the group
    total of each as ``total_<output>``, the next value of ``order`` as ``next_<order>``, and
    the group sums named in ``overall``.
    """
    by = by or []
    overall = overall or {}
    keys = [*by, bucket]
    within = Window.partitionBy(*keys).orderBy(order)
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    per_range = df.groupBy(*keys).agg(
        F.min(order).alias("__first"),
        *[F.sum(source).alias(f"__sum_{name}") for name, source in sums.items()],
        *[F.sum(expression).alias(f"__all_{name}") for name, expression in overall.items()],
    )
    # One row per range and group from here on, so these windows stay small.
    across = Window.partitionBy(*by).orderBy(bucket)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy(*by)
    offsets = per_range.select(
        *keys,
        F.lead("__first").over(across).alias("__next_first"),
        *[F.coalesce(F.sum(f"__sum_{name}").over(before), F.lit(0)).alias(f"__before_{name}") for name in sums],
        *[F.sum(f"__sum_{name}").over(group).alias(f"total_{name}") for name in sums],
        *[F.sum(f"__all_{name}").over(group).alias(name) for name in overall],
    )
    local = df.select(
        "*",
        F.lead(order).over(within).alias("__next"),
        *[F.sum(source).over(upto).alias(f"__upto_{name}") for name, source in sums.items()],
    )
    joined = local.join(offsets, keys)
    return joined.select(
        *df.columns,
        F.coalesce("__next", "__next_first").alias(f"next_{order}"),
        *[(F.col(f"__upto_{name}") + F.col(f"__before_{name}")).alias(name) for name in sums],
        *[f"total_{name}" for name in sums],
        *overall,
    )


def last_before(
    index: DataFrame,
    events: DataFrame,
    by: list[str],
    axis: str,
    bucket: str,
    carried: list[str],
    buckets: tuple[int, int],
) -> DataFrame:
    """The events with the ``carried`` columns of the last index row of their group at or before them on ``axis``.

    A range merge join. Both sides have ``axis`` and ``bucket``, a range from ``buckets[0]`` to ``buckets[1]`` that never
    falls as ``axis`` grows; they are merged and sorted range by range, and each range takes over the last index row of
    the ranges before it. Every row is read once, however many events lie between two index rows. Null where there
    is no index row before.
    """
    keys = [*by, bucket]
    entry = F.struct(*carried)
    left = index.select(*keys, axis, F.lit(0).alias("__side"), entry.alias("__entry"))
    right = events.select(*keys, axis, F.lit(1).alias("__side"), F.struct(*events.columns).alias("__event"))
    within = Window.partitionBy(*keys).orderBy(axis, "__side")
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    merged = left.unionByName(right, allowMissingColumns=True)
    merged = merged.withColumn("__here", F.last("__entry", ignorenulls=True).over(upto)).where("__side = 1")
    # The last index row of every range, one row per range and group, read from the index alone.
    ends = index.groupBy(*keys).agg(F.max_by(entry, axis).alias("__end"))
    spine = index.select(*by).distinct().withColumn(bucket, F.explode(F.sequence(*map(F.lit, buckets))))
    before = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    ends = spine.join(ends, keys, "left").select(*keys, F.last("__end", ignorenulls=True).over(before).alias("__before"))
    found = F.coalesce("__here", "__before")
    return merged.join(ends, keys, "left").select("__event.*", *[found[name].alias(name) for name in carried])


def dense_sequence(
    df: DataFrame, order: str, output: str, start: int = 1, ranges: int | None = None, cuts: list[float] | None = None
) -> DataFrame:
    """Number the rows start, start + 1, .. along a unique ``order`` column."""
    if cuts is None:
        cuts = range_cuts(df, [order], ranges)[order]
    ranged = with_range(df, order, cuts, "__range").withColumn("__one", F.lit(1).cast("long"))
    numbered = running_sums(ranged, order, {"__position": "__one"}, "__range")
    return numbered.withColumn(output, F.col("__position") + F.lit(start - 1).cast("long")).select(*df.columns, output)
