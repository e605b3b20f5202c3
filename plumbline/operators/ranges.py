"""Order statistics under keys of any size: range carries, ordered pairs and containments, counted without building pairs.

A key's rows are cut into ranges of about ``RANGE_ROWS`` rows by sampled bounds. Work runs inside the ranges, and one
total or first row per range is carried along the key. Keys that fit one range are windowed as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGE_ROWS = 1 << 18  # rows of a key that one task orders
MOST_RANGES = 4096  # of one key; beyond RANGE_ROWS times as many rows its ranges grow


def largest_key(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the key that has most of them."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 0


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str) -> Column:
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(right[f"{prefix}{k}"])
    return condition


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """``right``'s other columns beside ``left``'s rows of the same keys, NULL being a key like others."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    return left.join(renamed, _same(left, renamed, keys, "_r_"), how).drop(*[f"_r_{k}" for k in keys])


def with_ranges(df: DataFrame, keys: Sequence[str], at: str, largest: int) -> DataFrame:
    """``_range``: rises with ``at`` inside each key, NULL last; equal instants share a range.

    ``largest`` is the row count of the greatest key (see :func:`largest_key`). Bounds are quantiles of each key that exceeds one
    range, from a mergeable sketch: one small row per such key.
    """
    if largest <= RANGE_ROWS:
        return df.withColumn("_range", F.lit(0))
    cuts = min(-(-2 * largest // RANGE_ROWS), MOST_RANGES)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > RANGE_ROWS)
    big = join_keys(df, counts, keys, "inner")
    bounds = big.groupBy(*keys).agg(F.percentile_approx(at, [i / cuts for i in range(1, cuts)], 8 * cuts).alias("_bounds"))
    placed = join_keys(df, bounds, keys)
    below = F.size(F.filter("_bounds", lambda b: b <= F.col(at)))
    unplaced = F.when(F.col("_bounds").isNull(), F.lit(0)).otherwise(F.when(F.col(at).isNull(), F.lit(cuts)).otherwise(below))
    return placed.withColumn("_range", unplaced).drop("_bounds")


def next_value(df: DataFrame, keys: Sequence[str], at: str, name: str, largest: int | None = None) -> DataFrame:
    """The following ``at`` within each key as ``name``, NULL for the last; NULL instants stand last."""
    largest = largest_key(df, keys) if largest is None else largest
    if largest <= RANGE_ROWS:
        return df.withColumn(name, F.lead(at).over(Window.partitionBy(*keys).orderBy(F.col(at).asc_nulls_last())))
    ranged = with_ranges(df, keys, at, largest)
    inside = Window.partitionBy(*keys, "_range").orderBy(F.col(at).asc_nulls_last())
    inner = ranged.withColumn("_next", F.lead(at).over(inside))
    firsts = ranged.groupBy(*keys, "_range").agg(F.min(at).alias("_first"))
    chain = Window.partitionBy(*keys).orderBy("_range")
    carried = firsts.withColumn("_carried", F.lead("_first").over(chain)).drop("_first")
    return join_keys(inner, carried, [*keys, "_range"]).select(*df.columns, F.coalesce("_next", "_carried").alias(name))


def ordered_pairs(points: DataFrame, keys: Sequence[str], at: str, first: str, second: str,
                  largest: int | None = None, **sums: Column) -> DataFrame:
    """Per key: ``pairs``, the (first, second) pairs with first's instant <= second's.

    ``points`` carries counts of both kinds at instants. ``sums`` are further sums: of functions of the point's own counts in small
    keys, of the counts added up per instant in keys beyond one range, so they must be linear in the counts.
    """
    largest = largest_key(points, keys) if largest is None else largest
    if largest <= RANGE_ROWS:
        seen = points.withColumn("_seen", F.sum(first).over(Window.partitionBy(*keys).orderBy(at)))
        return seen.groupBy(*keys).agg(
            F.sum(F.col(second) * F.col("_seen")).alias("pairs"), *[F.sum(value).alias(name) for name, value in sums.items()])
    carried = [c for c in points.columns if c not in (*keys, at)]
    collapsed = points.groupBy(*keys, at).agg(*[F.sum(c).alias(c) for c in carried])
    ranged = with_ranges(collapsed, keys, at, largest_key(collapsed, keys))
    inside = Window.partitionBy(*keys, "_range").orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    per_range = ranged.withColumn("_seen", F.sum(first).over(inside)).groupBy(*keys, "_range").agg(
        F.sum(first).alias("_first"), F.sum(second).alias("_second"), F.sum(F.col(second) * F.col("_seen")).alias("_inside"),
        *[F.sum(value).alias(name) for name, value in sums.items()],
    )
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_first").over(earlier), F.lit(0))
    return per_range.withColumn("_pairs", F.col("_inside") + F.col("_second") * before).groupBy(*keys).agg(
        F.sum("_pairs").alias("pairs"), *[F.sum(name).alias(name) for name in sums])


def _with_rank(rows: DataFrame, keys: Sequence[str], at: str, largest: int) -> DataFrame:
    """``_rank``: place of ``at`` among the key's different ones, from 1."""
    if largest <= RANGE_ROWS:
        return rows.withColumn("_rank", F.dense_rank().over(Window.partitionBy(*keys).orderBy(at)).cast("long"))
    values = with_ranges(rows.select(*keys, at).distinct(), keys, at, largest)
    inside = Window.partitionBy(*keys, "_range").orderBy(at)
    sizes = values.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0))).drop("_size")
    ranks = join_keys(values.withColumn("_place", F.row_number().over(inside)), offsets, [*keys, "_range"])
    ranks = ranks.select(*keys, at, (F.col("_place") + F.col("_before")).alias("_rank"))
    return join_keys(rows, ranks, [*keys, at])


def contained_pairs(rows: DataFrame, keys: Sequence[str], largest: int | None = None) -> DataFrame:
    """Per key: ``pairs``, the weighted pairs of an outer span that begins before and ends after an inner one, strictly.

    ``rows`` has ``x``, ``y`` (integers), ``outer`` and ``w``. A count over two inequalities: the order of the starts is split into
    halves at every binary digit of their rank; an outer span is left of an inner one in exactly one split, and within it the second
    inequality is an ordered-pair count. A key of n rows takes log2(n) splits. Keys without spans of both kinds take no part.
    """
    both = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.bool_or("outer").alias("_outer"), F.bool_and("outer").alias("_all")).where("_outer AND NOT _all")
    if largest is None:
        largest = both.agg(F.max("_n")).first()[0] or 0
    taking = join_keys(rows, both.select(*keys), keys, "inner")
    ranked = _with_rank(taking, keys, "x", largest)
    level = F.explode(F.sequence(F.lit(0), F.lit(largest.bit_length()))).alias("_level")
    halves = ranked.select(*keys, "y", "outer", "w", "_rank", level).where(
        (F.expr("shiftright(_rank, _level) & 1L") == 0) == F.col("outer"))
    # Ending after an instant means ending at the next one or later.
    points = halves.select(
        *keys, "_level", F.expr("shiftright(shiftright(_rank, _level), 1)").alias("_half"),
        F.when(F.col("outer"), F.col("y") - 1).otherwise(F.col("y")).alias("t"),
        F.when(F.col("outer"), F.lit(0)).otherwise(F.col("w")).alias("inner"), F.when(F.col("outer"), F.col("w")).otherwise(F.lit(0)).alias("outer"))
    counted = ordered_pairs(points, [*keys, "_level", "_half"], "t", "inner", "outer", largest=largest)
    return counted.groupBy(*keys).agg(F.sum("pairs").alias("pairs"))
