"""Helpers that let one query serve a single dataset or many labelled copies.

``by`` names label columns (for example ``variant_id``). With no labels a check
yields one row; with labels it yields one row per label from the same job.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

By = Sequence[str]


def attach(df: DataFrame, facts: DataFrame, by: By = ()) -> DataFrame:
    """Add the columns of a one-row table, or of one row per label.

    Without labels the row arrives as a scalar subquery, so a second row is an
    error and no cross join is planned. With labels ``facts`` holds one row per
    label; Spark broadcasts it when its measured size allows.
    """
    if by:
        return df.join(facts, list(by), "left")
    row = facts.select(F.struct("*")).scalar()
    added = [c for c in facts.columns]
    return df.withColumn("_facts", row).select("*", *[F.col(f"_facts.{c}").alias(c) for c in added]).drop("_facts")


def totals(parts: Sequence[DataFrame], by: By = (), labels: DataFrame | None = None) -> DataFrame:
    """Named counts side by side plus their sum as ``violation_count``.

    Each part has the columns ``by`` and one or more counts of its own. ``labels``
    lists the labels to report, so that a label none of whose tables has rows still
    reports zero.
    """
    names = [c for part in parts for c in part.columns if c not in by]
    if len(parts) == 1 and labels is None:
        report = parts[0]
    else:
        stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        report = stacked.groupBy(*by).agg(*[F.sum(name).alias(name) for name in names])
    if labels is not None:
        report = labels.select(*by).distinct().join(report, list(by), "left")
    counts = [F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias(name) for name in names]
    report = report.select(*by, *counts)
    return report.withColumn("violation_count", reduce(lambda a, b: a + b, [F.col(name) for name in names]))


def count_where(df: DataFrame, by: By = (), **conditions: Column) -> DataFrame:
    """Rows meeting each named condition, in one scan; an unknown (NULL) condition does not count."""
    return df.groupBy(*by).agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])


def sum_of(df: DataFrame, by: By = (), **values: Column) -> DataFrame:
    """Named sums, zero without rows."""
    return df.groupBy(*by).agg(*[F.coalesce(F.sum(v), F.lit(0)).alias(name) for name, v in values.items()])
