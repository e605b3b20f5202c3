"""Versioned rows: latest per key, merges, guarded updates, validity intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.exprs import epoch_micros
from plumbline.operators.ranges import contained_pairs, next_value, ordered_pairs
from plumbline.operators.scope import By, sum_of


def rank_struct(order: Sequence[str], rest: Sequence[str] = ()) -> Column:
    """A struct whose maximum is the first row of ``ORDER BY order DESC NULLS FIRST``.

    ``rest`` breaks exact ties, so that a re-run task picks the same row.
    """
    parts = []
    for name in order:
        parts.append(F.col(name).isNull().alias(f"{name}__absent"))
        parts.append(F.col(name))
    return F.struct(*parts, *[F.col(c) for c in rest])


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` per key; NULLs rank first.

    An aggregate, not a window: each task sends at most one row per key to the
    shuffle, so a key with very many versions costs no more than any other.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    top = df.groupBy(*keys).agg(F.max(rank_struct(order, rest)).alias("_top"))
    return top.select(*[F.col(c) if c in keys else F.col(f"_top.{c}").alias(c) for c in df.columns])


def merge_versions(existing: DataFrame, incoming: DataFrame, keys, order) -> DataFrame:
    """Upsert by version: the greatest version per key wins.

    Independent of arrival order and safe to repeat, so late and replayed rows
    need no special case.
    """
    return latest_by(existing.unionByName(incoming), keys, order)


def first_version_merge(existing: DataFrame, incoming: DataFrame, keys, order) -> DataFrame:
    """Defective policy kept for fault variants: the first version of a key stays."""
    kept = latest_by(existing, keys, order)
    fresh = latest_by(incoming, keys, order).join(kept.select(*keys), list(keys), "left_anti")
    return kept.unionByName(fresh)


def guarded_apply(before: DataFrame, incoming: DataFrame, keys, version: str, by: By = ()) -> DataFrame:
    """Update where the incoming version is newer, insert absent keys, delete nothing."""
    on = [*by, *keys]
    newest = latest_by(incoming, on, [version])
    values = [c for c in before.columns if c not in on]
    packed = newest.select(*on, F.struct(*values).alias("_new"))
    met = before.withColumn("_old", F.lit(True)).join(packed, on, "full")
    take = F.col("_old").isNull() | F.coalesce(F.col(f"_new.{version}") > F.col(version), F.lit(False))
    applied = met.select(*on, *[F.when(take, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in values])
    return applied.select(*before.columns)


def next_start(df: DataFrame, keys: Sequence[str], at: str, name: str = "next_start") -> DataFrame:
    """The following ``at`` within each key, NULL for the last; a long key is ordered in ranges and carried between them."""
    return next_value(df, keys, at, name)


def type1_current(changes: DataFrame, by: By = ()) -> DataFrame:
    """Current row per customer: latest effective time, then event id."""
    return latest_by(changes, [*by, "customer_id"], ["effective_at", "event_id"])


def type2_history(changes: DataFrame, by: By = ()) -> DataFrame:
    """Half-open validity intervals; of changes at one instant the last event counts."""
    keys = [*by, "customer_id"]
    one_per_instant = latest_by(changes, [*keys, "effective_at"], ["event_id"])
    chained = next_start(one_per_instant, keys, "effective_at", "valid_to")
    return chained.select(
        *by, F.col("event_id").alias("version_id"), "customer_id", "tier",
        F.col("effective_at").alias("valid_from"), "valid_to", F.col("valid_to").isNull().alias("is_current"),
    )


_FOREVER = 4_000_000_000_000_000_000


def _regular_overlaps(spans: DataFrame, keys: Sequence[str], largest: int) -> DataFrame:
    """Overlapping pairs among spans that do not end before they start.

    Two such spans are disjoint when one ends by the start of the other, so

        overlapping = all pairs - (end, start) pairs in that order

    An empty span ends by its own start, and two empty spans at one instant are
    disjoint in both directions: those are given back.
    """
    regular = spans.where("e >= s")
    edge = F.explode(F.array(
        F.struct(F.col("s").alias("t"), F.lit(0).alias("ends"), F.lit(1).alias("starts")),
        F.struct(F.col("e").alias("t"), F.lit(1).alias("ends"), F.lit(0).alias("starts")),
    ))
    points = regular.select(*keys, edge.alias("edge")).select(*keys, "edge.*").where(F.col("t") < _FOREVER)
    counted = ordered_pairs(points, keys, "t", "ends", "starts", largest=2 * largest, size=F.col("starts"))
    empty = regular.where("e = s").groupBy(*keys, "s").agg(F.count(F.lit(1)).alias("c"))
    repaid = empty.select(*keys, F.expr("c + c * (c - 1) div 2").alias("n"))
    return counted.select(*keys, F.expr("size * (size - 1) div 2 - pairs").alias("n")).unionByName(repaid)


def _inverted_overlaps(spans: DataFrame, keys: Sequence[str], largest: int) -> DataFrame:
    """Overlapping pairs of a span that ends before it starts and one that strictly contains it."""
    rows = spans.withColumn("outer", F.expr("e >= s")).select(
        *keys, "outer", F.least("s", "e").alias("x"), F.greatest("s", "e").alias("y"), F.lit(1).alias("w"))
    return contained_pairs(rows, keys, largest).select(*keys, F.col("pairs").alias("n"))


def overlap_pairs(history: DataFrame, key: str = "customer_id", version: str = "version_id", start: str = "valid_from",
                  end: str = "valid_to", by: By = (), name: str = "n") -> DataFrame:
    """Pairs of versions of one key whose half-open validity overlaps, each pair once.

    Pairs are told apart by version id, so rows that share one are no pair: the
    pairs inside such groups are counted along and taken off. One first job tells how large the keys are, and
    whether repeated versions and spans that end before they start have to be looked at.
    """
    known = history.where(F.col(version).isNotNull() & F.col(start).isNotNull() & F.col(key).isNotNull())
    spans = known.select(
        *by, F.col(key).alias("k"), F.col(version).alias("v"), epoch_micros(known, start).alias("s"),
        F.coalesce(epoch_micros(known, end), F.lit(_FOREVER)).alias("e"),
    )
    marks = [*by, "k", "v"]
    versions = spans.groupBy(*marks).agg(F.count(F.lit(1)).alias("c"), F.count_if(F.expr("e < s")).alias("inverted"))
    by_key = versions.groupBy(*by, "k").agg(F.sum("c").alias("n"), F.max("c").alias("c"), F.sum("inverted").alias("inverted"))
    found = by_key.agg(F.max("n").alias("n"), F.max("c").alias("c"), F.max(F.expr("IF(inverted > 0, n, 0)")).alias("inverted")).first()

    stacked = spans.withColumn("sign", F.lit(1)).withColumn("v", F.lit(None).cast(spans.schema["v"].dataType))
    if (found.c or 0) > 1:
        again = spans.join(versions.where("c > 1").select(*marks), marks, "left_semi").withColumn("sign", F.lit(-1))
        stacked = stacked.unionByName(again)
    groups = [*marks, "sign"]
    counted = _regular_overlaps(stacked, groups, found.n or 0)
    if found.inverted:
        counted = counted.unionByName(_inverted_overlaps(stacked, groups, found.inverted))
    return sum_of(counted, by, **{name: F.col("sign") * F.col("n")})
