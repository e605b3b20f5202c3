"""Incremental loads, freshness, type-1 and type-2 customer history."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.exprs import epoch_micros
from plumbline.operators.ranges import contained_pairs, join_keys, ordered_pairs
from plumbline.operators.reconcile import diff_and_duplicates, diff_count
from plumbline.operators.scope import By, attach, sum_of, totals
from plumbline.operators.versions import latest_by, overlap_pairs, type1_current, type2_history

Tables = dict[str, DataFrame]


def incremental_load(t: Tables, by: By = (), labels=None) -> DataFrame:
    """Target against the latest version among the events that had arrived by the clock."""
    clock = t["lab_context"].select(*by, "as_of")
    visible = attach(t["incremental_events"], clock, by).where(F.col("arrived_at") <= F.col("as_of")).drop("as_of")
    expected = latest_by(visible, [*by, "order_id"], ["event_at", "event_id"])
    fields = ["event_id", "event_at", "net_amount"]
    found = diff_and_duplicates(
        expected, t["incremental_target"], ["order_id"], fields, "version_mismatch", "duplicate_keys", by
    )
    return totals([found], by, labels)


_FAR = 4_000_000_000_000_000_000


def freshness_counts(requirements: DataFrame, observations: DataFrame, by: By = ()) -> DataFrame:
    """Per dataset: ``n``, its requirements times observations (or requirements alone), and ``violated``, those not fresh.

    A successful observation is fresh for a requirement when both its instants lie in the window that the limit leaves
    before the clock. With the earlier and the later instant of each observation, the fresh pairs are those whose later one is not
    after the window, less those whose earlier one is before it, plus those that reach out on both sides: two
    ordered-pair counts and one containment count, so no pair is built however many rows a dataset has.
    """
    on = [*by, "dataset_id"]
    moments = [epoch_micros(observations, m) for m in ("last_success_at", "last_event_at")]
    usable = (F.col("execution_status") == "SUCCESS") & F.col("last_success_at").isNotNull() & F.col("last_event_at").isNotNull()
    seen = observations.where(F.col("dataset_id").isNotNull()).select(
        *on, F.coalesce(usable, F.lit(False)).alias("usable"), F.least(*moments).alias("lo"), F.greatest(*moments).alias("hi"))
    clock = epoch_micros(requirements, "as_of")
    wanted = requirements.select(
        *on, F.coalesce(clock - F.col("sla_minutes").cast("bigint") * 60_000_000, F.lit(-_FAR)).alias("low"),
        F.coalesce(clock, F.lit(_FAR)).alias("high"))

    none, one = F.lit(0), F.lit(1)
    sizes = wanted.select(*on, one.alias("r"), none.alias("o")).unionByName(
        seen.select(*on, none.alias("r"), one.alias("o"))).groupBy(*on).agg(F.sum("r").alias("r"), F.sum("o").alias("o")).where("r > 0")

    largest = sizes.agg(F.max(F.col("r") + F.col("o"))).first()[0] or 0

    def edges(rows: DataFrame, part: int, at: Column, first: int) -> DataFrame:
        return rows.select(*on, F.lit(part).alias("part"), at.alias("t"), F.lit(first).alias("seen"), F.lit(1 - first).alias("wanted"))

    fit, asked = seen.where("usable"), wanted.where(F.col("dataset_id").isNotNull())
    points = reduce(DataFrame.unionByName, [
        edges(fit, 0, F.col("hi"), 1), edges(asked, 0, F.col("high"), 0),
        edges(fit, 1, F.col("lo") + 1, 1), edges(asked, 1, F.col("low"), 0)])
    sides = ordered_pairs(points, [*on, "part"], "t", "seen", "wanted", largest).select(
        *on, (F.col("pairs") * (1 - 2 * F.col("part"))).alias("fresh"))
    # Few observations are both too old and ahead of some clock; only those can reach out on both sides.
    extent = asked.groupBy(*on).agg(F.max("low").alias("low"), F.min("high").alias("high"))
    wide = fit.join(extent, on).where("lo < low AND hi > high").select(
        *on, F.lit(True).alias("outer"), F.col("lo").alias("x"), F.col("hi").alias("y"), one.alias("w"))
    narrow = asked.join(wide.select(*on).distinct(), on, "left_semi").select(
        *on, F.lit(False).alias("outer"), F.col("low").alias("x"), F.col("high").alias("y"), one.alias("w"))
    around = contained_pairs(wide.unionByName(narrow), on, largest).select(*on, F.col("pairs").alias("fresh"))
    fresh = sides.unionByName(around).groupBy(*on).agg(F.sum("fresh").alias("fresh"))
    counted = join_keys(sizes, fresh, on)
    n = F.when(F.col("o") > 0, F.col("r") * F.col("o")).otherwise(F.col("r"))
    return counted.select(*on, n.alias("n"), (n - F.coalesce("fresh", F.lit(0))).alias("violated"))


def freshness(t: Tables, by: By = (), labels=None) -> DataFrame:
    """Required datasets that are missing, failed, undated, ahead of the clock or too old.

    An age of exactly the limit is fresh; one microsecond more is not.
    """
    counted = freshness_counts(t["freshness_requirements"], t["freshness_observations"], by)
    return totals([sum_of(counted, by, not_fresh=F.col("violated"))], by, labels)


def type1_customers(t: Tables, by: By = (), labels=None) -> DataFrame:
    expected = type1_current(t["source_customer_changes"], by)
    fields = ["tier", "effective_at", "event_id"]
    found = diff_count(expected, t["target_customers_current"], ["customer_id"], fields, by, "current_mismatch")
    return totals([found], by, labels)


def type2_customers(t: Tables, by: By = (), labels=None) -> DataFrame:
    """History against the change log, plus the invariants of half-open intervals."""
    history = t["target_customer_history"]
    expected = type2_history(t["source_customer_changes"], by)
    starts = diff_and_duplicates(
        expected, history, ["customer_id", "valid_from"], ["tier", "valid_to", "is_current"],
        "history_mismatch", "duplicate_starts", by,
    )
    per_customer = history.groupBy(*by, "customer_id").agg(
        F.count_if("is_current").alias("current_rows"),
        F.count_if(F.col("valid_to") <= F.col("valid_from")).alias("bad"),
    )
    customers = sum_of(
        per_customer, by, not_one_current=(F.col("current_rows") != 1).cast("bigint"), bad_ranges=F.col("bad")
    )
    return totals([starts, customers, overlap_pairs(history, by=by, name="overlap_pairs")], by, labels)
