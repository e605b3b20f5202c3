"""Lineage, schema, layers, copy metrics, watermark, recovery, partitions, references."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.exprs import any_of, distinct_from, epoch_micros
from plumbline.operators.ranges import ordered_pairs
from plumbline.operators.reconcile import (
    diff_and_duplicates, diff_count, duplicate_count, unmatched_rows, weighted_left_violations,
)
from plumbline.operators.rollups import sum_by
from plumbline.operators.scope import By, attach, count_where, sum_of, totals
from plumbline.operators.versions import latest_by, rank_struct

Tables = dict[str, DataFrame]

RECORD = ["customer_id", "amount", "event_id", "updated_at"]


def latest_visible(t: Tables, by: By = ()) -> DataFrame:
    """Latest event per order among the selected batches, up to and including the clock."""
    context = t["cloud_context"].select(*by, F.col("batch_no").alias("_batch"), F.col("as_of").alias("_as_of"))
    rows = attach(t["cloud_source"], context, by)
    seen = rows.where((F.col("batch_no") <= F.col("_batch")) & (F.col("updated_at") <= F.col("_as_of")))
    return latest_by(seen.drop("_batch", "_as_of"), [*by, "order_id"], ["event_id"])


def _layer(expected: DataFrame, actual: DataFrame, diff: str, duplicates: str, by: By) -> DataFrame:
    return diff_and_duplicates(expected, actual, ["order_id"], RECORD, diff, duplicates, by)


def _every_label(t: Tables, facts: DataFrame, by: By) -> DataFrame:
    """One row per label even where ``facts`` has none."""
    return t["cloud_context"].select(*by).distinct().join(facts, list(by), "left") if by else facts


def _target(t: Tables, by: By) -> DataFrame:
    return _layer(latest_visible(t, by), t["cloud_target"], "target_mismatch", "duplicate_keys", by)


def lineage(t: Tables, by: By = (), labels=None) -> DataFrame:
    """Activities of absent or unknown runs, unmet dependencies, rows of unknown runs."""
    activities, runs = t["cloud_activities"], t["cloud_runs"]
    unknown = any_of([
        F.col("execution_status") == "UNKNOWN", F.col("source_dataset").isNull(), F.col("target_dataset").isNull(),
    ])
    dependent = activities.where(F.col("dependency_id").isNotNull())
    rows_per_run = t["cloud_target"].groupBy(*by, "run_id").agg(F.count(F.lit(1)).alias("c"))
    orphans = rows_per_run.join(runs.select(*by, "run_id").distinct(), [*by, "run_id"], "left_anti")
    return totals([
        weighted_left_violations(
            activities, runs, ["run_id"], ["run_id"], unknown, F.col("execution_status") == "UNKNOWN", by,
            "activity_problems",
        ),
        weighted_left_violations(
            dependent, activities, ["dependency_id", "run_id"], ["activity_id", "run_id"],
            F.lit(False), distinct_from("execution_status", F.lit("SUCCESS")), by, "unmet_dependencies",
        ),
        sum_of(orphans, by, orphan_rows=F.col("c")),
    ], by, labels)


def schema_contract(t: Tables, by: By = (), labels=None) -> DataFrame:
    keys = ["dataset", "column_name"]
    found = diff_and_duplicates(
        t["cloud_expected_schema"], t["cloud_schema"], keys, ["data_type"], "schema_mismatch", "duplicate_columns", by
    )
    return totals([found], by, labels)


def layers(t: Tables, by: By = (), labels=None) -> DataFrame:
    """Each layer against the one before it."""
    bronze, silver, target = t["cloud_bronze"], t["cloud_silver"], t["cloud_target"]
    return totals([
        _layer(latest_visible(t, by), bronze, "bronze_mismatch", "bronze_duplicates", by),
        _layer(bronze, silver, "silver_mismatch", "silver_duplicates", by),
        _layer(silver, target, "target_mismatch", "target_duplicates", by),
    ], by, labels)


def copy_metrics(t: Tables, by: By = (), labels=None) -> DataFrame:
    """Published rows, and whether the copy's own row counts agree with the data."""
    publishing = t["cloud_activities"].where(F.col("target_dataset") == "target")
    visible = latest_visible(t, by).groupBy(*by).agg(F.count(F.lit(1)).alias("visible_rows"))
    published = t["cloud_target"].groupBy(*by).agg(F.count(F.lit(1)).alias("target_rows"))
    measured = attach(attach(publishing, visible, by), published, by)
    wrong = any_of([
        distinct_from("execution_status", F.lit("SUCCESS")),
        distinct_from("rows_read", F.coalesce("visible_rows", F.lit(0))),
        distinct_from("rows_written", F.coalesce("target_rows", F.lit(0))),
    ])
    found = _every_label(t, publishing.groupBy(*by).agg(F.count(F.lit(1)).alias("c")), by)
    absent = F.when(F.coalesce("c", F.lit(0)) == 0, F.lit(1)).otherwise(F.lit(0))
    return totals([
        _target(t, by), count_where(measured, by, metric_mismatch=wrong), found.select(*by, absent.alias("no_target_activity")),
    ], by, labels)


def watermark_load(t: Tables, by: By = (), labels=None) -> DataFrame:
    return totals([_target(t, by)], by, labels)


def last_step(steps: DataFrame, by: By = ()) -> DataFrame:
    rest = [c for c in steps.columns if c not in by and c != "step_no"]
    return steps.groupBy(*by).agg(F.max(rank_struct(["step_no"], rest)).alias("step"))


def publication_recovery(t: Tables, by: By = (), labels=None) -> DataFrame:
    """Exact target, every activity a success, and a last step that finished the selected batch."""
    step = attach(_every_label(t, last_step(t["cloud_steps"], by), by),
                  t["cloud_context"].select(*by, F.col("batch_no").alias("selected_batch")), by)
    done = (F.col("step.execution_status") == "SUCCESS") & (F.col("step.batch_no") == F.col("selected_batch"))
    problem = F.when(F.coalesce(done, F.lit(False)), F.lit(0)).otherwise(F.lit(1))
    return totals([
        _target(t, by),
        count_where(t["cloud_activities"], by, failed_activities=distinct_from("execution_status", F.lit("SUCCESS"))),
        step.select(*by, problem.alias("checkpoint_problem")),
    ], by, labels)


def partition_manifest(t: Tables, by: By = (), labels=None) -> DataFrame:
    """Contracted rows per partition against the manifest, and files listed twice.

    A sum skips NULL counts, so a partly unknown partition can match: whether the
    evidence is complete is a separate question (see ``operators.verdicts``).
    """
    listed = sum_by(t["cloud_manifest"], [*by, "partition_key"], "row_count")
    return totals([
        diff_count(t["cloud_expected_partitions"], listed, ["partition_key"], ["row_count"], by, "partition_mismatch"),
        duplicate_count(t["cloud_manifest"], ["file_key"], by, "duplicate_files"),
    ], by, labels)


def reference_freshness(t: Tables, by: By = (), labels=None) -> DataFrame:
    """Required references that are missing, unexpected, undated, ahead of the clock or too old.

    Ages exceed limits pair by pair, so the late pairs are an ordered-pair count
    over limits and ages on one microsecond axis.
    """
    keys = ["dataset_id", "reference_id"]
    on = [*by, *keys]
    context = t["cloud_context"].select(*by, "as_of")
    seen = attach(t["cloud_references"], context, by)
    age = epoch_micros(seen, "as_of") - epoch_micros(seen, "observed_at")
    seen = seen.withColumn("age", age)
    undated = F.col("observed_at").isNull() | F.coalesce(F.col("age") < 0, F.lit(False))
    required = t["cloud_required_references"]

    one, none = F.lit(1), F.lit(0)
    rows = required.select(
        *on, one.alias("n_expected"), none.alias("n_actual"), none.alias("n_bad")
    ).unionByName(seen.select(
        *on, none.alias("n_expected"), one.alias("n_actual"), undated.cast("int").alias("n_bad")
    ))
    per_key = rows.groupBy(*on).agg(*[F.sum(c).alias(c) for c in ("n_expected", "n_actual", "n_bad")])
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    limits = required.where(known & F.col("sla_minutes").isNotNull()).select(
        *on, (F.col("sla_minutes").cast("bigint") * 60_000_000).alias("t"), F.lit(1).alias("a"), F.lit(0).alias("b")
    )
    ages = seen.where(known & ~undated & F.col("age").isNotNull()).select(
        *on, (F.col("age") - 1).alias("t"), F.lit(0).alias("a"), F.lit(1).alias("b")
    )
    late = ordered_pairs(limits.unionByName(ages), on, "t", "a", "b")
    undated_pairs = F.when(known, F.col("n_expected") * F.col("n_bad")).otherwise(F.lit(0))
    return totals([
        sum_of(per_key, by, unmatched_references=unmatched_rows(keys), undated_references=undated_pairs),
        sum_of(late, by, late_references=F.col("pairs")),
    ], by, labels)
