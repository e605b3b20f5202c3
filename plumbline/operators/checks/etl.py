"""Mapping, exact transformation, quarantine, replay and recovery."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.exprs import amounts_ok, any_of, distinct_from, text_amount
from plumbline.operators.reconcile import diff_and_duplicates, diff_count
from plumbline.operators.scope import By, attach, totals
from plumbline.operators.versions import latest_by

Tables = dict[str, DataFrame]

WIDE = "decimal(28,10)"


def _net_from_text() -> F.Column:
    return text_amount("gross_text", WIDE) - text_amount("discount_text", WIDE)


def _transform(t: Tables, by: By) -> DataFrame:
    expected = t["etl_source"].select(*by, "order_id", _net_from_text().alias("net_amount"))
    return diff_count(expected, t["etl_target"], ["order_id"], ["net_amount"], by, "amount_mismatch")


def mapping(t: Tables, by: By = (), labels=None) -> DataFrame:
    """Target customer ids against the reference mapping of the source codes."""
    mapped = t["etl_source"].select(*by, "order_id", "customer_code").join(
        t["etl_customers"].select(*by, "customer_code", "customer_id"), [*by, "customer_code"]
    )
    return totals([diff_count(mapped, t["etl_target"], ["order_id"], ["customer_id"], by, "mapping_mismatch")], by, labels)


def transform(t: Tables, by: By = (), labels=None) -> DataFrame:
    """Target net amounts against the exact difference of the source texts."""
    return totals([_transform(t, by)], by, labels)


def quarantine(t: Tables, by: By = (), labels=None) -> DataFrame:
    """Well-formed rows loaded, malformed rows rejected once with the right reason."""
    source = t["etl_source"].select(*by, "order_id", amounts_ok().alias("ok"))
    bad = source.where(~F.col("ok")).select(*by, "order_id", F.lit("INVALID_AMOUNT").alias("reason"))
    return totals([
        diff_count(source.where("ok"), t["etl_target"], ["order_id"], [], by, "accepted_mismatch"),
        diff_and_duplicates(
            bad, t["etl_rejects"], ["order_id"], ["reason"], "rejected_mismatch", "duplicate_rejects", by),
    ], by, labels)


def replay(t: Tables, by: By = (), labels=None) -> DataFrame:
    """Target against the latest event per order among the batches loaded so far."""
    context = t["etl_context"].select(*by, "batch_no")
    visible = attach(t["etl_source"], context, by).where(F.col("arrived_batch") <= F.col("batch_no"))
    latest = latest_by(visible, [*by, "order_id"], ["event_id"])
    expected = latest.select(*by, "order_id", "event_id", _net_from_text().alias("net_amount"))
    fields = ["event_id", "net_amount"]
    found = diff_and_duplicates(expected, t["etl_target"], ["order_id"], fields, "version_mismatch", "duplicate_keys", by)
    return totals([found], by, labels)


def last_step_problem(steps: DataFrame, checkpoint: int, by: By = ()) -> DataFrame:
    """Rows of the last step that are not a success at the checkpoint; no step, no problem."""
    bad = any_of([
        distinct_from("execution_status", F.lit("SUCCESS")), distinct_from("checkpoint", F.lit(checkpoint)),
    ])
    per_step = steps.where(F.col("step_no").isNotNull()).groupBy(*by, "step_no").agg(F.count_if(bad).alias("n"))
    return per_step.groupBy(*by).agg(F.max(F.struct("step_no", "n")).alias("last")).select(
        *by, F.coalesce("last.n", F.lit(0)).alias("last_step_problem")
    )


def recovery(t: Tables, by: By = (), labels=None) -> DataFrame:
    """Exact target and a last step that succeeded at checkpoint 1."""
    return totals([_transform(t, by), last_step_problem(t["etl_steps"], 1, by)], by, labels)
