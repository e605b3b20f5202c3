"""Contract, pagination, retries and ingestion of landed API pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.exprs import any_of, json_has_value, json_type_ok
from plumbline.operators.reconcile import difference, duplicate_key, key_counts, missing_key, unexpected_key
from plumbline.operators.scope import By, count_where, sum_of, totals
from plumbline.operators.versions import latest_by
from plumbline.sources.pages import page_records, typed_records

Tables = dict[str, DataFrame]

# The record contract of the orders endpoint.
OK_STATUS = 200
FIELD_KINDS = {"order_id": "integer", "customer_id": "integer", "net_amount": "decimal"}


def wrong_status(attempts: DataFrame, by: By = (), status: int = OK_STATUS) -> DataFrame:
    """Final attempts whose status is not the expected one; a timeout has none."""
    return count_where(attempts, by, wrong_status=F.col("final") & ~F.col("status").eqNullSafe(F.lit(status)))


def bad_records(records: DataFrame, by: By = (), kinds: dict[str, str] = FIELD_KINDS) -> DataFrame:
    """Records with a missing, null or ill-typed field, each once."""
    faulty = any_of(
        [~json_has_value(F.col("item"), f) for f in kinds]
        + [~json_type_ok(F.col("item"), f, kind) for f, kind in kinds.items()]
    )
    return count_where(records, by, bad_records=faulty)


def delivered_ids(t: Tables, records: DataFrame, by: By = (), unique: bool = True) -> DataFrame:
    """Ids missing, unexpected and (on request) delivered more than once, from one pass."""
    expected = t["api_expected"].select(*by, F.col("order_id").cast("string").alias("record_key"))
    per_key = key_counts(expected, records.select(*by, "record_key"), ["record_key"], by=by)
    counts = {"missing_ids": missing_key(), "unexpected_ids": unexpected_key()}
    if unique:
        counts["duplicate_ids"] = duplicate_key()
    return sum_of(per_key, by, **counts)


def api_contract(t: Tables, by: By = (), labels=None) -> DataFrame:
    records = page_records(t["api_attempts"], by)
    return totals([wrong_status(t["api_attempts"], by), bad_records(records, by)], by, labels)


def api_pagination(t: Tables, by: By = (), labels=None) -> DataFrame:
    records = page_records(t["api_attempts"], by)
    return totals([wrong_status(t["api_attempts"], by), delivered_ids(t, records, by)], by, labels)


def api_retry(t: Tables, by: By = (), labels=None) -> DataFrame:
    records = page_records(t["api_attempts"], by)
    return totals([wrong_status(t["api_attempts"], by), delivered_ids(t, records, by, unique=False)], by, labels)


def ingest(records: DataFrame, by: By = (), replays: int = 2, idempotent: bool = True) -> DataFrame:
    """Load the well-typed records of one batch ``replays`` times.

    An idempotent load keeps the last record per order id, so repeating it changes
    nothing; an appending load repeats every row.
    """
    typed = typed_records(records, by)
    numbered = typed.withColumn("replay_no", F.explode(F.sequence(F.lit(1), F.lit(replays))))
    return latest_by(numbered, [*by, "order_id"], ["replay_no", "page", "pos"]) if idempotent else numbered


def loaded_orders(t: Tables, target: DataFrame, by: By = ()) -> DataFrame:
    """The last loaded row per order against the expected one, and orders loaded more than once."""
    last = target.groupBy(*by, "order_id").agg(
        F.count(F.lit(1)).alias("copies"),
        F.max(F.struct("replay_no", "page", "pos", "customer_id", "net_amount")).alias("last"),
    ).select(*by, "order_id", "last.customer_id", "last.net_amount", (F.col("copies") > 1).alias("repeated"))
    fields = ["customer_id", "net_amount"]
    expected = t["api_expected"].select(*by, "order_id", *fields, F.lit(False).alias("repeated"))
    rows = expected.withColumns({"n_expected": F.lit(1), "n_actual": F.lit(0)}).unionByName(
        last.withColumns({"n_expected": F.lit(0), "n_actual": F.lit(1)}))
    per_row = rows.groupBy(*by, "order_id", *fields).agg(
        *[F.sum(c).alias(c) for c in ("n_expected", "n_actual")], F.bool_or("repeated").alias("repeated"))
    per_order = per_row.groupBy(*by, "order_id").agg(
        F.sum("n_expected").alias("n_expected"), F.sum("n_actual").alias("n_actual"),
        F.sum(F.col("n_expected") * F.col("n_actual")).alias("n_equal"), F.bool_or("repeated").alias("repeated"))
    return sum_of(per_order, by, target_mismatch=difference(["order_id"]),
                  target_duplicates=F.col("repeated").cast("bigint"))


def api_ingestion(t: Tables, by: By = (), labels=None, idempotent: bool = True) -> DataFrame:
    records = page_records(t["api_attempts"], by)
    target = ingest(records, by, idempotent=idempotent)
    return totals([
        wrong_status(t["api_attempts"], by), delivered_ids(t, records, by), loaded_orders(t, target, by),
    ], by, labels)
