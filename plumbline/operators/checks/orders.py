"""Completeness, values, duplicates, grain, latest version and UTC days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.exprs import net_amount
from plumbline.operators.reconcile import (
    diff_count, differing_pairs, duplicate_count, duplicate_key, inner_mismatch_count, key_counts, missing_key,
    unexpected_key,
)
from plumbline.operators.rollups import sum_by, utc_daily
from plumbline.operators.scope import By, count_where, sum_of, totals
from plumbline.operators.versions import latest_by

Tables = dict[str, DataFrame]
KEY = ["order_id"]


def _calculated(t: Tables, by: By) -> DataFrame:
    return t["source_orders"].select(*by, "order_id", net_amount().alias("net_amount"))


def _daily(t: Tables, by: By) -> DataFrame:
    fields = ["order_count", "net_revenue"]
    return diff_count(t["gold_daily_sales"], t["target_daily_sales"], ["order_date"], fields, by, "daily_mismatch")


def key_completeness(t: Tables, by: By = (), labels=None) -> DataFrame:
    """Keys missing from the target plus keys the source never had; equal counts prove nothing."""
    per_key = key_counts(t["source_orders"], t["target_orders"], KEY, by=by)
    return totals([sum_of(per_key, by, missing_keys=missing_key(), unexpected_keys=unexpected_key())], by, labels)


def positive_customer(t: Tables, by: By = (), labels=None) -> DataFrame:
    """Target rows whose customer id is zero or negative."""
    return totals([count_where(t["target_orders"], by, non_positive_customer=F.col("customer_id") <= 0)], by, labels)


def net_present(t: Tables, by: By = (), labels=None) -> DataFrame:
    """Target rows without a net amount; zero is a valid amount."""
    return totals([count_where(t["target_orders"], by, null_net_amount=F.col("net_amount").isNull())], by, labels)


def unique_orders(t: Tables, by: By = (), labels=None) -> DataFrame:
    """Order keys that occur more than once in the target."""
    return totals([duplicate_count(t["target_orders"], KEY, by, "duplicate_keys")], by, labels)


def net_calculation(t: Tables, by: By = (), labels=None) -> DataFrame:
    """Joined orders whose net amount is not gross less discount less refund."""
    wrong = inner_mismatch_count(_calculated(t, by), t["target_orders"], KEY, ["net_amount"], by, "wrong_net_amount")
    return totals([wrong], by, labels)


def order_capstone(t: Tables, by: By = (), labels=None) -> DataFrame:
    """Keys, nulls, duplicates, calculation and daily totals; defects add up.

    The first four come from one pass over both order tables.
    """
    per_key = key_counts(_calculated(t, by), t["target_orders"], KEY, ["net_amount"], by, absent="net_amount")
    orders = sum_of(
        per_key, by, missing_keys=missing_key(), unexpected_keys=unexpected_key(), null_net_amount=F.col("n_absent"),
        duplicate_keys=duplicate_key(), wrong_net_amount=differing_pairs(KEY),
    )
    return totals([orders, _daily(t, by)], by, labels)


def join_grain(t: Tables, by: By = (), labels=None) -> DataFrame:
    """Order totals from lines alone; payments have another grain and stay out."""
    expected = sum_by(t["order_lines"], [*by, "order_id"], "net_amount")
    return totals([diff_count(expected, t["target_order_totals"], KEY, ["net_amount"], by, "total_mismatch")], by, labels)


def latest_version(t: Tables, by: By = (), labels=None) -> DataFrame:
    expected = latest_by(t["source_order_events"], [*by, "order_id"], ["updated_at", "event_id"])
    fields = ["event_id", "updated_at", "net_amount"]
    return totals([diff_count(expected, t["target_current_orders"], KEY, fields, by, "version_mismatch")], by, labels)


def utc_days(t: Tables, by: By = (), labels=None) -> DataFrame:
    expected = utc_daily(t["source_time_orders"], by=by)
    fields = ["order_count", "net_revenue"]
    return totals([diff_count(expected, t["target_utc_daily"], ["order_date"], fields, by, "day_mismatch")], by, labels)
