"""Published data against contracts that are authored, never derived from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.reconcile import diff_and_duplicates
from plumbline.operators.scope import By, attach, totals

Tables = dict[str, DataFrame]


def _against(expected: str, observed: str, keys: list[str], fields: list[str]):
    def check(t: Tables, by: By = (), labels=None) -> DataFrame:
        found = diff_and_duplicates(t[expected], t[observed], keys, fields, "contract_mismatch", "duplicate_keys", by)
        return totals([found], by, labels)

    check.__doc__ = f"Compare {observed} with {expected} by {', '.join(keys)}."
    return check


classification_contract = _against("db_contract", "db_publication", ["record_id"], ["classification", "amount"])
version_contract = _against("db_expected_after", "db_after", ["order_id"], ["version", "amount", "updated_at"])
fact_contract = _against("sy_expected_fact", "sy_fact", ["sale_id"], ["customer_key", "amount", "sale_date"])
report_contract = _against("sy_expected_report", "sy_report", ["sale_date", "region"], ["sale_count", "total"])
file_contract = _against("az_expected_files", "az_files", ["file_id"], ["path", "route", "byte_count"])


def access_contract(t: Tables, by: By = (), labels=None) -> DataFrame:
    """Required access against observed access; only a dated, allowed observation agrees."""
    fields = ["identity_id", "scope", "operation", "agreed"]
    observed = attach(t["az_access"], t["cloud_context"].select(*by, "as_of"), by)
    agreed = (F.col("outcome") == "ALLOWED") & (F.col("observed_at") <= F.col("as_of"))
    actual = observed.withColumn("agreed", F.coalesce(agreed, F.lit(False)))
    expected = t["az_required_access"].withColumn("agreed", F.lit(True))
    found = diff_and_duplicates(expected, actual, ["observation_id"], fields, "access_mismatch", "duplicate_keys", by)
    return totals([found], by, labels)
