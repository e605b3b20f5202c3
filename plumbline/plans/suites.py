"""The built-in rule suites of the orders layers."""

from __future__ import annotations

from plumbline import schemas
from plumbline.contracts import Dataset, Suite, catalog, not_null, record_count, same_fields, same_keys, schema_of, unique


def _datasets(target_schema: str) -> dict[str, Dataset]:
    return catalog(
        Dataset("bronze_orders", "bronze.orders"),
        Dataset("silver_orders", "silver.orders"),
        Dataset("gold_daily_sales", "gold.daily_sales", counted_by="order_count"),
        Dataset("target_orders", f"{target_schema}.orders_report"),
        Dataset("target_daily_sales", f"{target_schema}.daily_sales_report", counted_by="order_count"),
    )


ORDERS_DATASETS = _datasets("target")
# Fault runs check the damaged copies instead of the published reports.
FAULT_DATASETS = _datasets("fault_workspace")

# Rule ids, keys and required columns of the suite.
_UNIQUE = {
    "unique_bronze_order_id": ("bronze_orders", "order_id"),
    "unique_silver_order_id": ("silver_orders", "order_id"),
    "unique_gold_order_date": ("gold_daily_sales", "order_date"),
    "unique_target_order_id": ("target_orders", "order_id"),
    "unique_target_order_date": ("target_daily_sales", "order_date"),
}
_REQUIRED = {
    "required_bronze": ("bronze_orders", (
        "order_id", "customer_id", "ordered_at", "gross_amount", "discount_amount", "refund_amount", "updated_at")),
    "required_silver": ("silver_orders", ("order_id", "customer_id", "ordered_at", "net_amount")),
    "required_gold": ("gold_daily_sales", ("order_date", "order_count", "net_revenue")),
    "required_target_orders": ("target_orders", ("order_id", "customer_id", "ordered_at", "net_amount")),
    "required_target_daily": ("target_daily_sales", ("order_date", "order_count", "net_revenue")),
}
_SCHEMA = {
    "schema_bronze_orders": "bronze_orders",
    "schema_silver_orders": "silver_orders",
    "schema_gold_daily_sales": "gold_daily_sales",
    "schema_target_orders": "target_orders",
    "schema_target_daily": "target_daily_sales",
}
# (name of the pair, source, target, key, compared columns)
_PAIRS = (
    ("bronze_to_silver", "bronze_orders", "silver_orders", "order_id",
     ("customer_id", "ordered_at", "gross_amount", "discount_amount", "refund_amount", "updated_at")),
    ("silver_to_target_orders", "silver_orders", "target_orders", "order_id",
     ("customer_id", "ordered_at", "net_amount")),
    ("gold_to_target_daily", "gold_daily_sales", "target_daily_sales", "order_date",
     ("order_count", "net_revenue")),
)


def _expected_columns(dataset_id: str) -> list[tuple[str, str, bool]]:
    declared = schemas.struct(ORDERS_DATASETS[dataset_id].table)
    return [(f.name, schemas.type_name(f.dataType), f.nullable) for f in declared]


BASIC_SUITE = Suite("orders_basic_v1", (
    *(record_count(f"count_{d}", d) for d in ORDERS_DATASETS),
    *(unique(rule, dataset, columns=(key,)) for rule, (dataset, key) in _UNIQUE.items()),
    *(not_null(rule, dataset, columns=columns) for rule, (dataset, columns) in _REQUIRED.items()),
    *(schema_of(rule, dataset, columns=_expected_columns(dataset)) for rule, dataset in _SCHEMA.items()),
))

RECONCILIATION_RULES = tuple(
    rule
    for name, source, target, key, fields in _PAIRS
    for rule in (
        same_keys(f"keys_{name}", source, target, key=(key,)),
        same_fields(f"fields_{name}", source, target, key=(key,), fields=[(f, f) for f in fields]),
    )
)

ORDERS_SUITE = Suite("orders_quality_v2", BASIC_SUITE.rules + RECONCILIATION_RULES)

# The damaged copies are nullable on purpose, so their schema rules are left out.
FAULT_SUITE = Suite("orders_fault_v1", tuple(
    rule for rule in ORDERS_SUITE.rules if rule.id not in ("schema_target_orders", "schema_target_daily")
))

# The rules each fault has to fail.
EXPECTED_FAILURES = {
    "missing_order": ("count_target_orders", "keys_silver_to_target_orders"),
    "duplicate_order": ("count_target_orders", "unique_target_order_id"),
    "null_net_amount": ("required_target_orders", "fields_silver_to_target_orders"),
    "wrong_net_amount": ("fields_silver_to_target_orders",),
}
