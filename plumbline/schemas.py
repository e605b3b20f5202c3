"""Declared table schemas: Spark type names, with ``!`` after a required column."""

from __future__ import annotations

import re

from pyspark.sql import types as T

MONEY = "decimal(14,2)"
TOTAL = "decimal(18,2)"

_RECORD = f"order_id bigint, customer_id bigint, amount {MONEY}, updated_at timestamp, event_id bigint, batch_no int, run_id string"
_VERSION = f"order_id bigint, version bigint, amount {MONEY}, updated_at timestamp"
_FACT = f"sale_id bigint, customer_key bigint, amount {MONEY}, sale_date date"
_REPORT = f"sale_date date, region string, sale_count bigint, total {MONEY}"
_FILE = "file_id string, path string, route string, byte_count bigint"
_ACCESS = "observation_id string, identity_id string, scope string, operation string"
_CHANGE = "event_id bigint, customer_id bigint, effective_at timestamp, tier string"
_DAILY = f"order_date date, order_count bigint, net_revenue {TOTAL}"

# Layers of the orders run. Required columns are those declared "not null".
LAYERS = {
    "source.customers": "customer_id bigint!, country_code string!",
    "source.orders": f"order_id bigint!, customer_id bigint!, ordered_at timestamp!, gross_amount {MONEY}!, "
                     f"discount_amount {MONEY}!, refund_amount {MONEY}!, updated_at timestamp!",
    "bronze.orders": f"run_id string!, order_id bigint!, customer_id bigint!, ordered_at timestamp!, gross_amount {MONEY}!, "
                     f"discount_amount {MONEY}!, refund_amount {MONEY}!, updated_at timestamp!, ingested_at timestamp!",
    "silver.orders": f"run_id string!, order_id bigint!, customer_id bigint!, ordered_at timestamp!, gross_amount {MONEY}!, "
                     f"discount_amount {MONEY}!, refund_amount {MONEY}!, net_amount {MONEY}!, updated_at timestamp!",
    "gold.daily_sales": f"run_id string!, order_date date!, order_count bigint!, gross_revenue {TOTAL}!, net_revenue {TOTAL}!",
    "target.orders_report": f"run_id string!, order_id bigint!, customer_id bigint!, ordered_at timestamp!, net_amount {MONEY}!",
    "target.daily_sales_report": f"run_id string!, order_date date!, order_count bigint!, net_revenue {TOTAL}!",
    "fault_workspace.orders_report": f"run_id string!, order_id bigint, customer_id bigint, ordered_at timestamp, net_amount {MONEY}",
    "fault_workspace.daily_sales_report": f"run_id string!, order_date date, order_count bigint, net_revenue {TOTAL}",
    "metadata.pipeline_runs": "run_id string!, pipeline_id string!, execution_status string!, data_quality_status string!, "
                              "started_at timestamp!, completed_at timestamp, error string, recorded_at timestamp!",
    "metadata.stage_runs": "run_id string!, stage_name string!, execution_status string!, row_count bigint, metrics string!, "
                           "started_at timestamp!, completed_at timestamp!, error string",
    "metadata.validation_runs": "validation_run_id string!, pipeline_run_id string!, suite_id string!, status string!, "
                                "started_at timestamp!, completed_at timestamp, recorded_at timestamp!",
    "metadata.validation_results": "validation_run_id string!, rule_id string!, dataset_id string!, check_type string!, "
                                   "status string!, expected string!, actual string!, evidence array<string>!, error string",
    "metadata.fault_runs": "fault_run_id string!, pipeline_run_id string!, scenario_id string!, status string!, "
                           "mutation_evidence string!, validation_run_id string, applied_at timestamp!, reset_at timestamp, "
                           "recorded_at timestamp!",
}

# Tables the named checks read.
TABLES = {
    "source_orders": f"order_id bigint, customer_id bigint, ordered_at timestamp, gross_amount {MONEY}, "
                     f"discount_amount {MONEY}, refund_amount {MONEY}, updated_at timestamp",
    "target_orders": f"order_id bigint, customer_id bigint, ordered_at timestamp, net_amount {MONEY}",
    "gold_daily_sales": _DAILY,
    "target_daily_sales": _DAILY,
    "lab_context": "lab_id string, as_of timestamp",
    "order_lines": f"order_id bigint, line_id bigint, net_amount {MONEY}",
    "order_payments": f"order_id bigint, payment_id bigint, paid_amount {MONEY}",
    "target_order_totals": f"order_id bigint, net_amount {MONEY}",
    "source_order_events": f"event_id bigint, order_id bigint, updated_at timestamp, net_amount {MONEY}",
    "target_current_orders": f"event_id bigint, order_id bigint, updated_at timestamp, net_amount {MONEY}",
    "source_time_orders": f"order_id bigint, ordered_at timestamp, net_amount {MONEY}",
    "target_utc_daily": _DAILY,
    "incremental_events": f"event_id bigint, order_id bigint, event_at timestamp, arrived_at timestamp, net_amount {MONEY}, batch_no int",
    "incremental_target": f"event_id bigint, order_id bigint, event_at timestamp, net_amount {MONEY}",
    "incremental_steps": "step_no int, batch_no int, operation string, execution_status string, selected_events bigint, "
                         "target_rows bigint, watermark timestamp",
    "freshness_requirements": "dataset_id string, as_of timestamp, sla_minutes int",
    "freshness_observations": "dataset_id string, last_success_at timestamp, last_event_at timestamp, execution_status string",
    "source_customer_changes": _CHANGE,
    "target_customers_current": _CHANGE,
    "target_customer_history": "version_id bigint, customer_id bigint, tier string, valid_from timestamp, valid_to timestamp, "
                               "is_current boolean",
    "etl_context": "lab_id string, as_of timestamp, batch_no int",
    "etl_customers": "customer_code string, customer_id bigint",
    "etl_source": "order_id bigint, customer_code string, gross_text string, discount_text string, arrived_batch int, event_id bigint",
    "etl_target": f"order_id bigint, customer_id bigint, net_amount {TOTAL}, event_id bigint",
    "etl_rejects": "order_id bigint, reason string",
    "etl_steps": "step_no int, operation string, execution_status string, target_rows bigint, rejected_rows bigint, checkpoint int",
    "api_expected": f"order_id bigint, customer_id bigint, net_amount {TOTAL}",
    "api_target": f"order_id bigint, customer_id bigint, net_amount {TOTAL}",
    "api_attempts": "page bigint, attempt int, status int, headers string, elapsed_ms bigint, final boolean, body string",
    "cloud_context": "lab_id string, batch_no int, as_of timestamp, provider string, resource_id string, provenance string, "
                     "captured_at timestamp, mapping_version int",
    "cloud_runs": "run_id string, execution_status string, started_at timestamp, ended_at timestamp, raw_evidence string",
    "cloud_activities": "activity_id string, run_id string, dependency_id string, execution_status string, source_dataset string, "
                        "target_dataset string, rows_read bigint, rows_written bigint, raw_evidence string",
    "cloud_source": _RECORD,
    "cloud_bronze": _RECORD,
    "cloud_silver": _RECORD,
    "cloud_target": _RECORD,
    "cloud_schema": "dataset string, column_name string, data_type string",
    "cloud_expected_schema": "dataset string, column_name string, data_type string",
    "cloud_manifest": "partition_key string, file_key string, row_count bigint, snapshot_at timestamp, run_id string",
    "cloud_expected_partitions": "partition_key string, row_count bigint",
    "cloud_references": "dataset_id string, reference_id string, observed_at timestamp, run_id string",
    "cloud_required_references": "dataset_id string, reference_id string, sla_minutes int",
    "cloud_steps": "step_no int, operation string, run_id string, execution_status string, batch_no int, target_rows bigint, "
                   "watermark timestamp",
    "db_source": f"record_id bigint, customer_id bigint, amount {MONEY}, observed_at timestamp, run_id string",
    "db_contract": f"record_id bigint, classification string, amount {MONEY}",
    "db_publication": f"record_id bigint, classification string, amount {MONEY}, run_id string",
    "db_before": f"{_VERSION}, run_id string",
    "db_incoming": f"{_VERSION}, run_id string",
    "db_expected_after": _VERSION,
    "db_after": f"{_VERSION}, run_id string",
    "sy_staging": f"sale_id bigint, customer_code string, amount {MONEY}, sale_date date, run_id string",
    "sy_dimension": "customer_code string, customer_key bigint, region string, run_id string",
    "sy_expected_fact": _FACT,
    "sy_fact": f"{_FACT}, run_id string",
    "sy_expected_report": _REPORT,
    "sy_report": f"{_REPORT}, run_id string",
    "az_expected_files": _FILE,
    "az_files": f"{_FILE}, observed_at timestamp, run_id string",
    "az_required_access": _ACCESS,
    "az_access": f"{_ACCESS}, outcome string, observed_at timestamp, run_id string",
}

# Contract tables: authored apart from the data, so evidence may never supply them.
CONTRACT_TABLES = (
    "db_contract", "db_expected_after", "sy_expected_fact", "sy_expected_report", "az_expected_files", "az_required_access",
)


_TYPES = {
    "bigint": T.LongType(), "int": T.IntegerType(), "string": T.StringType(), "boolean": T.BooleanType(),
    "date": T.DateType(), "timestamp": T.TimestampType(), "array<string>": T.ArrayType(T.StringType()),
    MONEY: T.DecimalType(14, 2), TOTAL: T.DecimalType(18, 2),
}


def struct(name: str) -> T.StructType:
    """Schema of a table; layer names contain a dot. Needs no running session."""
    fields = []
    for part in re.split(r",\s*(?![0-9])", LAYERS[name] if name in LAYERS else TABLES[name]):
        column, type_text = part.split()
        fields.append(T.StructField(column, _TYPES[type_text.rstrip("!")], not type_text.endswith("!")))
    return T.StructType(fields)


def type_name(data_type: T.DataType) -> str:
    """Type name a schema rule compares: decimals without precision, times with their zone."""
    if isinstance(data_type, T.DecimalType):
        return "numeric"
    if isinstance(data_type, T.TimestampType):
        return "timestamp with time zone"
    return {"string": "text", "int": "integer"}.get(data_type.simpleString(), data_type.simpleString())
