"""Registered queries against their SQL counterparts in DuckDB.

A cross-section runs by default; PLUMBLINE_ALL_QUERIES=1 runs every query.
"""

import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry
from plumbline.plans.inputs import BASE_TABLES
from plumbline.plans.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
SOME = (
    "daily_sales_reconciled", "c06_order_capstone", "c11_freshness", "f10_stale_versions", "f18_report_faults", "f20_expected_rules", "m08_compacted_log",
    "q04_schema", "q07_suite_problems", "q11_run_invariants", "s04_conflicting_commit", "c08_latest_version", "c10_incremental_load", "c13_type2_customers", "c16_quarantine",
    "c22_api_ingestion", "c23_lineage", "c26_copy_metrics", "c30_reference_freshness", "c36_access_contract", "f07_daily_and_mixed",
    "j10_interval_overlap_pairs", "m01_stream_merge", "m04_event_watermark_policy", "q06_field_evidence", "s02_order_generator",
    "s16_evidence_json", "s17_evidence_csv", "s21_page_records", "t04_half_subset", "v01_evidence_problems", "w03_next_start",
)

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not there")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in BASE_TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        return format(value.normalize(), "f") if value else "0"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def chosen():
    return sorted(ORACLES) if os.environ.get("PLUMBLINE_ALL_QUERIES") else SOME


@pytest.mark.parametrize("name", chosen())
def test_query_equals_its_sql(spark, duck, name):
    found = entry.queries()[name](spark, FOLDER)
    answer = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in answer.description]
    assert sorted(found.columns) == sorted(columns)
    assert rows_of(found.columns, found.collect()) == rows_of(columns, answer.fetchall())


def test_every_query_has_its_sql_and_every_check_is_registered():
    assert set(ORACLES) == set(QUERIES) <= set(entry.queries())
    assert {f"c{i:02d}" for i in range(1, 37)} <= {name[:3] for name in entry.queries()}


def test_entry_returns_rows(spark):
    rows = entry.entry(spark).collect()
    assert rows and all(r.agrees for r in rows)
