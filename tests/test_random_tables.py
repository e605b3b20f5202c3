"""Every check on random tables full of nulls, ties, repeats and gaps, against its model in plain Python."""

import random
from datetime import datetime, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from plumbline import schemas
from plumbline.operators.checks import CHECKS
from tests.fixtures import READS
from tests.model import MODELS

SEEDS = range(5)
CLOCK = datetime(2033, 8, 9, 6, 30)
STATUS = ("SUCCESS", "SUCCESS", "SUCCESS", "FAILED", "UNKNOWN")
# What columns hold, where the type alone wouldn't let keys meet or states occur.
WORDS = {
    "execution_status": STATUS, "tier": ("free", "plus", "team"), "dataset_id": ("ledger", "stock"), "reference_id": ("x", "y"),
    "customer_code": ("k1", "k2", "k3"), "gross_text": ("5", "7.5", "12.25"), "discount_text": ("0", "0.25"), "reason": ("INVALID_AMOUNT", "OTHER"),
    "activity_id": ("load", "copy", "send"), "dependency_id": ("load", "copy"), "run_id": ("r1", "r2"), "target_dataset": ("target", "bronze"),
    "source_dataset": ("source",), "dataset": ("target",), "data_type": ("text", "bigint"), "partition_key": ("p1", "p2", "p3"),
    "outcome": ("ALLOWED", "ALLOWED", "DENIED"), "classification": ("ACCEPTED", "REJECTED"), "region": ("east", "west"),
}
ONE_ROW = ("lab_context", "etl_context", "cloud_context")
NEVER_NULL = ("event_id", "version_id", "gross_text", "discount_text", "batch_no", "as_of")


def value(rng, table, column, serial):
    if column.name in ("event_id", "version_id") and table not in ("target_current_orders", "incremental_target"):
        return serial
    if rng.random() < 0.06 and column.name not in NEVER_NULL and table not in ONE_ROW:
        return None
    kind = column.dataType.simpleString()
    if column.name in WORDS:
        return rng.choice(WORDS[column.name])
    if kind == "string":
        return rng.choice(["a", "b", "c", "d"])
    if kind.startswith("decimal"):
        return D(rng.choice(["0.00", "5.00", "7.25", "7.50", "12.25"]))
    if kind == "timestamp":
        return CLOCK if table in ONE_ROW else CLOCK + timedelta(minutes=rng.choice([-90, -60, -60, -30, -1, 0, 0, 1]))
    if kind == "date":
        return CLOCK.date() + timedelta(days=rng.randrange(-1, 2))
    if kind == "boolean":
        return rng.random() < 0.5
    if column.name == "sla_minutes":
        return rng.choice([30, 60, 90])
    if column.name in ("step_no", "batch_no", "arrived_batch", "checkpoint"):
        return rng.randrange(0, 4)
    if column.name == "customer_id":
        return rng.randrange(-1, 4)
    return rng.randrange(1, 6)


def random_rows(rng, table):
    columns = list(schemas.struct(table))
    count = 1 if table in ONE_ROW else rng.randrange(0, 9)
    rows = [tuple(value(rng, table, c, serial) for c in columns) for serial in range(1, count + 1)]
    if rows and table not in ONE_ROW and rng.random() < 0.4 and not {"event_id", "version_id"} & {c.name for c in columns}:
        rows.append(rng.choice(rows))
    return rows


def copied(rng, rows, names_from, names_to, chance=0.6):
    """Some rows of one table as rows of another one, so that agreement occurs as well."""
    return [tuple(dict(zip(names_from, r)).get(n) for n in names_to) for r in rows if rng.random() < chance]


AGREEING = {
    "target_current_orders": "source_order_events", "incremental_target": "incremental_events", "target_customers_current": "source_customer_changes",
    "target_daily_sales": "gold_daily_sales", "db_publication": "db_contract", "db_after": "db_expected_after", "sy_fact": "sy_expected_fact",
    "sy_report": "sy_expected_report", "az_files": "az_expected_files", "cloud_schema": "cloud_expected_schema", "cloud_target": "cloud_source",
    "cloud_bronze": "cloud_source", "cloud_silver": "cloud_source",
}


def random_tables(rng, names):
    made = {}
    for name in sorted(names, key=lambda n: n in AGREEING):
        rows = random_rows(rng, name)
        if AGREEING.get(name) in made:
            origin = AGREEING[name]
            rows = copied(rng, made[origin], [c.name for c in schemas.struct(origin)], [c.name for c in schemas.struct(name)]) + rows[:2]
        made[name] = rows
    return made


@pytest.mark.parametrize("check", sorted(MODELS))
def test_counts_equal_the_model(spark, check):
    """All seeds run as one labelled job, one of them with empty tables."""
    cases = {}
    for seed in SEEDS:
        rng = random.Random(f"{check}{seed}")
        cases[f"s{seed}"] = random_tables(rng, READS[check])
    cases["empty"] = {n: random_rows(random.Random(0), n) if n in ONE_ROW else [] for n in READS[check]}
    tables = {}
    for name in READS[check]:
        schema = schemas.struct(name)
        rows = [(label, *row) for label, made in cases.items() for row in made[name]]
        tables[name] = spark.createDataFrame(rows, f"variant_id string, {', '.join(f'{c.name} {c.dataType.simpleString()}' for c in schema)}")
    labels = spark.createDataFrame([(label,) for label in cases], "variant_id string")
    found = {r.variant_id: r.violation_count for r in CHECKS[check](tables, by=("variant_id",), labels=labels).collect()}
    expected = {}
    for label, made in cases.items():
        expected[label] = int(MODELS[check]({n: [dict(zip((c.name for c in schemas.struct(n)), r)) for r in rows] for n, rows in made.items()}))
    assert found == expected
    one = {n: df.where(F.col("variant_id") == "s1").drop("variant_id") for n, df in tables.items()}
    assert CHECKS[check](one).first().violation_count == expected["s1"]


def test_utc_days_do_not_follow_the_session_zone(spark):
    orders = spark.createDataFrame([(i, CLOCK + timedelta(hours=7 * i), D(i)) for i in range(9)], "order_id long, ordered_at timestamp, net_amount decimal(14,2)")
    daily = spark.createDataFrame([], schemas.struct("target_utc_daily"))
    days = len({(CLOCK + timedelta(hours=7 * i)).date() for i in range(9)})
    spark.conf.set("spark.sql.session.timeZone", "America/Lima")
    try:
        assert CHECKS["C09"]({"source_time_orders": orders, "target_utc_daily": daily}).first().violation_count == days
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
