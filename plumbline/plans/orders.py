"""The layered orders run: source, bronze, silver, gold, target, with a stage log."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.exprs import net_amount
from plumbline.operators.previews import latest_success
from plumbline.operators.rollups import stage_metrics, utc_daily_sales
from plumbline.operators.rules import to_json
from plumbline.operators.versions import latest_by
from plumbline.sources.store import Store, now

ORDERS_RUN = "orders_v1"
STAGES = ("SOURCE", "BRONZE", "SILVER", "GOLD", "TARGET")


class StageFailed(RuntimeError):
    """A stage raised; the stage and the run are on record as FAILED."""


@dataclass(frozen=True)
class StageOutcome:
    name: str
    row_count: int
    metrics: dict


def bronze_rows(source: DataFrame) -> DataFrame:
    return source.withColumn("ingested_at", F.current_timestamp())


def silver_rows(bronze: DataFrame) -> DataFrame:
    return bronze.withColumn("net_amount", net_amount())


def gold_rows(silver: DataFrame) -> DataFrame:
    return utc_daily_sales(silver)


def order_report(silver: DataFrame) -> DataFrame:
    return silver.select("order_id", "customer_id", "ordered_at", "net_amount")


def daily_report(gold: DataFrame) -> DataFrame:
    return gold.select("order_date", "order_count", "net_revenue")


def seed_source(store: Store, customers: DataFrame, orders: DataFrame) -> None:
    store.write("source.customers", customers)
    store.write("source.orders", orders)


def _total(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0)).cast("decimal(18,2)").alias("net_revenue")


def _rows() -> Column:
    return F.count(F.lit(1)).alias("row_count")


def _source(store: Store, run_id: str) -> StageOutcome:
    m = stage_metrics(store.read("source.orders").withColumn("net_amount", net_amount())).first()
    return StageOutcome("SOURCE", m.row_count, {"net_revenue": str(m.net_revenue)})


def _bronze(store: Store, run_id: str) -> StageOutcome:
    m = store.write_run("bronze.orders", bronze_rows(store.read("source.orders")), run_id, _rows())
    return StageOutcome("BRONZE", m["row_count"], {})


def _silver(store: Store, run_id: str) -> StageOutcome:
    m = store.write_run("silver.orders", silver_rows(store.read_run("bronze.orders", run_id)), run_id, _rows(), _total("net_amount"))
    return StageOutcome("SILVER", m["row_count"], {"net_revenue": str(m["net_revenue"])})


def _gold(store: Store, run_id: str) -> StageOutcome:
    orders = F.coalesce(F.sum("order_count"), F.lit(0)).alias("orders")
    m = store.write_run("gold.daily_sales", gold_rows(store.read_run("silver.orders", run_id)), run_id, _rows(), orders, _total("net_revenue"))
    return StageOutcome("GOLD", m["row_count"], {"order_count": m["orders"], "net_revenue": str(m["net_revenue"]), "grain": "UTC day"})


def _target(store: Store, run_id: str) -> StageOutcome:
    m = store.write_run("target.orders_report", order_report(store.read_run("silver.orders", run_id)), run_id, _rows(), _total("net_amount"))
    days = store.write_run("target.daily_sales_report", daily_report(store.read_run("gold.daily_sales", run_id)), run_id, _rows())
    return StageOutcome("TARGET", m["row_count"], {"daily_rows": days["row_count"], "net_revenue": str(m["net_revenue"])})


STAGE_STEPS: dict[str, Callable[[Store, str], StageOutcome]] = {
    "SOURCE": _source, "BRONZE": _bronze, "SILVER": _silver, "GOLD": _gold, "TARGET": _target,
}


def log_run(store: Store, run_id: str, execution: str, quality: str, started, completed=None, error=None) -> None:
    store.append("metadata.pipeline_runs", [{
        "run_id": run_id, "pipeline_id": ORDERS_RUN, "execution_status": execution, "data_quality_status": quality,
        "started_at": started, "completed_at": completed, "error": error, "recorded_at": now(),
    }])


def log_stage(store: Store, run_id: str, name: str, status: str, started, outcome=None, error=None) -> None:
    store.append("metadata.stage_runs", [{
        "run_id": run_id, "stage_name": name, "execution_status": status,
        "row_count": outcome.row_count if outcome else None, "metrics": to_json(outcome.metrics if outcome else {}),
        "started_at": started, "completed_at": now(), "error": error,
    }])


def run_orders(store: Store, run_id: str | None = None, steps=None) -> tuple[str, list[StageOutcome]]:
    """Run every stage; each reads what the stage before it has written.

    Execution status says whether the run worked. Quality status stays NOT_RUN: a
    run that worked can still have produced wrong data.
    """
    run_id = run_id or uuid.uuid4().hex
    started = now()
    log_run(store, run_id, "RUNNING", "NOT_RUN", started)
    outcomes = []
    for name, step in (steps or STAGE_STEPS).items():
        stage_started = now()
        try:
            outcome = step(store, run_id)
        except Exception as problem:
            message = f"{type(problem).__name__}: {problem}"
            log_stage(store, run_id, name, "FAILED", stage_started, error=message)
            log_run(store, run_id, "FAILED", "NOT_RUN", started, now(), message)
            raise StageFailed(f"run {run_id} failed at {name}: {message}") from problem
        log_stage(store, run_id, name, "SUCCESS", stage_started, outcome)
        outcomes.append(outcome)
    log_run(store, run_id, "SUCCESS", "NOT_RUN", started, now())
    return run_id, outcomes


def current_runs(store: Store) -> DataFrame:
    """The latest log row of every run."""
    return latest_by(store.read("metadata.pipeline_runs"), ["run_id"], ["recorded_at"])


def inspect_run(store: Store, run_id: str | None = None) -> dict | None:
    runs = current_runs(store)
    chosen = runs.where(F.col("run_id") == run_id) if run_id else runs
    found = chosen.orderBy(F.col("started_at").desc()).limit(1).collect()
    if not found:
        return None
    run = found[0].asDict()
    stages = store.read("metadata.stage_runs").where(F.col("run_id") == run["run_id"]).orderBy("started_at")
    run.pop("recorded_at")
    return {**run, "stages": [{k: v for k, v in r.asDict().items() if k != "run_id"} for r in stages.collect()]}


def resolve_success(store: Store, run_id: str | None = None) -> str | None:
    runs = current_runs(store)
    chosen = runs.where(F.col("run_id") == run_id) if run_id else runs
    found = latest_success(chosen).collect()
    return found[0].run_id if found else None


def stage_count(store: Store, run_id: str, stage_name: str) -> int | None:
    rows = store.read("metadata.stage_runs").where(
        (F.col("run_id") == run_id) & (F.col("stage_name") == stage_name) & (F.col("execution_status") == "SUCCESS")
    )
    found = rows.orderBy(F.col("completed_at").desc()).limit(1).collect()
    return found[0].row_count if found else None


def order_snapshot(store: Store, run_id: str) -> dict[str, DataFrame]:
    """The four order tables of one run, as the checks C01-C06 read them."""
    columns = ["order_id", "customer_id", "ordered_at", "gross_amount", "discount_amount", "refund_amount", "updated_at"]
    source = store.read_run("bronze.orders", run_id).select(*columns)
    if source.limit(2).count() < 2:
        raise LookupError("checks need a successful run with at least two orders")
    daily = ["order_date", "order_count", "net_revenue"]
    return {
        "source_orders": source,
        "target_orders": store.read_run("target.orders_report", run_id).drop("run_id"),
        "gold_daily_sales": store.read_run("gold.daily_sales", run_id).select(*daily),
        "target_daily_sales": store.read_run("target.daily_sales_report", run_id).select(*daily),
    }
