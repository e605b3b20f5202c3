"""Run a suite over one run's layers, keep every result, set only the quality status."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.contracts import CheckResult, Dataset, QualityStatus, Suite, suite_problems, worst
from plumbline.operators.rules import Catalog, execute_rules, to_json
from plumbline.operators.versions import latest_by
from plumbline.plans.orders import current_runs, log_run, resolve_success, stage_count
from plumbline.plans.suites import ORDERS_DATASETS, ORDERS_SUITE
from plumbline.sources.store import Store, now


class RunNotReady(LookupError):
    """No successful run to check."""


class StoreSource:
    """Rules over the layer tables of one run."""

    def __init__(self, store: Store, run_id: str):
        self.store, self.run_id = store, run_id

    def frame(self, spec: Dataset) -> DataFrame:
        return self.store.read_run(spec.table, self.run_id) if spec.run_scoped else self.store.read(spec.table)

    def columns(self, spec: Dataset):
        return self.store.columns(spec.table, self.run_id if spec.run_scoped else None)

    def stage_count(self, stage_name: str) -> int | None:
        return stage_count(self.store, self.run_id, stage_name)


@dataclass(frozen=True)
class QualityRun:
    validation_run_id: str
    run_id: str
    suite_id: str
    status: QualityStatus
    results: tuple[CheckResult, ...]


def run_quality_suite(store: Store, run_id: str | None = None, suite: Suite = ORDERS_SUITE,
                      registry: Catalog = ORDERS_DATASETS) -> QualityRun:
    if problems := suite_problems(suite, registry):
        raise ValueError(problems)
    resolved = resolve_success(store, run_id)
    if resolved is None:
        raise RunNotReady("no matching successful run")
    validation_id, started = uuid.uuid4().hex, now()

    def log(status: str, completed=None) -> None:
        store.append("metadata.validation_runs", [{
            "validation_run_id": validation_id, "pipeline_run_id": resolved, "suite_id": suite.id, "status": status,
            "started_at": started, "completed_at": completed, "recorded_at": now(),
        }])

    log("RUNNING")
    results = execute_rules(suite.rules, StoreSource(store, resolved), registry)
    status = worst(r.status for r in results)
    if results:
        store.append("metadata.validation_results", [{
            "validation_run_id": validation_id, "rule_id": r.rule.id, "dataset_id": r.rule.dataset_id,
            "check_type": str(r.rule.check_type), "status": str(r.status), "expected": to_json(r.expected),
            "actual": to_json(r.actual), "evidence": [to_json(e) for e in r.evidence], "error": r.error,
        } for r in results])
    log(str(status), now())
    run = current_runs(store).where(F.col("run_id") == resolved).first()
    log_run(store, resolved, run.execution_status, str(status), run.started_at, run.completed_at, run.error)
    return QualityRun(validation_id, resolved, suite.id, status, tuple(results))


def inspect_quality(store: Store, run_id: str | None = None) -> dict | None:
    """The latest validation run, of one run or of all, with its results by rule id."""
    runs = latest_by(store.read("metadata.validation_runs"), ["validation_run_id"], ["recorded_at"])
    chosen = runs.where(F.col("pipeline_run_id") == run_id) if run_id else runs
    found = chosen.orderBy(F.col("started_at").desc()).limit(1).collect()
    if not found:
        return None
    run = found[0].asDict()
    run.pop("recorded_at")
    rows = store.read("metadata.validation_results").where(
        F.col("validation_run_id") == run["validation_run_id"]
    ).orderBy("rule_id").collect()
    return {**run, "results": [{k: v for k, v in r.asDict().items() if k != "validation_run_id"} for r in rows]}
