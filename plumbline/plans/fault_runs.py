"""Fault lifecycle: damage a copy of one run's reports, check it, reset it."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from plumbline.operators.faults import inject
from plumbline.operators.reconcile import duplicate_groups
from plumbline.operators.rules import to_json
from plumbline.operators.versions import latest_by
from plumbline.plans.orders import resolve_success
from plumbline.plans.quality import QualityRun, run_quality_suite
from plumbline.plans.suites import EXPECTED_FAILURES, FAULT_DATASETS, FAULT_SUITE
from plumbline.sources.commits import CommitConflict
from plumbline.sources.store import Store, now

REPORTS = {
    "target.orders_report": "fault_workspace.orders_report",
    "target.daily_sales_report": "fault_workspace.daily_sales_report",
}
# What each fault does to the lowest order.
ACTIONS = {
    "missing_order": "DELETE", "duplicate_order": "INSERT_DUPLICATE", "null_net_amount": "SET_NULL",
    "wrong_net_amount": "ADD_0_01",
}


class FaultState(ValueError):
    """The fault cannot go from its state to the one asked for."""


def current_faults(store: Store):
    return latest_by(store.read("metadata.fault_runs"), ["fault_run_id"], ["recorded_at"])


def active_conflicts(store: Store):
    """Runs with more than one applied fault; there must be none."""
    return duplicate_groups(current_faults(store).where(F.col("status") == "APPLIED"), ["pipeline_run_id"])


def inspect_fault(store: Store, fault_run_id: str | None = None) -> dict | None:
    faults = current_faults(store)
    chosen = faults.where(F.col("fault_run_id") == fault_run_id) if fault_run_id else faults
    found = chosen.orderBy(F.col("applied_at").desc()).limit(1).collect()
    return found[0].asDict() if found else None


def _log(store: Store, fault: dict) -> dict:
    row = {**fault, "recorded_at": now()}
    store.append("metadata.fault_runs", [row])
    return row


def _claim(store: Store, run_id: str, fault_run_id: str) -> None:
    claims = store.commits(f"faults/{run_id}")
    held = claims.head()
    if held and held.body["holder"]:
        raise FaultState(f"run {run_id} already has an applied fault")
    try:
        claims.commit({"holder": fault_run_id}, held.number if held else 0)
    except CommitConflict as lost:
        raise FaultState(f"run {run_id} already has an applied fault") from lost


def _release(store: Store, run_id: str, fault_run_id: str) -> None:
    held = store.commits(f"faults/{run_id}").head()
    if held and held.body["holder"] == fault_run_id:
        store.commits(f"faults/{run_id}").commit({"holder": None}, held.number)


def _evidence(scenario: str, before, clean) -> dict:
    after = {
        "missing_order": None, "duplicate_order": [before, before], "null_net_amount": {**before, "net_amount": None},
        "wrong_net_amount": {**before, "net_amount": None if before["net_amount"] is None else before["net_amount"] + clean},
    }[scenario]
    return {
        "dataset": "target_orders", "action": ACTIONS[scenario], "key": {"order_id": before["order_id"]},
        "before": before, "after": after, "expected_rule_ids": list(EXPECTED_FAILURES[scenario]),
    }


def apply_fault(store: Store, scenario: str, run_id: str | None = None) -> dict:
    """Copy the run's reports, damage the copy, keep what was done as evidence.

    The published reports are never touched, and a run carries one fault at a time: a commit claims the run before
    anything is written, and of two that claim it one gets a FaultState. A fault that can't be written gives its claim back.
    """
    from decimal import Decimal

    if scenario not in EXPECTED_FAILURES:
        raise ValueError(f"unknown fault: {scenario}")
    resolved = resolve_success(store, run_id)
    if resolved is None:
        raise FaultState("no matching successful run")
    report = store.read_run("target.orders_report", resolved).drop("run_id")
    first = report.orderBy(F.col("order_id").asc_nulls_last()).limit(1).collect()
    if not first:
        raise FaultState("the run has no target orders")
    fault_run_id = uuid.uuid4().hex
    _claim(store, resolved, fault_run_id)
    try:
        damaged = inject({"target_orders": report}, scenario)["target_orders"]
        store.write_run("fault_workspace.orders_report", damaged, resolved)
        store.write_run("fault_workspace.daily_sales_report", store.read_run("target.daily_sales_report", resolved), resolved)
    except Exception:
        _release(store, resolved, fault_run_id)
        raise
    evidence = _evidence(scenario, first[0].asDict(), Decimal("0.01"))
    return _log(store, {
        "fault_run_id": fault_run_id, "pipeline_run_id": resolved, "scenario_id": scenario, "status": "APPLIED",
        "mutation_evidence": to_json(evidence), "validation_run_id": None, "applied_at": now(), "reset_at": None,
    })


def check_fault(store: Store, fault_run_id: str) -> QualityRun:
    fault = inspect_fault(store, fault_run_id)
    if fault is None or fault["status"] != "APPLIED":
        raise FaultState("only an applied fault can be checked")
    quality = run_quality_suite(store, fault["pipeline_run_id"], FAULT_SUITE, FAULT_DATASETS)
    _log(store, {**fault, "validation_run_id": quality.validation_run_id})
    return quality


def reset_fault(store: Store, fault_run_id: str) -> dict:
    """Empty the copies. Resetting again changes nothing."""
    fault = inspect_fault(store, fault_run_id)
    if fault is None:
        raise FaultState("no such fault")
    if fault["status"] == "RESET":
        return fault
    for copy in REPORTS.values():
        store.write_run(copy, store.read_run(copy, fault["pipeline_run_id"]).limit(0), fault["pipeline_run_id"])
    _release(store, fault["pipeline_run_id"], fault_run_id)
    return _log(store, {**fault, "status": "RESET", "reset_at": now()})
