"""The layered run end to end, its quality suite, and the fault lifecycle."""

import json
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal as D
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from plumbline.contracts import QualityStatus, Suite
from plumbline.functions.exprs import net_amount
from plumbline.plans import fault_runs, orders
from plumbline.plans.quality import RunNotReady, inspect_quality, run_quality_suite
from plumbline.plans.suites import EXPECTED_FAILURES
from plumbline.session import work_dir
from plumbline.sources.generator import expected_net_revenue, generate_customers, generate_orders
from plumbline.sources.store import Store


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    made = Store(spark, str(tmp_path_factory.mktemp("layers")))
    orders.seed_source(made, generate_customers(spark), generate_orders(spark))
    return made


@pytest.fixture(scope="module")
def run_id(store):
    return orders.run_orders(store)[0]


def test_generated_orders_match_the_known_revenue(spark):
    made = generate_orders(spark)
    assert expected_net_revenue(made).first().net_revenue == D("25245493.29")
    assert made.where(net_amount() < 0).count() == 0
    with pytest.raises(ValueError):
        generate_orders(spark, 0)
    assert [r.country_code for r in generate_customers(spark, 6).orderBy("customer_id").collect()] == ["VN", "US", "GB", "SG", "AU", "VN"]


def test_two_runs_keep_their_own_rows_and_stages(store, run_id):
    second, outcomes = orders.run_orders(store)
    assert [o.name for o in outcomes] == list(orders.STAGES)
    for run in (run_id, second):
        for table in ("bronze.orders", "silver.orders", "target.orders_report"):
            assert store.read_run(table, run).count() == 10_000
        report = store.read_run("target.daily_sales_report", run).agg(F.sum("net_revenue"), F.sum("order_count")).first()
        assert tuple(report) == (D("25245493.29"), 10_000)
        assert len(orders.inspect_run(store, run)["stages"]) == 5
    latest = orders.inspect_run(store)
    assert (latest["run_id"], latest["execution_status"], latest["data_quality_status"]) == (second, "SUCCESS", "NOT_RUN")


def test_stage_metrics_are_those_of_the_written_rows(store, run_id):
    stages = {s["stage_name"]: s for s in orders.inspect_run(store, run_id)["stages"]}
    written = {"BRONZE": "bronze.orders", "SILVER": "silver.orders", "GOLD": "gold.daily_sales", "TARGET": "target.orders_report"}
    for stage, table in written.items():
        assert stages[stage]["row_count"] == store.read_run(table, run_id).count()
    for stage in ("SOURCE", "SILVER", "GOLD", "TARGET"):
        assert json.loads(stages[stage]["metrics"])["net_revenue"] == "25245493.29"
    assert json.loads(stages["TARGET"]["metrics"])["daily_rows"] == stages["GOLD"]["row_count"]


def test_a_failing_stage_is_recorded_and_raised(store):
    def broken(_store, _run):
        raise ValueError("no space")

    with pytest.raises(orders.StageFailed):
        orders.run_orders(store, "broken", {"SOURCE": orders.STAGE_STEPS["SOURCE"], "BRONZE": broken})
    found = orders.inspect_run(store, "broken")
    assert found["execution_status"] == "FAILED" and "no space" in found["error"]
    assert [s["execution_status"] for s in found["stages"]] == ["SUCCESS", "FAILED"]
    with pytest.raises(RunNotReady):
        run_quality_suite(store, "broken")


def test_suite_passes_on_a_clean_run_and_changes_only_the_quality_status(store, run_id):
    quality = run_quality_suite(store, run_id)
    assert quality.status is QualityStatus.PASS and len(quality.results) == 26
    run = orders.inspect_run(store, run_id)
    assert (run["execution_status"], run["data_quality_status"]) == ("SUCCESS", "PASS")
    assert len(inspect_quality(store, run_id)["results"]) == 26
    empty = run_quality_suite(store, run_id, Suite("empty", ()))
    assert empty.status is QualityStatus.NOT_RUN


@pytest.mark.parametrize("scenario", ["missing_order", "wrong_net_amount"])
def test_a_fault_fails_its_rules_and_leaves_the_report_alone(store, run_id, scenario):
    before = store.read_run("target.orders_report", run_id).agg(F.bit_xor(F.xxhash64("order_id", "net_amount"))).first()[0]
    fault = fault_runs.apply_fault(store, scenario, run_id)
    with pytest.raises(fault_runs.FaultState):
        fault_runs.apply_fault(store, "duplicate_order", run_id)
    quality = fault_runs.check_fault(store, fault["fault_run_id"])
    failing = {r.rule.id for r in quality.results if r.status is QualityStatus.FAIL}
    assert failing >= set(EXPECTED_FAILURES[scenario])
    first = fault_runs.reset_fault(store, fault["fault_run_id"])
    again = fault_runs.reset_fault(store, fault["fault_run_id"])
    assert first["status"] == again["status"] == "RESET"
    with pytest.raises(fault_runs.FaultState):
        fault_runs.check_fault(store, fault["fault_run_id"])
    assert store.read_run("fault_workspace.orders_report", run_id).count() == 0
    assert fault_runs.active_conflicts(store).count() == 0
    after = store.read_run("target.orders_report", run_id).agg(F.bit_xor(F.xxhash64("order_id", "net_amount"))).first()[0]
    assert before == after


def test_of_two_faults_at_once_one_is_applied(store, run_id):
    def attempt(scenario):
        try:
            return fault_runs.apply_fault(store, scenario, run_id)["fault_run_id"]
        except fault_runs.FaultState:
            return None

    with ThreadPoolExecutor(2) as pool:
        applied = [f for f in pool.map(attempt, ("missing_order", "duplicate_order")) if f]
    assert len(applied) == 1 and fault_runs.active_conflicts(store).isEmpty()
    fault_runs.reset_fault(store, applied[0])
    again = attempt("duplicate_order")  # the claim was given back
    assert again
    fault_runs.reset_fault(store, again)


def test_a_fault_that_cannot_be_written_gives_its_claim_back(store, run_id, monkeypatch):
    def broken(*_):
        raise OSError("no space")

    monkeypatch.setattr(fault_runs, "inject", broken)
    with pytest.raises(OSError):
        fault_runs.apply_fault(store, "missing_order", run_id)
    monkeypatch.undo()
    fault_runs.reset_fault(store, fault_runs.apply_fault(store, "missing_order", run_id)["fault_run_id"])


def test_work_folders_need_a_shared_place(spark):
    def session(master):
        settings = {"spark.sql.warehouse.dir": "file:/somewhere/local"}
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)), _jvm=spark._jvm, _jsc=spark._jsc,
                               sparkContext=SimpleNamespace(master=master))

    assert work_dir(session("local[2]"), "x").startswith("file:/somewhere/local/")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(session("spark://elsewhere:7077"), "x")


def test_only_published_snapshots_are_current(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    with pytest.raises(LookupError):
        store.current("t")
    store.publish("t", spark.range(3), "one")
    spark.range(9).write.parquet(f"{store.path('t')}/snapshot=two")
    assert store.current("t").count() == 3
    store.publish("t", spark.range(5), "three")
    assert store.current("t").count() == 5


def test_stored_nullability_comes_from_the_declared_schema(store, run_id):
    columns = {name: (kind, nullable) for name, kind, nullable in store.columns("target.orders_report", run_id)}
    assert columns["net_amount"] == ("numeric", False) and columns["run_id"] == ("text", False)
    assert store.columns("target.orders_report", "unknown") is None
