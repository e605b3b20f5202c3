"""Replay sequences: repeating, late and recovered batches end in the same state."""

from concurrent.futures import ThreadPoolExecutor
from datetime import timezone

import pytest
from pyspark.sql import functions as F

from plumbline import schemas
from plumbline.operators.checks import CHECKS
from plumbline.plans import loads
from plumbline.sources.commits import CommitConflict, Commits, StepLog
from plumbline.sources.store import Store
from plumbline.streaming import keyed
from plumbline.streaming import merge as stream
from tests import fixtures, model
from tests.fixtures import frame

KEYS, ORDER = ["order_id"], ["event_at", "event_id"]


def merged_events(upto):
    """Order -> event after the batches up to one, and event -> when the newest of them arrived."""
    seen = [e for e in fixtures.arrival_rows() if e["batch_no"] <= upto]
    return {e["order_id"]: e["event_id"] for e in model.newest(seen, KEYS, ORDER)}


def test_incremental_sequence(spark, tmp_path):
    events = fixtures.advanced(spark, "C10", "clean")["incremental_events"]
    load = loads.IncrementalLoad(Store(spark, str(tmp_path)), events)
    load.advance("RESET")
    assert load.target().count() == 0
    for action, batch in (("NEXT", 1), ("NEXT", 2), ("REPLAY", 2), ("NEXT", 3), ("REPLAY", 3)):
        assert load.advance(action)["target_rows"] == len(merged_events(batch))
        context = frame(spark, "lab_context", [("c10", load.as_of.replace(tzinfo=timezone.utc))])
        tables = {"lab_context": context, "incremental_events": events, "incremental_target": load.target()}
        assert CHECKS["C10"](tables).first().violation_count == 0
        assert {r.order_id: r.event_id for r in load.target().collect()} == merged_events(batch)
    with pytest.raises(loads.LoadError):
        load.advance("NEXT")
    assert [s["step_no"] for s in load.steps] == [1, 2, 3, 4, 5] and load.log().frame().count() == 5


def test_of_two_loads_that_take_one_step_one_goes_on(spark, tmp_path):
    events = fixtures.advanced(spark, "C10", "clean")["incremental_events"]
    one, two = (loads.IncrementalLoad(Store(spark, str(tmp_path)), events) for _ in range(2))
    one.advance("NEXT")
    log = two.log()
    one.advance("NEXT")
    with pytest.raises(CommitConflict):
        log.append({"step_no": 2, "batch_no": 2, "operation": "NEXT"})
    assert two.advance("NEXT")["step_no"] == 3


def test_text_load_replays_and_recovers(spark, tmp_path):
    tables = fixtures.etl(spark, "C17", "etl_clean")
    load = loads.TextOrderLoad(Store(spark, str(tmp_path)), tables["etl_source"], tables["etl_customers"], 3)
    for _ in range(3):
        for action in ("NEXT", "REPLAY"):
            load.advance(action)
            context = frame(spark, "etl_context", [("c17", fixtures.NOW, load.batch_no)])
            seen = {"etl_context": context, "etl_source": tables["etl_source"], "etl_target": load.target()}
            assert CHECKS["C17"](seen).first().violation_count == 0
    assert load.state()["batch_no"] == 3 and load.target().count() == fixtures.TEXT_ORDERS
    load.advance("RECOVER")
    assert load.target().count() == fixtures.TEXT_ORDERS and load.steps[-1]["checkpoint"] == 3


def test_recovery_after_a_failed_load(spark, tmp_path):
    failed = fixtures.etl(spark, "C18", "etl_failed")
    load = loads.TextOrderLoad(Store(spark, str(tmp_path)), failed["etl_source"], failed["etl_customers"], 1)
    for _ in range(2):
        load.advance("RECOVER")
        steps = frame(spark, "etl_steps", [
            (s["step_no"], s["operation"], s["execution_status"], s["target_rows"], s["rejected_rows"], s["checkpoint"]) for s in load.steps])
        assert CHECKS["C18"]({"etl_source": failed["etl_source"], "etl_target": load.target(), "etl_steps": steps}).first().violation_count == 0
    assert load.steps[-1]["checkpoint"] == 1


def test_unmapped_code_stops_the_load(spark, tmp_path):
    tables = fixtures.etl(spark, "C14", "etl_clean")
    code = fixtures.CODES[1][0]
    customers = tables["etl_customers"].where(F.col("customer_code") != code)
    load = loads.TextOrderLoad(Store(spark, str(tmp_path)), tables["etl_source"], customers, 1)
    with pytest.raises(loads.LoadError, match=code):
        load.advance("RUN")
    assert load.store.current_snapshot("etl.target") is None


def test_layered_publication_takes_late_rows_and_respects_the_clock(spark):
    tables = fixtures.evidence(spark, "C27", "cloud_clean")
    clock = F.lit(fixtures.EVIDENCE_CLOCK)
    target = loads.publish_layers(tables["cloud_source"], 3, clock)["cloud_target"]
    found = {r.order_id: r.event_id for r in target.collect()}
    key = fixtures.Numbers().key
    assert found == {key(i): 20 + i if i < 2 else i + 1 for i in range(fixtures.ORDERS)}


def test_publication_under_a_new_run_agrees_with_its_metrics(spark):
    tables = fixtures.evidence(spark, "C26", "cloud_copy_metrics")
    assert CHECKS["C26"](tables).first().violation_count == 1
    published = loads.publish_with_lineage(tables, "run-new", "RUN", fixtures.EVIDENCE_CLOCK)
    assert CHECKS["C26"](published).first().violation_count == 0
    assert CHECKS["C23"](published).first().violation_count == 0
    assert [r.operation for r in loads.step_summary(published["cloud_steps"]).collect()] == ["INITIAL", "RUN"]


def test_version_apply_repeated(spark):
    tables = fixtures.contract(spark, "C32", "f_clean")
    after = tables["db_before"]
    for _ in range(3):
        after = loads.publish_versions(after, tables["db_incoming"])
    assert after.count() == 5
    assert CHECKS["C32"]({**tables, "db_after": after}).first().violation_count == 0


def land(events, batch, folder):
    events.where(F.col("batch_no") == batch).select(*loads.STATE).coalesce(1).write.mode("append").parquet(folder)


def test_stream_equals_batch_and_a_repeated_run_is_a_no_op(spark, tmp_path):
    events = fixtures.advanced(spark, "C10", "clean")["incremental_events"]
    schema = events.select(*loads.STATE).schema
    for batch in (1, 2, 3):
        land(events, batch, f"{tmp_path}/landed")
    for _ in range(2):
        arriving = stream.read_events(spark, f"{tmp_path}/landed", schema, 1)
        stream.start_merge(arriving, f"{tmp_path}/target", f"{tmp_path}/checkpoint", KEYS, ORDER).awaitTermination()
        merged = stream.merged(spark, f"{tmp_path}/target", schema, KEYS, ORDER)
        assert {r.order_id: r.event_id for r in merged.collect()} == merged_events(3)
    stream.compact(spark, f"{tmp_path}/target", f"{tmp_path}/compacted", schema, KEYS, ORDER)
    assert stream.merged(spark, f"{tmp_path}/compacted", schema, KEYS, ORDER).count() == len(merged_events(3))
    rows = fixtures.arrival_rows()
    newest = {b: max(e["event_at"] for e in rows if e["batch_no"] < b) for b in (2, 3)}
    late = {e["event_id"] for e in rows if e["batch_no"] > 1 and e["event_at"] < newest[e["batch_no"]]}
    assert {r.event_id for r in loads.late_events(events).collect()} == late
    last = stream.late_rows(events.where("batch_no = 3"), events.where("batch_no < 3"), "event_at")
    assert {r.event_id for r in last.collect()} == {e["event_id"] for e in rows if e["batch_no"] == 3 and e["event_id"] in late}


def test_keyed_state_survives_restarts_late_and_repeated_files(spark, tmp_path):
    events = fixtures.advanced(spark, "C10", "clean")["incremental_events"]
    schema, rows, seen = events.select(*loads.STATE).schema, fixtures.arrival_rows(), []
    stored: dict = {}
    for number, batch in enumerate((2, 1, 3, 1)):  # the second file is late, the last one comes again
        land(events, batch, f"{tmp_path}/landed")
        arriving = stream.read_events(spark, f"{tmp_path}/landed", schema)
        query = keyed.start_keyed_merge(arriving, f"{tmp_path}/changes", f"{tmp_path}/checkpoint", KEYS, ORDER)
        query.awaitTermination()
        fresh = [e for e in rows if e["batch_no"] == batch]
        assert query.lastProgress["numInputRows"] == len(fresh)  # a batch reads its own rows only
        lost = [e for e in fresh if e["order_id"] in stored and (e["event_at"], e["event_id"]) <= (stored[e["order_id"]]["event_at"], stored[e["order_id"]]["event_id"])]
        again = [e for e in lost if e["event_id"] == stored[e["order_id"]]["event_id"]]
        told = keyed.batch_summary(spark, f"{tmp_path}/changes").where(F.col("batch_id") == number).first()
        assert (told.rows, told.late, told.repeated) == (len(fresh), len(lost) - len(again), len(again))
        seen += fresh
        stored = {e["order_id"]: e for e in model.newest(seen, KEYS, ORDER)}
        found = keyed.current(spark, f"{tmp_path}/checkpoint", schema, KEYS)
        assert {tuple(r) for r in found.collect()} == {(e["event_id"], k, e["event_at"].replace(tzinfo=None), e["net_amount"]) for k, e in stored.items()}


def test_a_long_log_is_folded_and_read_in_bounds(spark, tmp_path):
    log = StepLog(spark, str(tmp_path), schemas.struct("etl_steps"), every=2500)
    text = '{"step_no": %d, "operation": "NEXT", "execution_status": "SUCCESS", "target_rows": 1, "rejected_rows": 0, "checkpoint": %d}'
    (tmp_path / "tail").mkdir()
    for n in range(1, 10_001):  # as other drivers would have written them, up to the folds
        if n % 2500:
            (tmp_path / "tail" / f"{n:012d}.json").write_text(text % (n, n))
        else:
            log.append({"step_no": n, "operation": "NEXT", "execution_status": "SUCCESS", "target_rows": 1, "rejected_rows": 0, "checkpoint": n})
    assert len(log) == 10_000 and len(log.tail.names()) == log.KEEP
    assert log.last()[0]["checkpoint"] == 10_000 and [s["step_no"] for s in log.last(25)] == list(range(9_976, 10_001))
    total = log.frame().agg(F.count(F.lit(1)), F.countDistinct("step_no"), F.sum("target_rows")).first()
    assert tuple(total) == (10_000, 10_000, 10_000)
    with pytest.raises(CommitConflict):
        log.append({"step_no": 10_000})


def test_commits_are_taken_once(spark, tmp_path):
    line = Commits(spark, f"{tmp_path}/line")
    assert line.head() is None
    line.commit({"by": "a"}, 0)
    with pytest.raises(CommitConflict):
        line.commit({"by": "b"}, 0)
    assert line.folder.put_if_absent("000000000002.json", "{}") and not line.folder.put_if_absent("000000000002.json", "{}")
    with ThreadPoolExecutor(8) as pool:
        assert sum(pool.map(lambda n: line.folder.put_if_absent("000000000003.json", f'{{"n": {n}}}'), range(8))) == 1
    line.folder.local = False  # by a rename without overwriting, as on a cluster's store
    assert line.folder.put_if_absent("000000000004.json", "{}") and not line.folder.put_if_absent("000000000004.json", "{}")
    assert line.head().number == 4 and [n for n in line.folder.names()] == [f"{n:012d}.json" for n in (1, 2, 3, 4)]


def test_a_snapshot_is_refused_when_another_one_came_between(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    parent = store.version("t")
    store.publish("t", spark.range(3), "one", parent)
    with pytest.raises(CommitConflict):
        store.publish("t", spark.range(9), "two", parent)
    assert store.current("t").count() == 3
    store.publish("t", spark.range(9), "two", store.version("t"))
    assert store.current("t").count() == 9
