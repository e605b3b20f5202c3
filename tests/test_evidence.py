"""Evidence documents: what is accepted, what is refused and why, and the way back out."""

import hashlib
import json
from datetime import datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from plumbline.operators import verdicts
from plumbline.sources import evidence
from tests import fixtures
from tests.fixtures import frame

CAPTURED = datetime(2033, 5, 9, 21, 15)


def record(i=1, **changes):
    return {"order_id": 40 + i, "customer_id": 7 * i, "amount": f"{i}.5", "updated_at": f"2033-05-0{i}T18:45:00Z", "event_id": 900 + i,
            "batch_no": 2, "run_id": f"nightly-{i % 2}", **changes}


def document(**changes):
    """Two runs, an activity without rows written, and records in two layers."""
    base = {
        "version": 1, "provider": "ADF", "resource_id": "factory-9", "as_of": "2033-05-09T21:15:00+00:00", "batch_no": 2, "steps": [],
        "runs": [{"run_id": f"nightly-{i}", "execution_status": word, "started_at": f"2033-05-09T2{i}:05:00+01:00", "ended_at": None}
                 for i, word in enumerate(("Completed", "Cancelled"))],
        "activities": [{"activity_id": "pull", "run_id": "nightly-0", "execution_status": "Queued", "source_dataset": "source", "rows_read": 3}],
        "datasets": {"source": [record(1), record(2, amount=None), record(3)], "target": [record(3)]},
    }
    return {k: v for k, v in {**base, **changes}.items() if v is not ...}


def documents(spark, *contents):
    rows = [(f"b{i}", c if isinstance(c, str) else json.dumps(c)) for i, c in enumerate(contents)]
    return evidence.with_hash(spark.createDataFrame(rows, "bundle string, content string"))


def reasons(spark, content):
    return sorted(r.reason for r in evidence.parse_bundles(documents(spark, content)).problems.collect())


def test_a_sound_document_is_typed(spark):
    found = evidence.parse_bundles(documents(spark, document()))
    assert found.problems.isEmpty()
    runs = {r.run_id: r for r in found.sections["runs"].collect()}
    assert {k: r.execution_status for k, r in runs.items()} == {"nightly-0": "SUCCESS", "nightly-1": "CANCELLED"}
    assert runs["nightly-1"].started_at == datetime(2033, 5, 9, 20, 5) and runs["nightly-0"].ended_at is None
    assert [r.execution_status for r in found.sections["activities"].collect()] == ["UNKNOWN"]
    assert {r.order_id: r.amount for r in found.sections["datasets.source"].collect()} == {41: Decimal("1.50"), 42: None, 43: Decimal("3.50")}
    assert found.sections["datasets.target"].count() == 1


# What a document may not be, by the reason that is given. ``...`` leaves a field out.
NOT_JSON = ("[1, 2", '{"provider": "ADF", "provider": "ADF", "version": 1}')
WRONG_HEADERS = {
    "unknown field": [{"comment": ""}, {"datasets": {"archive": []}}],
    "unsupported version": [{"version": 0}, {"version": True}, {"version": "1"}],
    "unsupported provider": [{"provider": "Cron"}],
    "missing field: as_of": [{"as_of": ...}],
    "invalid timestamp: as_of": [{"as_of": "2033-05-09T21:15:00"}, {"as_of": 5}],
    "repeated run_id": [{"runs": document()["runs"] + document()["runs"][:1]}],
    "not an array: runs": [{"runs": {"run_id": "nightly-0"}}],
}
WRONG_RECORDS = {
    "invalid integer: order_id": [{"order_id": False}, {"order_id": -7}, {"order_id": 41.0}, {"order_id": "41"}],
    "invalid money: amount": [{"amount": 1.5}, {"amount": "0.125"}, {"amount": "1,5"}],
    "invalid timestamp: updated_at": [{"updated_at": "2033-05-01"}],
    "invalid text: run_id": [{"run_id": ""}, {"run_id": "line\u0007"}],
    "unknown field": [{"colour": "red"}],
}


def test_refused_documents(spark):
    refused = [(text, "invalid JSON") for text in NOT_JSON]
    refused += [(document(**change), reason) for reason, changes in WRONG_HEADERS.items() for change in changes]
    refused += [(document(datasets={"source": [record(1), record(2, **change)]}), reason)
                for reason, changes in WRONG_RECORDS.items() for change in changes]
    found = evidence.parse_bundles(documents(spark, document(), *[d for d, _ in refused]))
    told: dict = {}
    for r in found.problems.collect():
        told.setdefault(r.bundle, set()).add(r.reason)
    for i, (_, reason) in enumerate(refused, 1):
        assert reason in told[f"b{i}"], (i, reason, told.get(f"b{i}"))
    assert {r.bundle for r in found.documents.select("bundle").collect()} == {"b0"}
    assert {r.bundle for r in found.sections["datasets.source"].collect()} == {"b0"}


def test_repeated_step(spark):
    steps = [{"step_no": n, "operation": "LOAD", "run_id": "nightly-0", "execution_status": "FAILED", "batch_no": 2, "target_rows": n, "watermark": None}
             for n in (4, 5, 4)]
    assert reasons(spark, document(steps=steps)) == ["repeated step_no"]


def test_a_document_with_thousands_of_rows_is_accepted(spark):
    large = document(datasets={"source": [record(i % 9 + 1, order_id=i) for i in range(3000)]})
    found = evidence.parse_bundles(documents(spark, large))
    assert found.problems.isEmpty() and found.sections["datasets.source"].count() == 3000


def test_provenance_hash_and_run_ids(spark):
    found = evidence.parse_bundles(documents(spark, document()))
    row = evidence.provenance(found, "json", CAPTURED.replace(tzinfo=timezone.utc)).first()
    assert row.sha256 == hashlib.sha256(json.dumps(document()).encode()).hexdigest()
    assert sorted(json.loads(row.run_ids)) == ["nightly-0", "nightly-1"] and row.mapping_version == 1


def test_export_reads_back(spark):
    found = evidence.parse_bundles(documents(spark, document()))
    header = spark.createDataFrame(
        [("b0", "ADF", "factory-9", CAPTURED, 2)], "bundle string, provider string, resource_id string, as_of timestamp, batch_no int")
    sections = fixtures.materialize(found.sections, ["runs", "activities", "datasets.source"])
    exported = evidence.with_hash(evidence.export_bundles(header, sections))
    stored = fixtures.materialize({"documents": exported}, ["documents"])["documents"]
    again = evidence.parse_bundles(stored)
    assert again.problems.count() == 0
    for path, rows in sections.items():
        assert sorted(map(str, again.sections[path].drop("raw_evidence", "pos").collect())) == sorted(
            map(str, rows.drop("raw_evidence", "pos").collect()))
    assert json.loads(stored.first().content)["datasets"]["source"][1]["amount"] is None


def test_record_lines_carry_bundles_of_any_size(spark):
    header = spark.createDataFrame(
        [(b, "Fabric", None, CAPTURED, 1) for b in ("small", "large", "again")],
        "bundle string, provider string, resource_id string, as_of timestamp, batch_no int")
    columns = spark.range(3000).selectExpr("'large' AS bundle", "'source' AS dataset", "concat('c', id) AS column_name", "'text' AS data_type")
    columns = columns.unionByName(columns.limit(1).withColumn("bundle", F.lit("small")))
    runs = spark.createDataFrame([("again", "r")] * 2 + [("large", "r")], "bundle string, run_id string").selectExpr(
        "*", "'SUCCESS' AS execution_status", "CAST(NULL AS TIMESTAMP) AS started_at", "CAST(NULL AS TIMESTAMP) AS ended_at")
    lines = evidence.record_lines(header, {"schema": columns, "runs": runs})
    odd = spark.createDataFrame([("{bad",), ('{"bundle": "odd", "section": "gold", "record": {}}',)], "value string")
    found = evidence.parse_records(lines.unionByName(odd))
    assert {r.bundle for r in found.documents.collect()} == {"small", "large"}
    assert found.sections["schema"].groupBy("bundle").count().orderBy("count").collect() == [("small", 1), ("large", 3000)]
    assert {(r.bundle, r.reason) for r in found.problems.collect()} == {
        ("again", "repeated run_id"), ("odd", "unknown section"), ("odd", "not one header"), (None, "no bundle named"), (None, "not one header")}


def csv_text(*records):
    """Records with their dataset as a file; the header is fixed by the format."""
    names = ["dataset", *record()]
    return "\n".join([",".join(names), *[",".join(str(r[n]) for n in names) for r in records], ""])


def test_csv_files_are_refused_whole(spark, tmp_path):
    good = {**record(1), "dataset": "source"}
    (tmp_path / "kept.csv").write_text(csv_text(good, {**record(2), "dataset": "target"}, {**record(3), "dataset": "source"}))
    (tmp_path / "refused.csv").write_text(csv_text(good, {**record(2), "dataset": "archive", "order_id": "two", "amount": "x"}))
    found = evidence.read_csv_snapshots(spark, str(tmp_path))
    assert found.sections["datasets.source"].count() == 2 and found.sections["datasets.target"].count() == 1
    assert {r.bundle.rsplit("/", 1)[1] for r in found.problems.collect()} == {"refused.csv"}


def test_contract_evidence_cannot_bring_its_own_truth(spark):
    lesson = "lab_031_databricks_classification"
    rows = [{"record_id": i, "classification": "REJECTED", "amount": f"{i}.25", "run_id": "nightly-0"} for i in (6, 7)]
    sound = {"version": 1, "kind": "foundations", "lab_id": lesson, "contract_id": "standard", "provider": "Databricks", "resource_id": "cluster-4",
             "as_of": "2033-05-09T21:15:00Z", "batch_no": 1, "runs": [], "steps": [], "datasets": {"db_source": [], "db_publication": rows}}
    with_truth = {**sound, "datasets": {**sound["datasets"], "db_contract": rows[:1]}}
    found = evidence.parse_contract_bundles(documents(spark, sound, with_truth, {**sound, "contract_id": "mine"}), lesson)
    assert {r.bundle for r in found.documents.collect()} == {"b0"}
    assert {r.record_id: r.amount for r in found.sections["datasets.db_publication"].collect()} == {6: Decimal("6.25"), 7: Decimal("7.25")}


# Verdicts

def test_clean_evidence_has_no_gap_and_each_defect_has_one(spark):
    for check in ("C23", "C26", "C28", "C29", "C30"):
        tables = fixtures.evidence(spark, check, "cloud_clean")
        assert verdicts.evidence_gaps(tables, check).first().evidence_status == "AVAILABLE"
    tables = fixtures.evidence(spark, "C28", "cloud_clean")
    for name, edit in {
        "runs_unknown": {"cloud_runs": tables["cloud_runs"].limit(0)},
        "snapshot_empty": {"cloud_target": tables["cloud_target"].limit(0)},
        "activity_unknown": {"cloud_activities": tables["cloud_activities"].withColumn("rows_read", F.lit(None).cast("bigint"))},
        "checkpoint_missing": {"cloud_steps": tables["cloud_steps"].limit(0)},
        "context_unknown": {"cloud_context": tables["cloud_context"].withColumn("batch_no", F.lit(None).cast("int"))},
        "resource_unknown": {"cloud_context": tables["cloud_context"].withColumn("resource_id", F.lit(""))},
    }.items():
        found = verdicts.evidence_gaps({**tables, **edit}, "C28").first()
        assert (found.evidence_status, found.evidence_gaps) == ("NOT_VERIFIED", [name])


def access_tables(spark, variant):
    tables = fixtures.contract(spark, "C36", variant)
    clock = fixtures.CONTRACT_CLOCK
    return {**tables, "cloud_runs": frame(spark, "cloud_runs", [(fixtures.RUN, "SUCCESS", clock, clock, "{}")]),
            "cloud_steps": frame(spark, "cloud_steps", [(1, "INITIAL", fixtures.RUN, "SUCCESS", 1, 3, clock)])}


@pytest.mark.parametrize("variant,state", [
    ("f_clean", "OBSERVED"), ("f_access_denied", "ACCESS_ERROR"), ("f_access_identity", "INCOMPLETE"),
    ("f_access_missing", "INCOMPLETE"), ("f_access_future", "INCOMPLETE"),
])
def test_access_state(spark, variant, state):
    tables = access_tables(spark, variant)
    assert verdicts.access_state(tables).first().access_status == state
    gaps = verdicts.contract_gaps(tables, "C36", ["az_access"]).first()
    assert (gaps.evidence_status == "AVAILABLE") == (state == "OBSERVED")


def test_unknown_run_is_a_gap(spark):
    tables = access_tables(spark, "f_clean")
    tables["az_access"] = tables["az_access"].withColumn("run_id", F.lit("other"))
    assert verdicts.contract_gaps(tables, "C36", ["az_access"]).first().evidence_gaps == ["run_reference_missing"]


def test_verdict_precedence_and_staleness(spark):
    rows = [("AVAILABLE", 0, False), ("AVAILABLE", 2, False), ("AVAILABLE", None, False), ("NOT_VERIFIED", 0, False), ("NOT_VERIFIED", 0, True)]
    df = spark.createDataFrame(rows, "e string, n long, failed boolean")
    found = [r.v for r in df.select(verdicts.combined_verdict(F.col("e"), F.col("n"), F.col("failed")).alias("v")).collect()]
    assert found == ["PASS", "FAIL", "NOT_RUN", "NOT_VERIFIED", "ERROR"]
    made = spark.createDataFrame([("a", "r1", "PASS"), ("b", "r1", "PASS")], "subject string, revision string, status string")
    current = spark.createDataFrame([("a", "r1"), ("b", "r2")], "subject string, current_revision string")
    assert {r.subject: r.status for r in verdicts.valid_verdicts(made, current).collect()} == {"a": "PASS", "b": "NOT_RUN"}


def test_record_lines_are_judged_once_and_a_bundle_is_dealt_over_parts(spark):
    header = spark.sql("SELECT 'a' AS bundle, 'ADF' AS provider, 'w' AS resource_id, timestamp'2026-01-03 12:00:00' AS as_of, 1 AS batch_no")
    rows = spark.range(200).selectExpr("'a' AS bundle", "'d' AS dataset_id", "CAST(id AS STRING) AS reference_id",
                                       "timestamp'2026-01-03 12:00:00' AS observed_at", "'r' AS run_id")
    found = evidence.parse_records(evidence.record_lines(header, {"references": rows})).sections["references"]
    assert "schema_of_variant" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.count() == found.select("reference_id").distinct().count() == 200
