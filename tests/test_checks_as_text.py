"""Ad-hoc SQL checks: the result contract, refusals, previews, and wrong checks that must not certify."""

import pytest

from plumbline.contracts import QualityStatus
from plumbline.operators import certify, previews
from plumbline.operators.certify import ResultContract, certify_text, overall, run_check_text, sql_check, violation_count
from tests import fixtures


def variants(spark, check, names):
    return {v: fixtures.materialize(fixtures.build(spark, check, v), names) for v in fixtures.COUNTS[check]}


@pytest.mark.parametrize("check,text", [
    ("C03", "SELECT COUNT(*) AS violation_count FROM target_orders WHERE net_amount = NULL"),
    ("C03", "SELECT COUNT(*) AS violation_count FROM target_orders WHERE COALESCE(net_amount, 0) = 0"),
    ("C04", "SELECT COUNT(*) - COUNT(DISTINCT order_id) AS violation_count FROM target_orders"),
    ("C02", "SELECT 1 AS violation_count"),
    ("C08", """SELECT COUNT(*) AS violation_count FROM target_current_orders t WHERE t.updated_at <>
               (SELECT MAX(updated_at) FROM source_order_events s WHERE s.order_id = t.order_id)"""),
    ("C11", """SELECT COUNT(*) AS violation_count FROM freshness_requirements r JOIN freshness_observations o USING (dataset_id)
               WHERE r.as_of - o.last_event_at >= r.sla_minutes * INTERVAL '1' MINUTE"""),
])
def test_wrong_checks_do_not_certify(spark, check, text):
    names = fixtures.READS[check]
    cases = certify_text(text, variants(spark, check, names), fixtures.COUNTS[check])
    assert overall(cases) is QualityStatus.FAIL


def test_right_check_certifies(spark):
    text = "SELECT COUNT(*) AS violation_count FROM target_orders WHERE net_amount IS NULL;"
    cases = certify_text(text, variants(spark, "C03", ["target_orders"]), fixtures.COUNTS["C03"])
    assert overall(cases) is QualityStatus.PASS


def test_errors_outrank_failures(spark):
    cases = certify_text("SELECT nothing FROM target_orders", variants(spark, "C03", ["target_orders"]), fixtures.COUNTS["C03"])
    assert overall(cases) is QualityStatus.ERROR


@pytest.mark.parametrize("expression", ["-1", "NULL", "1.5", "'x'", "TRUE", "CAST('NaN' AS DOUBLE)"])
def test_improper_counts_are_refused(spark, expression):
    with pytest.raises(ResultContract):
        violation_count(spark.sql(f"SELECT {expression} AS violation_count"))


def test_shape_of_the_result(spark):
    for text in ("SELECT 1 AS n", "SELECT 1 AS violation_count, 2 AS more", "SELECT id AS violation_count FROM range(2)",
                 "SELECT 1 AS violation_count WHERE FALSE"):
        with pytest.raises(ResultContract):
            violation_count(spark.sql(text))
    assert violation_count(spark.sql("SELECT 3 AS violation_count")) == 3


def test_only_queries_run(spark):
    tables = {"t": spark.range(3)}
    for text in ("DROP TABLE t", "INSERT INTO t VALUES (1)", "CREATE VIEW w AS SELECT 1", "SELECT 1; SELECT 2"):
        assert run_check_text(text, tables).error == "SQL_ERROR"
    for bad in ("", "  ", "SELECT '\0'"):
        with pytest.raises(ValueError):
            certify.sql_check(bad, tables)
    long_list = ", ".join(map(str, range(5_000)))
    assert sql_check(f"SELECT COUNT(*) AS n FROM t WHERE id IN ({long_list});", tables).first().n == 3
    assert sql_check("SELECT COUNT(*) AS n FROM t", tables).first().n == 3


def test_preview_limits(spark):
    assert len(previews.preview(spark.range(150), rows=120).rows) == 120
    shown = previews.preview(spark.range(150))
    assert len(shown.rows) == 100 and shown.truncated
    assert not previews.preview(spark.range(100)).truncated
    wide = spark.sql("SELECT repeat('x', 3000) AS c FROM range(40)")
    long = previews.preview(wide)
    assert long.truncated and len(long.rows[0][0]) == 2048 and len(long.rows) < 40
    many = spark.range(1).selectExpr(*[f"id AS c{i}" for i in range(21)])
    assert previews.preview(many).error == "COLUMN_LIMIT"
    with pytest.raises(ValueError):
        previews.preview(many, rows=0)


def test_half_subset_is_exact_for_sparse_keys(spark):
    keys = [5, -3, 10**12, 7, 7, 2**62, 8]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in range(1, 8):
        assert previews.kth_smallest(df, "k", n, ranges=16) == sorted(keys)[n - 1]
    assert sorted(r.k for r in previews.half_subset(df, "k").collect()) == [-3, 5, 7, 7]
