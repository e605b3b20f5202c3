"""Every check over every clean and defective variant, against independently stated counts."""

from concurrent.futures import ThreadPoolExecutor

import pytest

from plumbline.contracts import QualityStatus
from plumbline.operators.certify import certify, count_by_difference, count_variants
from plumbline.operators.checks import CHECKS
from plumbline.operators.faults import inject
from plumbline.plans import fault_queries
from plumbline.plans.registry import QUERIES
from tests import fixtures


@pytest.mark.parametrize("check", sorted(fixtures.COUNTS))
def test_variant_counts(spark, check):
    expected = fixtures.COUNTS[check]
    names = fixtures.READS[check]
    with ThreadPoolExecutor(4) as pool:
        built = pool.map(lambda v: fixtures.materialize(fixtures.build(spark, check, v), names), expected)
        variants = dict(zip(expected, built))
    cases = certify(CHECKS[check], variants, names, expected)
    assert {c.variant: c.count for c in cases} == expected
    assert {c.status for c in cases} == {QualityStatus.PASS}


@pytest.mark.parametrize("check,domains", [
    ("C06", {"source_orders": "order_id", "target_orders": "order_id", "gold_daily_sales": "order_date", "target_daily_sales": "order_date"}),
    ("C08", {"source_order_events": "order_id", "target_current_orders": "order_id"}),
    ("C35", {"az_expected_files": "file_id", "az_files": "file_id"}),
])
def test_counts_by_difference_equal_whole_counts(spark, check, domains):
    """On tables with a key that holds a third of the rows, and far more keys than lie near the edits."""
    expected = {v: n for v, n in fixtures.COUNTS[check].items() if not v.startswith(("alt__", "f_sh", "f_z", "adv_", "clean_"))}
    clean = {n: fixtures.build(spark, check, "f_clean" if check == "C35" else "clean")[n] for n in domains}

    def variants(tables):
        return {v: inject(tables, v) for v in expected}

    found = count_by_difference(CHECKS[check], clean, domains, {}, variants, list(expected)).collect()
    whole = count_variants(CHECKS[check], variants(clean), list(domains)).collect()
    assert {r.variant_id: r.violation_count for r in found} == {r.variant_id: r.violation_count for r in whole} == expected


@pytest.mark.parametrize("name", ["f15_mapping_faults", "f15_transform_faults"])
def test_load_faults_are_counted_on_the_keys_near_the_edits(spark, monkeypatch, name):
    sizes, plain = [], count_variants

    def seen(check, variants, names):
        sizes.append(max(t["etl_source"].count() for t in variants.values()))
        return plain(check, variants, names)

    monkeypatch.setattr(fault_queries.certify, "count_variants", seen)
    QUERIES[name](spark, "/root/testdata/sf0.001").collect()
    assert sizes and max(sizes) <= 16


def test_freshness_variants_need_few_datasets(spark):
    needs = spark.sql("SELECT concat('d', id) AS dataset_id, TIMESTAMP '2024-01-01' + make_dt_interval(0, 0, id % 5) AS as_of, CAST(60 + id AS INT) AS sla_minutes FROM range(40)")
    family = fault_queries.FRESHNESS
    (keys,) = family.near({"freshness_requirements": needs}).values()
    assert [k.first()[0] for k in keys[:2]] == ["d0", "d39"]
    assert set(family.domains.values()) == {"dataset_id"} and family.wide == ("fresh_boundary",)
