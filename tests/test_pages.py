"""Crawls followed page by page: skipped numbers, stray pages, jumps into a run, cycles, and one crawl that holds everything."""

import json
import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from plumbline.operators import ranges
from plumbline.operators.checks import CHECKS
from plumbline.plans.check_queries import landed_attempts
from plumbline.sources import pages
from tests import fixtures


def walked(following):
    """Pages from 1 on through {page: next page}, each once."""
    seen, page = [], 1
    while page in following and page not in seen:
        seen.append(page)
        page = following[page]
    return seen


def found_pages(spark, crawls):
    rows = [(name, page, following) for name, chain in crawls.items() for page, following in chain.items()]
    frame = spark.createDataFrame(rows, "crawl string, page long, next_page long")
    out = {name: [] for name in crawls}
    for r in pages.chained_pages(frame, ["crawl"]).collect():
        out[r.crawl].append(r.page)
    return {name: sorted(found) for name, found in out.items()}


CRAWLS = {
    "plain": {1: 2, 2: 3, 3: None},
    "skips a number": {1: 2, 2: 5, 5: 6, 6: None, 3: 4, 4: None},
    "stray page": {1: 2, 2: None, 9: 10, 10: None},
    "cycle": {1: 2, 2: 3, 3: 1},
    "cycle later": {1: 4, 4: 5, 5: 6, 6: 4, 2: 3, 3: None},
    "into a run": {1: 7, 5: 6, 6: 7, 7: 8, 8: 5, 2: 3},
    "backwards": {1: 9, 9: 8, 8: 7, 7: 6, 6: None},
    "itself": {1: 1},
    "no first page": {2: 3, 3: None},
    "next one is missing": {1: 2, 2: 3, 4: None},
}


def test_named_crawls(spark):
    assert found_pages(spark, CRAWLS) == {name: sorted(walked(chain)) for name, chain in CRAWLS.items()}


@pytest.mark.parametrize("rows", [1 << 18, 6])
def test_random_crawls(spark, monkeypatch, rows):
    monkeypatch.setattr(ranges, "RANGE_ROWS", rows)
    rng, crawls = random.Random(rows), {}
    for name in ("hot", "b", "c", "d"):
        size = 60 if name == "hot" else 9
        crawls[name] = {p: rng.choice([p + 1, p + 1, p + 1, p + 1, rng.randrange(1, size + 2), None]) for p in range(1, size) if rng.random() < 0.93 or p == 1}
    assert found_pages(spark, crawls) == {name: sorted(walked(chain)) for name, chain in crawls.items()}


def attempts(spark, rows):
    """(page, status, items, next page) as one final attempt each."""
    made = [(page, 1, status, None, 0, True, json.dumps({"items": items, "next_page": following}) if status == 200 else '{"error": "x"}')
            for page, status, items, following in rows]
    return spark.createDataFrame(made, pages.ATTEMPT_SCHEMA)


def item(i):
    return {"order_id": i, "customer_id": 3, "net_amount": f"{i}.25"}


def test_pages_nobody_names_and_those_after_a_failure_do_not_count(spark):
    rows = [(1, 200, [item(1), item(2)], 4), (2, 200, [item(9)], 3), (4, 200, [item(3)], 6), (6, 503, [], None), (7, 200, [item(8)], None)]
    found = pages.page_records(attempts(spark, rows))
    assert [(r.page, r.pos, r.record_key) for r in found.orderBy("page", "pos").collect()] == [(1, 0, "1"), (1, 1, "2"), (4, 0, "3")]
    expected = spark.createDataFrame([(i, 3, D(f"{i}.25")) for i in (1, 2, 3, 4)], "order_id long, customer_id long, net_amount decimal(18,2)")
    tables = {"api_expected": expected, "api_attempts": attempts(spark, rows)}
    assert CHECKS["C20"](tables).first().asDict() == {
        "wrong_status": 1, "missing_ids": 1, "unexpected_ids": 0, "duplicate_ids": 0, "violation_count": 2}


@pytest.mark.parametrize("count,size", [(1, 4), (4, 4), (9, 2)])
def test_faults_of_crawls_of_other_sizes(spark, count, size):
    n = fixtures.Numbers(6)
    rows = [(n.key(i), 70 + i, n.money(i)) for i in range(count)]
    for check, variant, expected in (
            ("C19", "api_clean", 0), ("C19", "api_wrong_type", 1), ("C20", "api_missing_page", 1), ("C20", "api_duplicate_page", 1),
            ("C21", "api_clean", 0), ("C21", "api_timeout", count + 1), ("C22", "api_clean", 0), ("C22", "api_ingest_wrong", 1)):
        tables = fixtures.api_tables(spark, check, variant, rows, size)
        if count > 1 or variant != "api_missing_page":  # a crawl without any record has no page at all
            assert CHECKS[check](tables).first().violation_count == expected, variant


def test_retried_pages_and_their_requests(spark):
    rows = [(i, 1, D(i)) for i in range(1, 8)]
    landed = fixtures.api_tables(spark, "C21", "api_clean", rows, 3)["api_attempts"]
    tries = len((429, 503, 200))
    assert pages.request_summary(landed).first().asDict() == {"request_count": 3 * tries, "retries": 3 * (tries - 1), "execution_status": "SUCCESS"}
    again = pages.finalize_attempts(landed).select("page", "attempt", "final").collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, landed.select("page", "attempt", "final").collect()))


def test_an_appending_ingest_counts_every_repeated_key(spark):
    rows = [(i, 1, D(i)) for i in range(1, 8)]
    tables = fixtures.api_tables(spark, "C22", "api_clean", rows, 3)
    assert CHECKS["C22"](tables, idempotent=False).first().violation_count == len(rows)


def test_an_order_with_several_flaws_is_served_with_all_of_them(spark):
    listing = spark.sql("""SELECT 0L AS crawl_id, order_id, 7L AS customer_id, CAST(1.5 AS DECIMAL(18,2)) AS net_amount, 1L AS page, order_id AS pos,
        false AS lost, order_id = 4 AS doubled, order_id IN (1, 2, 4) AS text_customer, order_id IN (1, 3, 4) AS no_amount, false AS wrong_amount,
        order_id IN (2, 3, 4) AS text_key FROM VALUES (1L), (2L), (3L), (4L) t(order_id)""")
    tables = {"api_listing": listing, "api_last_page": spark.sql("SELECT 0L AS crawl_id, 1L AS last_page, 2L AS failed_page")}
    (landed,) = landed_attempts(tables.__getitem__).collect()
    last = {"order_id": "4", "customer_id": "7"}
    assert json.loads(landed.body)["items"] == [
        {"order_id": 1, "customer_id": "7"}, {"order_id": "2", "customer_id": "7", "net_amount": "1.50"}, {"order_id": "3", "customer_id": 7}, last, last]


def test_the_plan_of_a_crawl_does_not_grow_where_it_exceeds_one_range(spark, monkeypatch):
    monkeypatch.setattr(ranges, "RANGE_ROWS", 8)
    frame = spark.range(1, 60).select(F.lit("a").alias("crawl"), F.col("id").alias("page"), (F.col("id") + 1).alias("next_page"))
    found = pages.chained_pages(frame, ["crawl"])
    assert found.count() == 59
    assert found._jdf.queryExecution().optimizedPlan().collectLeaves().size() <= 2
