"""Pair counts against brute-force joins, on random rows with duplicates, NULLs and one hot key."""

import random

import pytest
from pyspark.sql import functions as F

from plumbline.operators import reconcile
from plumbline.operators.versions import overlap_pairs


def random_sides(seed):
    r = random.Random(seed)

    def rows(keys):
        hot = [(1, r.choice([None, 1, 2, 3]), r.choice([None, "a", "b"])) for _ in range(15)]
        return hot + [(r.choice(keys), r.choice([None, 1, 2]), r.choice([None, "a", "b"])) for _ in range(25)]

    return rows([None, 1, 2, 3, 4, 5]), rows([None, 1, 2, 3, 6, 7])


@pytest.mark.parametrize("seed", range(3))
def test_counts_equal_the_joins(spark, seed):
    left, right = random_sides(seed)
    schema = "k long, x long, y string"
    s, t = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    joined = [(a, b) for a in left for b in right if a[0] is not None and a[0] == b[0]]
    alone = [a for a in left if a[0] is None or all(a[0] != b[0] for b in right)]
    alone += [b for b in right if b[0] is None or all(b[0] != a[0] for a in left)]
    differing = sum(a[1:] != b[1:] for a, b in joined)
    assert reconcile.diff_count(s, t, ["k"], ["x", "y"]).first().n == len(alone) + differing
    assert reconcile.inner_mismatch_count(s, t, ["k"], ["x", "y"]).first().n == differing
    report = reconcile.pair_report(s, t, ["k"], [("x", "x"), ("y", "y")]).first()
    assert report.m0 == sum(a[1] != b[1] for a, b in joined)
    assert report.m1 == sum(a[2] != b[2] for a, b in joined)
    assert report.missing_count == len({a[0] for a in left} - {b[0] for b in right})
    assert report.unexpected_count == len({b[0] for b in right} - {a[0] for a in left})
    counts = {k: sum(b[0] == k for b in right) for k in {b[0] for b in right}}
    assert report.target_groups == sum(n > 1 for n in counts.values())
    assert report.target_rows == sum(n - 1 for n in counts.values())


def test_evidence_is_ordered_bounded_and_complete(spark):
    left, right = random_sides(7)
    s, t = (spark.createDataFrame(rows, "k long, x long, y string") for rows in (left, right))
    cells = sorted(a[0] for a in left for b in right if a[0] is not None and a[0] == b[0] and a[1] != b[1])
    for limit in (1, 5, 100):
        rows = reconcile.pair_report(s, t, ["k"], [("x", "x"), ("y", "y")], evidence=limit).collect()
        found = sorted((r for r in rows if r.turn is not None), key=lambda r: (r.field, r.turn))
        assert sum(r.m0 is not None for r in rows) == 1
        assert [r.key.k for r in found if r.field == 0] == cells[:limit]
        assert sum(r.field == 1 for r in found) <= limit
        assert all(r.expected != r.actual for r in found)


def test_evidence_of_one_key_with_thousands_of_copies_stays_bounded(spark):
    s = spark.range(3000).selectExpr("7L AS k", "id % 1500 AS x")
    t = spark.range(2000).selectExpr("7L AS k", "id % 1000 + 1 AS x")
    rows = reconcile.pair_report(s, t, ["k"], [("x", "x")], evidence=5).collect()
    first = [(r.expected.f0, r.actual.f0) for r in sorted((r for r in rows if r.turn), key=lambda r: r.turn)]
    assert first == [(0, 1)] * 4 + [(0, 2)]
    assert next(r.m0 for r in rows if r.m0 is not None) == 3000 * 2000 - 2 * 2 * 1000


def test_null_keys_match_in_key_sets_and_never_in_joins(spark):
    s = spark.createDataFrame([(None, 1), (1, 1)], "k long, x long")
    t = spark.createDataFrame([(None, 1), (1, 1)], "k long, x long")
    assert reconcile.key_difference(s, t, ["k"]).count() == 0
    assert reconcile.diff_count(s, t, ["k"], ["x"]).first().n == 2


def test_left_join_weights(spark):
    left = [("r1", "SUCCESS"), ("r1", "UNKNOWN"), ("r2", "SUCCESS"), (None, "SUCCESS")]
    right = [("r1", "UNKNOWN"), ("r1", "SUCCESS"), ("r3", "SUCCESS")]
    a, b = (spark.createDataFrame(rows, "run string, status string") for rows in (left, right))
    n = 0
    for run, status in left:
        partners = [s for r, s in right if run is not None and r == run]
        n += sum(status == "UNKNOWN" or s == "UNKNOWN" for s in partners) if partners else 1
    bad = F.col("status") == "UNKNOWN"
    assert reconcile.weighted_left_violations(a, b, ["run"], ["run"], bad, bad).first().n == n


@pytest.mark.parametrize("seed", range(3))
def test_overlap_pairs_equal_the_self_join(spark, seed):
    from datetime import datetime, timedelta

    r, base, rows = random.Random(seed), datetime(2026, 1, 1), []
    for _ in range(80):
        start = base + timedelta(hours=r.randrange(60))
        end = None if r.random() < 0.15 else start + timedelta(hours=r.randrange(-12, 25))
        rows.append((r.choice([None, *range(40)]), r.randrange(2), None if r.random() < 0.05 else start, end))
    history = spark.createDataFrame(rows, "version_id long, customer_id long, valid_from timestamp, valid_to timestamp")
    last = datetime.max
    expected = sum(
        a[0] is not None and b[0] is not None and a[1] == b[1] and a[0] < b[0] and a[2] is not None and b[2] is not None
        and a[2] < (b[3] or last) and b[2] < (a[3] or last)
        for a in rows for b in rows
    )
    assert overlap_pairs(history).first().n == expected
