"""Range carries, ordered pairs, containments and what builds on them, against plain loops, with one key that holds everything."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from plumbline.operators import ranges
from plumbline.operators.checks.evidence import reference_freshness
from plumbline.operators.checks.history import freshness_counts
from plumbline.operators.versions import overlap_pairs, type2_history

DAY = datetime(2031, 5, 4)
HOT = [1 << 18, 20]  # rows a range may have: everything in one, or cut many times


@pytest.fixture(params=HOT, ids=["whole", "cut"])
def cut(request, monkeypatch):
    monkeypatch.setattr(ranges, "RANGE_ROWS", request.param)
    return request.param


def test_a_key_of_one_day_is_cut_into_bounded_ranges(spark, monkeypatch):
    monkeypatch.setattr(ranges, "RANGE_ROWS", 20)
    df = spark.createDataFrame([("k", DAY + timedelta(microseconds=7 * i * i)) for i in range(500)] + [("small", DAY)], "k string, at timestamp")
    sizes = ranges.with_ranges(df, ["k"], "at", 500).groupBy("k", "_range").count().collect()
    assert max(r["count"] for r in sizes) <= 20 and sum(r["count"] for r in sizes) == 501
    spans = ranges.with_ranges(df, ["k"], "at", 500).where("k = 'k'").groupBy("_range").agg(F.min("at").alias("a"), F.max("at").alias("z"))
    ordered = spans.orderBy("_range").collect()
    assert all(x.z < y.a for x, y in zip(ordered, ordered[1:]))


def test_next_value_is_carried_between_ranges(spark, cut):
    rng = random.Random(1)
    rows = [("hot", DAY + timedelta(microseconds=i * 11)) for i in range(300)] + [(None, DAY + timedelta(days=i)) for i in range(30)]
    rows += [("hot", None), ("one", DAY)]
    rng.shuffle(rows)
    found = {(r.k, r.at): r.following for r in ranges.next_value(spark.createDataFrame(rows, "k string, at timestamp"), ["k"], "at", "following").collect()}
    for key in ("hot", None, "one"):
        moments = [*sorted(a for k, a in rows if k == key and a is not None), *[a for k, a in rows if k == key and a is None]]
        for this, following in zip(moments, [*moments[1:], None]):
            assert found[key, this] == following


def test_ordered_pairs_with_ties(spark, cut):
    rng = random.Random(2)
    rows = [("hot" if i % 3 else "other", rng.randrange(60), rng.randrange(2), rng.randrange(3)) for i in range(240)]
    found = {r.k: r.pairs for r in ranges.ordered_pairs(spark.createDataFrame(rows, "k string, t long, a long, b long"), ["k"], "t", "a", "b").collect()}
    for key in ("hot", "other"):
        mine = [r for r in rows if r[0] == key]
        assert found[key] == sum(x[2] * y[3] for x in mine for y in mine if x[1] <= y[1])


def test_contained_pairs(spark, cut):
    rng = random.Random(3)
    rows = [("hot" if i % 4 else None, *(rng.randrange(50) for _ in range(2)), bool(rng.randrange(2)), rng.randrange(1, 4)) for i in range(200)]
    rows += [("inner only", 1, 2, False, 1), ("outer only", 1, 2, True, 1)]
    frame = spark.createDataFrame(rows, "k string, x long, y long, outer boolean, w long")
    found = {r.k: r.pairs for r in ranges.contained_pairs(frame, ["k"]).collect() if r.pairs}
    for key in ("hot", None):
        mine = [r for r in rows if r[0] == key]
        assert found.pop(key) == sum(o[4] * p[4] for o in mine for p in mine if o[3] and not p[3] and o[1] < p[1] and o[2] > p[2])
    assert not found


def test_overlaps_of_one_customer_in_one_day(spark, cut):
    rng, rows = random.Random(4), []
    for i in range(150):
        since = DAY + timedelta(seconds=rng.randrange(400))
        until = rng.choice([None, since, since + timedelta(seconds=rng.randrange(-30, 60))])
        rows.append((i if i % 9 else 9, 5, since, until))
    history = spark.createDataFrame(rows, "version_id long, customer_id long, valid_from timestamp, valid_to timestamp")
    end = datetime.max
    expected = sum(x[0] < y[0] and x[2] < (y[3] or end) and y[2] < (x[3] or end) for x in rows for y in rows)
    assert overlap_pairs(history).first().n == expected


def test_history_of_one_customer(spark, cut):
    rows = [(i, 5, DAY + timedelta(seconds=i // 2), f"t{i % 7}") for i in range(200)]
    found = type2_history(spark.createDataFrame(rows, "event_id long, customer_id long, effective_at timestamp, tier string")).orderBy("valid_from").collect()
    assert [r.version_id for r in found] == list(range(1, 200, 2))
    assert [r.valid_to for r in found] == [*[r.valid_from for r in found][1:], None]


def fresh(required, observed):
    as_of, sla = required
    status, *moments = observed
    if status != "SUCCESS" or None in moments:
        return False
    return not any(as_of is not None and (m > as_of or (sla is not None and as_of - m > timedelta(minutes=sla))) for m in moments)


def test_freshness_of_one_dataset_without_pairs(spark, cut):
    rng, required, observed = random.Random(6), [], []
    for i in range(60):
        name = "hot" if i % 3 else rng.choice(["b", "c", None])
        required.append((name, None if i == 4 else DAY + timedelta(minutes=rng.randrange(90)), None if i == 7 else rng.randrange(-5, 60)))
    for i in range(150):
        name = "hot" if i % 5 else rng.choice(["b", None, "unasked"])
        moments = [None if rng.random() < 0.05 else DAY + timedelta(minutes=rng.randrange(-60, 150)) for _ in range(2)]
        observed.append((name, rng.choice(["SUCCESS"] * 8 + ["FAILED", None]), *moments))
    requirements = spark.createDataFrame(required, "dataset_id string, as_of timestamp, sla_minutes int")
    observations = spark.createDataFrame(observed, "dataset_id string, execution_status string, last_success_at timestamp, last_event_at timestamp")
    found = {r.dataset_id: (r.n, r.violated) for r in freshness_counts(requirements, observations).collect()}
    expected = {}
    for name, *limit in required:
        mine = [o[1:] for o in observed if name is not None and o[0] == name]
        n, bad = expected.get(name, (0, 0))
        expected[name] = (n + (len(mine) or 1), bad + (sum(not fresh(limit, o) for o in mine) if mine else 1))
    assert found == expected


def test_references_of_one_day(spark, cut):
    rng = random.Random(8)
    required = [("d", "r", rng.randrange(1, 200)) for _ in range(40)]
    seen = [("d", "r", DAY + timedelta(minutes=rng.randrange(-20, 200))) for _ in range(70)]
    as_of = DAY + timedelta(minutes=150)
    tables = {
        "cloud_required_references": spark.createDataFrame(required, "dataset_id string, reference_id string, sla_minutes int"),
        "cloud_references": spark.createDataFrame(seen, "dataset_id string, reference_id string, observed_at timestamp"),
        "cloud_context": spark.createDataFrame([(as_of,)], "as_of timestamp"),
    }
    expected = sum(m > as_of or as_of - m > timedelta(minutes=sla) for _, _, sla in required for _, _, m in seen)
    assert reference_freshness(tables).first().violation_count == expected
