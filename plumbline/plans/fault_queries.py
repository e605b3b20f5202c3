"""Every check over every defect of its tables: counts of the check against SQL over tables that SQL has edited.

A family states its clean tables and, for each scenario, the edit as SQL. The query edits the same tables by
``faults.inject`` and lets the check count. Families whose check is a sum over keys are counted by difference.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.exprs import net_amount
from plumbline.operators import certify, faults
from plumbline.operators.checks import CHECKS
from plumbline.operators.faults import inject, rebuild
from plumbline.operators.rules import FrameSource, execute_rules
from plumbline.operators.versions import latest_by, type1_current, type2_history
from plumbline.plans import loads
from plumbline.plans.check_queries import FRESH
from plumbline.plans.inputs import Inputs
from plumbline.plans.orders import order_report
from plumbline.plans.registry import query, sql_diff, sql_duplicates
from plumbline.plans.suites import EXPECTED_FAILURES, FAULT_DATASETS, FAULT_SUITE

Tables = dict[str, DataFrame]
Step = Callable[[str], str]


# Edits as SQL: each takes what to read from and gives a SELECT.

def end(src: str, key: str, which: str = "MIN") -> str:
    return f"(SELECT {which}({key}) FROM {src} q)"


def second(src: str, key: str) -> str:
    return f"(SELECT MIN({key}) FROM {src} q WHERE {key} > {end(src, key)})"


def at(key: str, which: str = "MIN") -> Step:
    return lambda src: f"{key} = {second(src, key) if which == 'SECOND' else end(src, key, which)}"


def first(key: str, n: int, order: str = "NULLS LAST") -> Step:
    return lambda src: f"{key} IN (SELECT {key} FROM {src} q ORDER BY {key} {order} LIMIT {n})"


def always(_src: str) -> str:
    return "TRUE"


def without(where: Step) -> Step:
    return lambda src: f"SELECT * FROM {src} s WHERE ({where(src)}) IS NOT TRUE"


def only(where: Step) -> Step:
    return lambda src: f"SELECT * FROM {src} s WHERE {where(src)}"


def changed(where: Step, **values: str) -> Step:
    return lambda src: "SELECT * REPLACE ({}) FROM {} s".format(
        ", ".join(f"CASE WHEN {where(src)} THEN {v} ELSE {c} END AS {c}" for c, v in values.items()), src)


def again(where: Step, **values: str) -> Step:
    def edit(src: str) -> str:
        swapped = ", ".join(f"{v} AS {c}" for c, v in values.items())
        columns = f"* REPLACE ({swapped})" if swapped else "*"
        return f"SELECT * FROM {src} s UNION ALL SELECT {columns} FROM {src} r WHERE {where(src)}"
    return edit


def edited(table: str, *steps: Step) -> str:
    """Steps one after another over a clean table."""
    return reduce(lambda src, step: f"({step(src)})", steps, "{%s}" % table)


def one(table: str, *steps: Step) -> dict[str, str]:
    return {table: edited(table, *steps)}


NOTHING: dict[str, str] = {}


@dataclass(frozen=True)
class Family:
    """A check, its clean tables in Spark and in SQL, the SQL of its count, and the scenarios' edits in SQL."""

    check: str
    clean: Callable[[Inputs], Tables]
    sql: dict[str, str]
    count: str
    edits: dict[str, dict[str, str]]
    expected: dict[str, int] = field(default_factory=dict)
    domains: dict[str, str] = field(default_factory=dict)  # table -> key, where counts add up over keys
    near: Callable[[Tables], dict[str, list[DataFrame]]] = lambda tables: {}
    scenario: Callable[[str], tuple[str, bool]] = lambda variant: (variant, False)
    wide: tuple[str, ...] = ()  # variants whose edit touches most keys: counted on their whole tables

    def variants(self, clean: Tables) -> dict[str, Tables]:
        return {v: inject(clean, *self.scenario(v)) for v in self.edits}

    def near_variants(self, clean: Tables) -> dict[str, Tables]:
        return {v: inject(clean, *self.scenario(v)) for v in self.edits if v not in self.wide}

    def counted(self, v: Inputs) -> DataFrame:
        clean, names = self.clean(v), list(self.sql)
        if self.domains:
            narrow = [variant for variant in self.edits if variant not in self.wide]
            found = certify.count_by_difference(CHECKS[self.check], clean, self.domains, self.near(clean), self.near_variants, narrow)
            if not self.wide:
                return found
            whole = {variant: inject(clean, *self.scenario(variant)) for variant in self.wide}
            return found.unionByName(certify.count_variants(CHECKS[self.check], whole, names).select(*found.columns))
        return certify.count_variants(CHECKS[self.check], self.variants(clean), names)

    def oracle(self, place: int) -> tuple[list[str], list[str]]:
        """Tables and counts: one SELECT for each variant."""
        def named(text: str, names: dict[str, str]) -> str:
            return re.sub(r"\{(\w+)\}", lambda m: names.get(m[1], m[0]), text)

        clean = {t: f"clean{place}_{t}" for t in self.sql}
        ctes = [f"{clean[t]} AS ({named(sql, clean)})" for t, sql in self.sql.items()]
        counts = []
        for i, (variant, edits) in enumerate(self.edits.items()):
            own = {t: f"edit{place}_{i}_{t}" for t in edits}
            ctes += [f"{own[t]} AS (SELECT * FROM {named(sql, clean)} e)" for t, sql in edits.items()]
            stated = self.expected.get(variant)
            counts.append(f"SELECT '{self.check}' AS check_id, '{variant}' AS variant_id, CAST({named(self.count, {**clean, **own})} AS BIGINT) AS n, "
                          f"CAST({'NULL' if stated is None else stated} AS BIGINT) AS stated")
        return ctes, counts


def statement(families: tuple[Family, ...]) -> str:
    """The families' counts as one SELECT."""
    ctes, counts = [], []
    for place, f in enumerate(families):
        more, own = f.oracle(place)
        ctes += more
        counts += own
    columns = ("check_id, " if len(families) > 1 else "") + "variant_id, n AS violation_count" + (
        ", stated AS expected_count, CASE WHEN n = stated THEN 'PASS' ELSE 'FAIL' END AS status" if any(f.expected for f in families) else "")
    return "WITH " + ",\n".join(ctes) + f"\nSELECT {columns} FROM ({' UNION ALL '.join(counts)}) counted"


def family_query(name: str, *families: Family):
    """Counts per variant; where a count follows from the scenario alone it is stated, and the counts are judged."""
    judged, several = any(f.expected for f in families), len(families) > 1

    @query(name, statement(families))
    def run(v: Inputs) -> DataFrame:
        parts = []
        for f in families:
            found = f.counted(v).select("variant_id", "violation_count")
            if judged:
                stated = v.spark.createDataFrame(list(f.expected.items()), "variant_id string, expected_count bigint")
                found = certify.judged(found, stated)
            parts.append(found.withColumn("check_id", F.lit(f.check)) if several else found)
        return reduce(DataFrame.unionByName, parts)


def view(name: str) -> str:
    return f"SELECT * FROM {name}"


# Orders

def clean_orders(v: Inputs) -> Tables:
    return rebuild({"source_orders": v("source_orders")})


ORDER_SQL = {"source_orders": view("source_orders"), "target_orders": view("clean_orders")}
DAILY_SQL = {"gold_daily_sales": view("gold_daily_sales"), "target_daily_sales": view("gold_daily_sales")}
ORDER_KEYS = {"source_orders": "order_id", "target_orders": "order_id"}
DAILY_KEYS = {"gold_daily_sales": "order_date", "target_daily_sales": "order_date"}
KEYS = """((SELECT COUNT(*) FROM (SELECT order_id FROM {source_orders} EXCEPT SELECT order_id FROM {target_orders}) m)
    + (SELECT COUNT(*) FROM (SELECT order_id FROM {target_orders} EXCEPT SELECT order_id FROM {source_orders}) u))"""
WRONG = """(SELECT COUNT(*) FROM {source_orders} s JOIN {target_orders} t ON s.order_id = t.order_id
    WHERE CAST(s.gross_amount - s.discount_amount - s.refund_amount AS DECIMAL(14,2)) IS DISTINCT FROM t.net_amount)"""
NULLS = "(SELECT COUNT(*) FROM {target_orders} t WHERE net_amount IS NULL)"
TWICE = sql_duplicates("{target_orders}", ["order_id"])
DAYS = sql_diff("{gold_daily_sales}", "{target_daily_sales}", ["order_date"], ["order_count", "net_revenue"])

LOW, HIGH = at("order_id"), at("order_id", "MAX")
MISSING, NULL_LOW, NULL_HIGH = without(LOW), changed(LOW, net_amount="NULL"), changed(HIGH, net_amount="NULL")
CENT_LOW, CENT_HIGH = changed(LOW, net_amount="net_amount + 0.01"), changed(HIGH, net_amount="net_amount - 0.01")
BAD_LOW, BAD_HIGH = changed(LOW, customer_id="-1"), changed(HIGH, customer_id="0")
FIRST_DAY = at("order_date")
DAILY_WRONG = changed(FIRST_DAY, net_revenue="net_revenue + 0.01")
SWAPPED = "(SELECT * FROM {target_orders} t WHERE order_id > (SELECT MIN(order_id) FROM {target_orders} q) UNION ALL " \
    "SELECT * REPLACE ((SELECT MAX(order_id) + 1 FROM {source_orders} q) AS order_id) FROM {target_orders} t WHERE order_id = " + second(
        "{target_orders}", "order_id") + ")"
MIXED = {
    "target_orders": edited("target_orders", MISSING, NULL_HIGH, again(LOW), CENT_LOW),
    "target_daily_sales": edited("target_daily_sales", DAILY_WRONG),
}


def order_family(check: str, sql: dict, keys: dict, count: str, expected: dict, edits: dict, clean=clean_orders) -> Family:
    return Family(check, clean, sql, count, edits, expected, keys)


T = "target_orders"
family_query("f01_missing_and_swapped", order_family(
    "C01", ORDER_SQL, ORDER_KEYS, KEYS, {"clean": 0, "missing": 1, "swapped": 2}, {"clean": NOTHING, "missing": one(T, MISSING), "swapped": {T: SWAPPED}}))
family_query("f02_duplicates", order_family(
    "C04", {T: ORDER_SQL[T]}, {T: "order_id"}, TWICE,
    {"clean": 0, "duplicate_order": 1, "duplicate_last": 1, "duplicate_twice": 2, "duplicate_triple": 1},
    {"clean": NOTHING, "duplicate_order": one(T, again(LOW)), "duplicate_last": one(T, again(HIGH)), "duplicate_twice": one(T, again(LOW), again(HIGH)),
     "duplicate_triple": one(T, again(LOW), again(LOW))}))
family_query("f03_null_amounts", order_family(
    "C03", {T: ORDER_SQL[T]}, {T: "order_id"}, NULLS, {"clean": 0, "null_net_amount": 1, "null_last": 1, "null_two": 2},
    {"clean": NOTHING, "null_net_amount": one(T, NULL_LOW), "null_last": one(T, NULL_HIGH), "null_two": one(T, NULL_LOW, NULL_HIGH)}))
family_query("f04_wrong_amounts", order_family(
    "C05", ORDER_SQL, ORDER_KEYS, WRONG, {"clean": 0, "wrong_net_amount": 1, "wrong_last": 1, "wrong_two": 2, "null_net_amount": 1},
    {"clean": NOTHING, "wrong_net_amount": one(T, CENT_LOW), "wrong_last": one(T, CENT_HIGH), "wrong_two": one(T, CENT_LOW, CENT_HIGH),
     "null_net_amount": one(T, NULL_LOW)}))
CAPSTONE = f"({KEYS} + {WRONG} + {NULLS} + {TWICE} + {DAYS})"
ALL_SQL, ALL_KEYS = {**ORDER_SQL, **DAILY_SQL}, {**ORDER_KEYS, **DAILY_KEYS}
family_query("f05_equal_count_swap", order_family(
    "C06", ALL_SQL, ALL_KEYS, CAPSTONE, {"clean": 0, "swapped": 2}, {"clean": NOTHING, "swapped": {T: SWAPPED}}))


def positive_customers(v: Inputs) -> Tables:
    clean = clean_orders(v)
    return {**clean, T: clean[T].withColumn("customer_id", F.col("customer_id") + 1)}


family_query("f06_invalid_customers", order_family(
    "C02", {T: "SELECT * REPLACE (customer_id + 1 AS customer_id) FROM clean_orders"}, {T: "order_id"},
    "(SELECT COUNT(*) FROM {target_orders} t WHERE customer_id <= 0)",
    {"invalid_customer": 1, "invalid_customer_last": 1, "invalid_customer_two": 2},
    {"invalid_customer": one(T, BAD_LOW), "invalid_customer_last": one(T, BAD_HIGH), "invalid_customer_two": one(T, BAD_LOW, BAD_HIGH)},
    positive_customers))
family_query("f07_daily_and_mixed", order_family(
    "C06", ALL_SQL, ALL_KEYS, CAPSTONE,
    {"clean": 0, "daily_wrong": 1, "daily_missing": 1, "mixed_order_faults": 7, "missing": 1, "swapped": 2, "null_net_amount": 2, "duplicate_order": 1,
     "wrong_net_amount": 1, "duplicate_twice": 2},
    {"clean": NOTHING, "daily_wrong": one("target_daily_sales", DAILY_WRONG), "daily_missing": one("target_daily_sales", without(FIRST_DAY)),
     "mixed_order_faults": MIXED, "missing": one(T, MISSING), "swapped": {T: SWAPPED}, "null_net_amount": one(T, NULL_LOW),
     "duplicate_order": one(T, again(LOW)), "wrong_net_amount": one(T, CENT_LOW), "duplicate_twice": one(T, again(LOW), again(HIGH))}))
HALF = """(SELECT * FROM {source_orders} s WHERE order_id <= (SELECT MAX(order_id) FROM (SELECT order_id FROM {source_orders} q ORDER BY order_id
    LIMIT (SELECT CAST((COUNT(*) + 1) // 2 AS BIGINT) FROM {source_orders} q)) h))"""
FREE = edited("source_orders", changed(LOW, gross_amount="0", discount_amount="0", refund_amount="0"))


def rebuilt(source: str) -> dict[str, str]:
    """The order tables made anew from an edited source."""
    target = f"(SELECT order_id, customer_id, ordered_at, CAST(gross_amount - discount_amount - refund_amount AS DECIMAL(14,2)) AS net_amount FROM {source} s)"
    daily = f"""(SELECT CAST(ordered_at AS DATE) AS order_date, COUNT(*) AS order_count, CAST(SUM(net_amount) AS DECIMAL(18,2)) AS net_revenue
        FROM {target} t GROUP BY 1)"""
    return {"source_orders": source, T: target, "gold_daily_sales": daily, "target_daily_sales": daily}


family_query("f08_clean_controls", Family(
    "C06", clean_orders, ALL_SQL, CAPSTONE, {"clean": NOTHING, "clean_subset": rebuilt(HALF), "clean_zero": rebuilt(FREE)},
    {"clean": 0, "clean_subset": 0, "clean_zero": 0}))

# The rules that each fault of the published report fails, and a check that is wrong about one of them

FAULT_EDITS = {
    "missing_order": edited(T, MISSING), "duplicate_order": edited(T, again(LOW)), "null_net_amount": edited(T, NULL_LOW),
    "wrong_net_amount": edited(T, CENT_LOW)}
RULE_SQL = {
    "count_target_orders": "(SELECT COUNT(*) FROM {target_orders} t) <> (SELECT COUNT(*) FROM clean_orders)",
    "keys_silver_to_target_orders": """(SELECT COUNT(*) FROM (SELECT order_id FROM clean_orders EXCEPT SELECT order_id FROM {target_orders} t) m)
        + (SELECT COUNT(*) FROM (SELECT order_id FROM {target_orders} t EXCEPT SELECT order_id FROM clean_orders) u) > 0""",
    "unique_target_order_id": f"{TWICE} > 0",
    "required_target_orders": """(SELECT COUNT(*) FROM {target_orders} t
        WHERE order_id IS NULL OR customer_id IS NULL OR ordered_at IS NULL OR net_amount IS NULL) > 0""",
    "fields_silver_to_target_orders": """(SELECT COUNT(*) FROM clean_orders s JOIN {target_orders} t ON s.order_id = t.order_id
        WHERE (s.customer_id, s.ordered_at, s.net_amount) IS DISTINCT FROM (t.customer_id, t.ordered_at, t.net_amount)) > 0""",
}


def _rule_oracle() -> str:
    parts = []
    for scenario, rules in EXPECTED_FAILURES.items():
        damaged = FAULT_EDITS[scenario].replace("{target_orders}", "clean_orders")
        for rule in RULE_SQL:
            failed = RULE_SQL[rule].replace("{target_orders}", damaged)
            parts.append(f"SELECT '{scenario}' AS scenario_id, '{rule}' AS rule_id, {failed} AS failed, {str(rule in rules).upper()} AS named")
    return " UNION ALL ".join(parts)


@query("f20_expected_rules", _rule_oracle())
def _expected_rules(v: Inputs) -> DataFrame:
    """Which rules each fault of the published report fails, and which of them it names."""
    silver = v("source_orders").withColumn("net_amount", net_amount())
    rules = [r for r in FAULT_SUITE.rules if r.id in RULE_SQL]
    rows = []
    for scenario, named in EXPECTED_FAILURES.items():
        damaged = inject({T: order_report(silver)}, scenario)[T]
        source = FrameSource({"silver_orders": silver, "target_orders": damaged}, {"SOURCE": v("source_orders").agg(F.count(F.lit(1)))})
        rows += [(scenario, r.rule.id, r.status == "FAIL", r.rule.id in named) for r in execute_rules(rules, source, FAULT_DATASETS)]
    return v.spark.createDataFrame(rows, "scenario_id string, rule_id string, failed boolean, named boolean")


ROW_COUNTS = "(SELECT COUNT(*) FROM {source_orders} s) - (SELECT COUNT(*) FROM {target_orders} t)"
SHALLOW = Family(
    "C06", clean_orders, ORDER_SQL, f"({ROW_COUNTS})", {"clean": NOTHING, "null_net_amount": one(T, NULL_LOW), "missing": one(T, MISSING)},
    {"clean": 0, "null_net_amount": 1, "missing": 1})


@query("g03_independent_counts", statement((SHALLOW,)))
def _independent(v: Inputs) -> DataFrame:
    """A check that only counts rows misses a null: its count is right for one defect and wrong for the other."""
    text = "SELECT (SELECT COUNT(*) FROM source_orders) - (SELECT COUNT(*) FROM target_orders) AS violation_count"
    return certify.cases_frame(v.spark, certify.certify_text(text, SHALLOW.variants(clean_orders(v)), SHALLOW.expected))


# Grain, versions, days, loads, freshness, histories

LINE_SQL = {"order_lines": view("order_lines"), "target_order_totals": view("line_totals")}
GRAIN = sql_diff("(SELECT order_id, SUM(net_amount) AS net_amount FROM {order_lines} l GROUP BY order_id)", "{target_order_totals}",
                 ["order_id"], ["net_amount"])
TOTALS = "target_order_totals"
SECOND = at("order_id", "SECOND")
DOUBLED = changed(LOW, net_amount="net_amount * 2")
# The second lowest total's lines come again under numbers of their own, and its total is twice as much.
MORE_LINES = "(SELECT * FROM {order_lines} l UNION ALL SELECT * REPLACE (line_id + (SELECT MAX(line_id) FROM {order_lines} q) AS line_id) " \
    "FROM {order_lines} l WHERE order_id = " + second("{target_order_totals}", "order_id") + ")"
GRAIN_FAMILY = Family(
    "C07", lambda v: {"order_lines": v("order_lines"), TOTALS: v("line_totals")}, LINE_SQL, GRAIN,
    {"clean": NOTHING, "join_fanout": one(TOTALS, DOUBLED), "join_fanout_two": {TOTALS: "(SELECT * REPLACE (CASE WHEN order_id = " + second(
        "{target_order_totals}", "order_id") + " THEN net_amount + 0.01 ELSE net_amount END AS net_amount) FROM " + edited(TOTALS, DOUBLED) + " d)"},
     "join_missing": one(TOTALS, without(SECOND)), "join_null": one(TOTALS, changed(LOW, net_amount="NULL")),
     "join_unexpected": {TOTALS: "(SELECT order_id, net_amount FROM {target_order_totals} t UNION ALL SELECT MAX(order_id) + 1, 8.00 FROM {target_order_totals} t)"},
     "join_zero": {"order_lines": MORE_LINES, **one(TOTALS, changed(SECOND, net_amount="net_amount * 2"))}},
    {"clean": 0, "join_fanout": 1, "join_fanout_two": 2, "join_missing": 1, "join_unexpected": 1, "join_null": 1, "join_zero": 0},
    {"order_lines": "order_id", TOTALS: "order_id"})
family_query("f09_join_grain", GRAIN_FAMILY)


def ranked_edit(ranked: str, columns: str, key: str, hit: str) -> str:
    """The newest version of each key, and the runner-up of those that ``hit`` names."""
    return f"(SELECT {columns} FROM {ranked} r WHERE rn = CASE WHEN {key} IN ({hit}) THEN 2 ELSE 1 END)"


def version_family(check: str, source: str, target: str, ranked: str, columns: str, key: str, when: str, value: str, prefix: str, newest) -> Family:
    compared = [c for c in columns.split(", ") if c != key]
    tied = f"""SELECT MIN(x.{key}) FROM {ranked} x JOIN {ranked} y ON x.{key} = y.{key} AND x.rn = 1 AND y.rn = 2 AND x.{when} = y.{when}"""
    stale = ranked_edit(ranked, columns, key, f"SELECT MIN({key}) FROM {ranked} r WHERE rn = 2")
    edits = {
        "clean": NOTHING, f"{prefix}_stale": {target: stale}, f"{prefix}_tie": {target: ranked_edit(ranked, columns, key, tied)},
        f"{prefix}_missing": one(target, without(at(key, "MAX"))), f"{prefix}_null": one(target, changed(at(key), **{value: "NULL"})),
    }
    expected = {"clean": 0, f"{prefix}_stale": 1, f"{prefix}_tie": 1, f"{prefix}_missing": 1, f"{prefix}_null": 1}
    if prefix == "latest":
        two = f"SELECT {key} FROM {ranked} r WHERE rn = 2 ORDER BY {key} LIMIT 2"
        edits["latest_stale_two"], expected["latest_stale_two"] = {target: ranked_edit(ranked, columns, key, two)}, 2

    def near(tables: Tables) -> dict[str, list[DataFrame]]:
        """The lowest keys with two versions, and with two newest ones."""
        events = tables[source]
        several = events.groupBy(key).agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(key)
        return {key: [k.orderBy(key).limit(2) for k in (several, faults.tied_keys(events, key, when))]}

    wanted = f"""(SELECT {columns} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY {when} DESC NULLS FIRST, event_id DESC NULLS FIRST)
        AS place FROM {{{source}}} e) r WHERE place = 1)"""
    return Family(
        check, lambda v: {source: v(source), target: newest(v(source))}, {source: view(source), target: f"SELECT {columns} FROM {ranked} WHERE rn = 1"},
        sql_diff(wanted, f"{{{target}}}", [key], compared), edits, expected, {source: key, target: key}, near)


STALE_ORDERS = version_family(
    "C08", "source_order_events", "target_current_orders", "ranked_order_events", "event_id, order_id, updated_at, net_amount", "order_id", "updated_at",
    "net_amount", "latest", lambda events: latest_by(events, ["order_id"], ["updated_at", "event_id"]))
STALE_CUSTOMERS = version_family(
    "C12", "source_customer_changes", "target_customers_current", "ranked_changes", "event_id, customer_id, effective_at, tier", "customer_id",
    "effective_at", "tier", "scd1", type1_current)
family_query("f10_stale_versions", STALE_ORDERS)
family_query("f10_stale_customers", STALE_CUSTOMERS)

DAY_SQL = {"source_time_orders": view("source_time_orders"), "target_utc_daily": view("clean_utc_daily")}
UTC_DAYS = Family(
    "C09", lambda v: {"source_time_orders": v("source_time_orders"), "target_utc_daily": v("clean_utc_daily")}, DAY_SQL,
    sql_diff("""(SELECT CAST(ordered_at AS DATE) AS order_date, COUNT(*) AS order_count, CAST(SUM(net_amount) AS DECIMAL(18,2)) AS net_revenue
        FROM {source_time_orders} o GROUP BY 1)""", "{target_utc_daily}", ["order_date"], ["order_count", "net_revenue"]),
    {"clean": NOTHING, "utc_connection_zone": NOTHING, "utc_missing": one("target_utc_daily", without(at("order_date"))),
     "utc_null": one("target_utc_daily", changed(at("order_date", "MAX"), net_revenue="NULL"))},
    {"clean": 0, "utc_connection_zone": 0, "utc_missing": 1, "utc_null": 1})
family_query("f11_utc_days", UTC_DAYS)

MERGE_ORDER = "ORDER BY event_at DESC NULLS FIRST, event_id DESC NULLS FIRST"
LOADED = "SELECT event_id, order_id, event_at, net_amount FROM"


def merged_sql(rows: str, order: str = MERGE_ORDER) -> str:
    return f"({LOADED} (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id {order}) AS place FROM {rows} b) r WHERE place = 1)"


# The watermark after a batch is the newest event time among what was let in; a replayed batch lets nothing in.
MARK_ONE = "(SELECT MAX(event_at) FROM incremental_events WHERE batch_no = 1)"
MARK_TWO = f"(SELECT GREATEST({MARK_ONE}, MAX(event_at)) FROM incremental_events WHERE batch_no = 2)"
LET_IN = f"""(SELECT * FROM incremental_events WHERE batch_no = 1 OR (batch_no = 2 AND event_at > {MARK_ONE})
    OR (batch_no = 3 AND event_at > {MARK_TWO}))"""
POLICY_SQL = {
    "lab_context": "SELECT 'C10' AS lab_id, MAX(arrived_at) AS as_of FROM incremental_events", "incremental_events": view("incremental_events"),
    "incremental_target": merged_sql("incremental_events"),
}
POLICIES = Family(
    "C10", lambda v: {
        "incremental_events": v("incremental_events"),
        "lab_context": v("incremental_events").agg(F.lit("C10").alias("lab_id"), F.max("arrived_at").alias("as_of")),
        "incremental_target": loads.run_batches(v("incremental_events"), (1, 2, 2, 3))},
    POLICY_SQL,
    "(" + sql_diff(merged_sql("(SELECT * FROM {incremental_events} e WHERE arrived_at <= (SELECT as_of FROM {lab_context} c))"), "{incremental_target}", ["order_id"], ["event_id", "event_at", "net_amount"])
    + " + " + sql_duplicates("{incremental_target}", ["order_id"]) + ")",
    {"clean": NOTHING,
     "inc_append": {"incremental_target": f"({LOADED} incremental_events UNION ALL {LOADED} incremental_events WHERE batch_no = 2)"},
     "inc_event_watermark": {"incremental_target": merged_sql(LET_IN)},
     "inc_stale": {"incremental_target": merged_sql("incremental_events", "ORDER BY batch_no, event_at DESC NULLS FIRST, event_id DESC NULLS FIRST")},
     "inc_missing": {"incremental_target": merged_sql(
         "(SELECT * FROM incremental_events WHERE event_id <> (SELECT MIN(event_id) FROM incremental_events WHERE batch_no = 3))")}})
family_query("f12_policy_counts", POLICIES)


def fresh(v: Inputs) -> Tables:
    needs = v("freshness_requirements")
    observed = needs.select(
        "dataset_id", F.expr("as_of - interval '1' minute").alias("last_success_at"), F.expr("as_of - interval '2' minute").alias("last_event_at"),
        F.lit("SUCCESS").alias("execution_status"))
    return {"freshness_requirements": needs, "freshness_observations": observed}


FRESH_SQL = {
    "freshness_requirements": view("freshness_requirements"),
    "freshness_observations": """SELECT dataset_id, as_of - INTERVAL '1' MINUTE AS last_success_at, as_of - INTERVAL '2' MINUTE AS last_event_at,
        'SUCCESS' AS execution_status FROM freshness_requirements""",
}
NOT_MET = f"""(SELECT COUNT(*) - COUNT(*) FILTER (WHERE {FRESH}) FROM {{freshness_requirements}} r
    LEFT JOIN {{freshness_observations}} o ON r.dataset_id = o.dataset_id)"""


def asked(order: str) -> Step:
    return lambda src: f"dataset_id = (SELECT dataset_id FROM {{freshness_requirements}} q ORDER BY sla_minutes {order}, dataset_id {order} LIMIT 1)"


TIGHT, LOOSE = asked("ASC"), asked("DESC")
CLOCK = "(SELECT MAX(as_of) FROM {freshness_requirements} q)"
TOO_OLD = f"{CLOCK} - (SELECT MIN(sla_minutes) FROM {{freshness_requirements}} q) * INTERVAL '1' MINUTE - INTERVAL '1' SECOND"
SEEN = "freshness_observations"


def near_freshness(tables: Tables) -> dict[str, list[DataFrame]]:
    """The datasets with the tightest and the loosest limit, and one with the latest clock."""
    needs = tables["freshness_requirements"].where(F.col("dataset_id").isNotNull())
    orders = ([F.col("sla_minutes"), F.col("dataset_id")], [F.col("sla_minutes").desc(), F.col("dataset_id").desc()], [F.col("as_of").desc()])
    return {"dataset_id": [needs.orderBy(*order).limit(1).select("dataset_id") for order in orders]}


STALE_TIGHT = changed(TIGHT, last_event_at=TOO_OLD)
FRESHNESS = Family(
    "C11", fresh, FRESH_SQL, NOT_MET,
    {"clean": NOTHING,
     "fresh_boundary": {SEEN: """(SELECT dataset_id, as_of - sla_minutes * INTERVAL '1' MINUTE AS last_success_at,
        as_of - sla_minutes * INTERVAL '1' MINUTE AS last_event_at, 'SUCCESS' AS execution_status FROM {freshness_requirements} r)"""},
     "fresh_stale": one(SEEN, STALE_TIGHT), "fresh_load_stale": one(SEEN, changed(TIGHT, last_success_at=TOO_OLD)),
     "fresh_missing": one(SEEN, without(LOOSE)), "fresh_null": one(SEEN, changed(TIGHT, last_event_at="NULL")),
     "fresh_future": one(SEEN, changed(TIGHT, last_event_at=f"{CLOCK} + INTERVAL '1' SECOND")),
     "fresh_failed": one(SEEN, changed(TIGHT, execution_status="'FAILED'")),
     "fresh_multiple": one(SEEN, STALE_TIGHT, changed(LOOSE, last_success_at="NULL", last_event_at="NULL"))},
    {"clean": 0, "fresh_boundary": 0, "fresh_stale": 1, "fresh_load_stale": 1, "fresh_missing": 1, "fresh_null": 1, "fresh_future": 1, "fresh_failed": 1,
     "fresh_multiple": 2},
    {"freshness_requirements": "dataset_id", "freshness_observations": "dataset_id"}, near_freshness, wide=("fresh_boundary",))
family_query("f13_freshness", FRESHNESS)

HISTORY = "target_customer_history"
CLEAN_HISTORY = "SELECT *, valid_to IS NULL AS is_current FROM clean_history"
HISTORY_COUNT = "(" + " + ".join((
    sql_diff("""(SELECT *, valid_to IS NULL AS is_current FROM (SELECT customer_id, tier, effective_at AS valid_from,
            LEAD(effective_at) OVER (PARTITION BY customer_id ORDER BY effective_at ASC NULLS LAST) AS valid_to
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id, effective_at ORDER BY event_id DESC NULLS FIRST) AS place
            FROM {source_customer_changes} e) r WHERE place = 1) h)""", "{target_customer_history}", ["customer_id", "valid_from"], ["tier", "valid_to", "is_current"]),
    """(SELECT COUNT(*) FROM {target_customer_history} x JOIN {target_customer_history} y ON x.customer_id = y.customer_id AND x.version_id < y.version_id
        WHERE COALESCE(x.valid_to, TIMESTAMP '9999-12-31') > y.valid_from AND COALESCE(y.valid_to, TIMESTAMP '9999-12-31') > x.valid_from)""",
    """(SELECT COUNT(*) FROM (SELECT customer_id FROM {target_customer_history} h GROUP BY customer_id HAVING COUNT(*) FILTER (WHERE is_current) <> 1) c)""",
    "(SELECT COUNT(*) FROM {target_customer_history} h WHERE valid_to <= valid_from)",
    sql_duplicates("{target_customer_history}", ["customer_id", "valid_from"]))) + ")"


def closed(which: str) -> Step:
    def where(src: str) -> str:
        rows = f"(SELECT version_id FROM {src} q WHERE valid_to IS NOT NULL)"
        return f"version_id = {second(rows, 'version_id') if which == 'SECOND' else end(rows, 'version_id')}"
    return where


def open_of_lowest(src: str) -> str:
    return f"valid_to IS NULL AND customer_id = (SELECT MIN(customer_id) FROM {src} q WHERE valid_to IS NULL)"


def near_history(tables: Tables) -> dict[str, list[DataFrame]]:
    """Customers of the lowest closed versions, and of the highest version."""
    history = tables[HISTORY]
    shut = history.where(F.col("valid_to").isNotNull()).orderBy("version_id").limit(2)
    return {"customer_id": [shut.select("customer_id"), history.orderBy(F.col("version_id").desc()).limit(1).select("customer_id")]}


HISTORIES = Family(
    "C13", lambda v: {"source_customer_changes": v("source_customer_changes"), HISTORY: type2_history(v("source_customer_changes"))},
    {"source_customer_changes": view("source_customer_changes"), HISTORY: CLEAN_HISTORY}, HISTORY_COUNT,
    {"clean": NOTHING, "scd2_overlap": one(HISTORY, changed(closed("FIRST"), valid_to="valid_to + INTERVAL '1' HOUR")),
     "scd2_gap": one(HISTORY, changed(closed("FIRST"), valid_to="valid_to - INTERVAL '1' HOUR")),
     "scd2_invalid": one(HISTORY, changed(closed("FIRST"), valid_to="valid_from")),
     "scd2_two_current": one(HISTORY, changed(closed("SECOND"), is_current="TRUE")), "scd2_missing": one(HISTORY, without(closed("SECOND"))),
     "scd2_duplicate": one(HISTORY, lambda src: again(open_of_lowest, version_id=f"(SELECT MAX(version_id) + 92 FROM {src} q)")(src)),
     "scd2_wrong_tier": one(HISTORY, changed(lambda src: f"valid_to IS NULL AND customer_id = {second(src, 'customer_id')}", tier="'SILVER'"))},
    {}, {"source_customer_changes": "customer_id", HISTORY: "customer_id"}, near_history)
family_query("f14_history_faults", HISTORIES)



def moved(family: Family, **columns: tuple[str, ...]) -> Family:
    """The family with one control: all its tables moved on, by ids and by instants."""
    def step(column: str) -> str:
        if column == "dataset_id":
            return "dataset_id || '_v2'"
        return f"{column} + 10000" if column.endswith("_id") else f"CAST({column} + INTERVAL '5' DAY AS {'DATE' if column.endswith('date') else 'TIMESTAMP'})"

    edits = {t: "(SELECT * REPLACE ({}) FROM {{{}}} m)".format(", ".join(f"{step(c)} AS {c}" for c in names), t) for t, names in columns.items()}
    return replace(family, edits={"adv_shifted": edits}, expected={"adv_shifted": 0}, domains={})


family_query(
    "f08_moved_controls",
    moved(GRAIN_FAMILY, order_lines=("order_id",), target_order_totals=("order_id",)),
    moved(STALE_ORDERS, source_order_events=("event_id", "order_id", "updated_at"), target_current_orders=("event_id", "order_id", "updated_at")),
    moved(UTC_DAYS, source_time_orders=("order_id", "ordered_at"), target_utc_daily=("order_date",)),
    moved(POLICIES, incremental_events=("event_id", "order_id", "event_at", "arrived_at"), lab_context=("as_of",),
          incremental_target=("event_id", "order_id", "event_at")),
    moved(FRESHNESS, freshness_requirements=("dataset_id", "as_of"), freshness_observations=("dataset_id", "last_success_at", "last_event_at")),
    moved(STALE_CUSTOMERS, source_customer_changes=("event_id", "customer_id", "effective_at"),
          target_customers_current=("event_id", "customer_id", "effective_at")),
    moved(HISTORIES, source_customer_changes=("event_id", "customer_id", "effective_at"),
          target_customer_history=("version_id", "customer_id", "valid_from", "valid_to")))

# Text amounts

PRICED = "CAST(CAST(gross_text AS DECIMAL(18,2)) - CAST(discount_text AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS net_amount"
BATCH_THREE = "SELECT * REPLACE (CAST(3 AS INT) AS batch_no) FROM etl_context"
GOOD_TEXT = "regexp_matches({0}, '^[0-9]+([.][0-9]{{1,2}})?$')"
GOOD_ROW = f"({GOOD_TEXT.format('gross_text')} AND {GOOD_TEXT.format('discount_text')})"


def loaded(source: str, batch_no: int = 3) -> Callable[[Inputs], Tables]:
    def clean(v: Inputs) -> Tables:
        context = v("etl_context").withColumn("batch_no", F.lit(batch_no))
        rows = v(source).withColumn("arrived_batch", F.lit(1)) if batch_no == 1 else v(source)
        return faults.etl_outputs({"etl_context": context, "etl_customers": v("etl_customers"), "etl_source": rows})
    return clean


ETL = "etl_target"
ETL_SQL = {"etl_source": view("etl_clean_source"), "etl_customers": view("etl_customers"), ETL: view("etl_good_target")}
EXACT = sql_diff(f"(SELECT order_id, {PRICED} FROM {{etl_source}} s)", "{etl_target}", ["order_id"], ["net_amount"])
LAST_SOURCE = at("order_id", "MAX")
ETL_KEYS = {"etl_source": "order_id", ETL: "order_id"}
family_query("f15_quarantine_faults", Family(
    "C16", loaded("etl_source"),
    {"etl_source": view("etl_source"), ETL: view("etl_good_target"),
     "etl_rejects": f"SELECT order_id, 'INVALID_AMOUNT' AS reason FROM etl_source WHERE NOT {GOOD_ROW}"},
    "(" + " + ".join((
        sql_diff(f"(SELECT order_id FROM etl_source WHERE {GOOD_ROW})", "{etl_target}", ["order_id"]),
        sql_diff(f"(SELECT order_id, 'INVALID_AMOUNT' AS reason FROM etl_source WHERE NOT {GOOD_ROW})", "{etl_rejects}", ["order_id"], ["reason"]),
        sql_duplicates("{etl_rejects}", ["order_id"]))) + ")",
    {"clean": NOTHING, "etl_drop_reject": one("etl_rejects", without(at("order_id", "MAX"))),
     "etl_accept_invalid": {ETL: """(SELECT * FROM {etl_target} t UNION ALL SELECT order_id, order_id, 0, order_id FROM {etl_rejects} r
        WHERE order_id = (SELECT MIN(order_id) FROM {etl_rejects} q))"""}},
    {"clean": 0, "etl_drop_reject": 1, "etl_accept_invalid": 1}))
family_query("f15_transform_faults", Family(
    "C15", loaded("etl_clean_source"), ETL_SQL, EXACT,
    {"clean": NOTHING, "etl_null_amount": one(ETL, changed(HIGH, net_amount="NULL")), "etl_rounding": one(ETL, changed(HIGH, net_amount="ROUND(net_amount, 0)"))},
    {}, ETL_KEYS))
family_query("f15_mapping_faults", Family(
    "C14", loaded("etl_clean_source"), ETL_SQL,
    sql_diff("(SELECT s.order_id, c.customer_id FROM {etl_source} s JOIN {etl_customers} c ON s.customer_code = c.customer_code)", "{etl_target}",
             ["order_id"], ["customer_id"]),
    {"clean": NOTHING, "etl_wrong_mapping": one(ETL, changed(LOW, customer_id="(SELECT MAX(customer_id) FROM etl_customers)")),
     "etl_missing": one(ETL, without(HIGH))}, {"clean": 0, "etl_wrong_mapping": 1, "etl_missing": 1}, ETL_KEYS))

REPLAYED = f"(SELECT order_id, order_id AS customer_id, {PRICED}, event_id FROM replay_source)"


def replay_newest(rows: str) -> str:
    return f"(SELECT order_id, customer_id, net_amount, event_id FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY event_id DESC) AS place " \
           f"FROM {rows} p) r WHERE place = 1)"


LATE_OF_FIRST = f"""(SELECT order_id, order_id AS customer_id, {PRICED}, event_id FROM replay_source WHERE NOT (arrived_batch > 1
    AND order_id = (SELECT order_id FROM replay_source ORDER BY event_id LIMIT 1)))"""
family_query("f15_replay_faults", Family(
    "C17", loaded("replay_source"), {"etl_context": BATCH_THREE, "etl_source": view("replay_source"), ETL: f"SELECT * FROM {replay_newest(REPLAYED)} n"},
    "(" + sql_diff(replay_newest(REPLAYED), "{etl_target}", ["order_id"], ["event_id", "net_amount"]) + " + "
    + sql_duplicates("{etl_target}", ["order_id"]) + ")",
    {"clean": NOTHING, "etl_append": {ETL: REPLAYED}, "etl_skip_late": {ETL: replay_newest(LATE_OF_FIRST)}}))
STEPS_SQL = "SELECT 1 AS step_no, 'SUCCESS' AS execution_status, 1 AS checkpoint"
family_query("f15_recovery_faults", Family(
    "C18", loaded("etl_clean_source", 1), {"etl_source": view("etl_clean_source"), ETL: view("etl_good_target"), "etl_steps": STEPS_SQL},
    f"({EXACT} + (SELECT COUNT(*) FROM {{etl_steps}} s WHERE execution_status <> 'SUCCESS' OR checkpoint <> 1))",
    {"clean": NOTHING, "etl_failed": {**one(ETL, only(lambda src: "FALSE")), **one("etl_steps", changed(always, execution_status="'FAILED'", checkpoint="0"))},
     "etl_partial_publish": one(ETL, without(HIGH))}))

# Landed pages: one crawl over all records, five to a page

def landed(v: Inputs) -> Tables:
    listing = v("api_listing").select(
        "order_id", "customer_id", "net_amount", (F.floor(F.col("order_id") * F.lit(0.2).cast("decimal(2,1)")) + 1).alias("page"), "pos")
    return {"api_expected": v("api_expected").drop("crawl_id"), "api_listing": listing}


# In SQL a delivery is one row per record, with what is wrong with it; a crawl that fails at its first page delivers none.
DELIVERED = "SELECT order_id, customer_id, net_amount, FALSE AS faulty FROM api_expected"
CRAWL_SQL = {"api_expected": view("api_expected"), "delivered": DELIVERED, "crawl": "SELECT 0 AS failed FROM region WHERE r_regionkey = (SELECT MIN(r_regionkey) FROM region)"}
FAILED = {**one("crawl", changed(always, failed="1")), **one("delivered", only(lambda src: "FALSE"))}
LAST_FAULTY = one("delivered", changed(HIGH, faulty="TRUE"))
CRAWL_FAILED = "(SELECT failed FROM {crawl} c)"
IDS = """(SELECT COUNT(*) FROM (SELECT order_id FROM {api_expected} e EXCEPT SELECT order_id FROM {delivered} d) m)
    + (SELECT COUNT(*) FROM (SELECT order_id FROM {delivered} d EXCEPT SELECT order_id FROM {api_expected} e) u)"""
IDS_TWICE = sql_duplicates("{delivered}", ["order_id"])


class CrawlFamily(Family):
    def counted(self, v: Inputs) -> DataFrame:
        clean = landed(v)
        variants = {s: inject(clean, *self.scenario(s)) for s in self.edits}
        return certify.count_variants(CHECKS[self.check], variants, ["api_expected", "api_attempts"])


def crawl_family(check: str, count: str, edits: dict, expected: dict) -> Family:
    return CrawlFamily(check, landed, CRAWL_SQL, f"({count})", {"api_clean": NOTHING, **edits}, {})


family_query(
    "f16_page_fault_counts",
    crawl_family("C19", f"{CRAWL_FAILED} + (SELECT COUNT(*) FROM {{delivered}} d WHERE faulty)",
                 {"api_missing_field": LAST_FAULTY, "api_wrong_type": LAST_FAULTY, "api_wrong_status": FAILED}, {}),
    crawl_family("C20", f"{CRAWL_FAILED} + {IDS} + {IDS_TWICE}",
                 {"api_missing_page": one("delivered", without(HIGH)), "api_duplicate_page": one("delivered", again(HIGH))}, {}),
    crawl_family("C21", f"{CRAWL_FAILED} + {IDS}", {"api_exhausted": FAILED, "api_timeout": FAILED}, {}),
    crawl_family("C22", f"{CRAWL_FAILED} + {IDS} + {IDS_TWICE} + "
                 + sql_diff("{api_expected}", "(SELECT DISTINCT order_id, customer_id, net_amount FROM {delivered} d)", ["order_id"], ["customer_id", "net_amount"]),
                 {"api_ingest_missing": one("delivered", without(HIGH)), "api_ingest_wrong": one("delivered", changed(HIGH, net_amount="net_amount + 0.01")),
                  "api_ingest_duplicate": one("delivered", again(HIGH))}, {}))

# Evidence

FIRST_ROW = first("order_id", 1)
SHIFTED_KEY = changed(LOW, order_id="order_id + 5000")
RECORD = ["customer_id", "amount", "event_id", "updated_at"]
TARGET, LATEST = "cloud_target", view("cloud_latest")
CONTEXT = {"cloud_context": view("cloud_context"), "cloud_source": view("cloud_source")}


def layer_sql(expected: str, actual: str) -> str:
    return sql_diff(expected, actual, ["order_id"], RECORD) + " + " + sql_duplicates(actual, ["order_id"])


def clean_layers(v: Inputs) -> Tables:
    context = v("cloud_context")
    base = v.tables("cloud_context", "cloud_source")
    published = loads.publish_layers(base["cloud_source"], context.select("batch_no").scalar(), context.select("as_of").scalar())
    return {**base, **published, **v.tables(
        cloud_runs="sound_runs", cloud_activities="sound_activities", cloud_schema="sound_schema", cloud_expected_schema="sound_schema",
        cloud_manifest="sound_manifest", cloud_expected_partitions="sound_partitions", cloud_references="sound_references",
        cloud_required_references="sound_required_references", cloud_steps="sound_steps")}


def evidence_family(check: str, sql: dict, count: str, edits: dict, expected: dict | None = None) -> Family:
    return Family(check, clean_layers, sql, f"({count})", {"cloud_clean": NOTHING, **edits}, expected or {})


SOUND = {f"cloud_{n}": view(f"sound_{n}") for n in (
    "runs", "activities", "schema", "manifest", "references", "required_references", "steps")}
SOUND |= {"cloud_expected_schema": view("sound_schema"), "cloud_expected_partitions": view("sound_partitions")}
LAYER_SQL = {**CONTEXT, "cloud_bronze": LATEST, "cloud_silver": LATEST, TARGET: LATEST}
ONE_CENT = changed(LOW, amount="amount + 0.01")
family_query("f17_layer_faults", evidence_family(
    "C25", LAYER_SQL, " + ".join((
        layer_sql("cloud_latest", "{cloud_bronze}"), layer_sql("{cloud_bronze}", "{cloud_silver}"), layer_sql("{cloud_silver}", "{cloud_target}"))),
    {"cloud_layer_swap": {**one("cloud_silver", SHIFTED_KEY), **one(TARGET, SHIFTED_KEY)}, "cloud_layer_amount": one(TARGET, ONE_CENT),
     "cloud_layer_duplicate": one(TARGET, again(FIRST_ROW))},
    {"cloud_clean": 0, "cloud_layer_swap": 2, "cloud_layer_amount": 1, "cloud_layer_duplicate": 1}))
TARGET_COUNT = layer_sql("cloud_latest", "{cloud_target}")


def seen_newest(where: str) -> str:
    """What a load would publish that lets in the rows of ``where`` only."""
    return f"""(SELECT order_id, customer_id, amount, updated_at, event_id, batch_no, run_id FROM
        (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY event_id DESC NULLS FIRST) AS place FROM cloud_source
         WHERE batch_no <= (SELECT batch_no FROM cloud_context) AND {where}) r WHERE place = 1)"""


CLOUD_CLOCK = "(SELECT as_of FROM cloud_context)"
family_query("f17_publish_faults", evidence_family(
    "C27", {**CONTEXT, TARGET: LATEST}, TARGET_COUNT,
    {"cloud_copy_missing": one(TARGET, without(LOW)), "cloud_copy_swap": one(TARGET, SHIFTED_KEY), "cloud_replay_duplicate": one(TARGET, again(FIRST_ROW)),
     "cloud_skip_late": {TARGET: seen_newest(f"updated_at <= {CLOUD_CLOCK} AND NOT (batch_no > 1 AND updated_at < {CLOUD_CLOCK})")},
     "cloud_boundary_skip": {TARGET: seen_newest(f"updated_at < {CLOUD_CLOCK}")}}))
ACTIVITY = "cloud_activities"
LINEAGE = """(SELECT COUNT(*) FROM {cloud_activities} a LEFT JOIN {cloud_runs} r ON a.run_id = r.run_id
        WHERE r.run_id IS NULL OR r.execution_status = 'UNKNOWN' OR a.execution_status = 'UNKNOWN' OR a.source_dataset IS NULL OR a.target_dataset IS NULL)
    + (SELECT COUNT(*) FROM {cloud_activities} a LEFT JOIN {cloud_activities} d ON a.dependency_id = d.activity_id AND a.run_id = d.run_id
        WHERE a.dependency_id IS NOT NULL AND d.execution_status IS DISTINCT FROM 'SUCCESS')
    + (SELECT COUNT(*) FROM {cloud_target} t WHERE run_id NOT IN (SELECT run_id FROM {cloud_runs} r))"""
PUBLISHES = "target_dataset = 'target'"
METRICS = f"""{TARGET_COUNT} + (SELECT COUNT(*) FROM {{cloud_activities}} a WHERE {PUBLISHES} AND (execution_status <> 'SUCCESS'
        OR rows_read IS DISTINCT FROM (SELECT COUNT(*) FROM cloud_latest) OR rows_written IS DISTINCT FROM (SELECT COUNT(*) FROM {{cloud_target}} t)))
    + (SELECT CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END FROM {{cloud_activities}} a WHERE {PUBLISHES})"""
SCHEMA = sql_diff("{cloud_expected_schema}", "{cloud_schema}", ["dataset", "column_name"], ["data_type"]) + " + " + sql_duplicates(
    "{cloud_schema}", ["dataset", "column_name"])
AMOUNT_COLUMN: Step = lambda src: "column_name = 'amount'"
RECOVERED = f"""{TARGET_COUNT} + (SELECT COUNT(*) FROM {{cloud_activities}} a WHERE execution_status <> 'SUCCESS')
    + (SELECT COUNT(*) FROM {{cloud_steps}} s WHERE execution_status <> 'SUCCESS' OR batch_no <> (SELECT batch_no FROM cloud_context))"""
FAILED_CHAIN = {
    ACTIVITY: "(SELECT * REPLACE (CASE WHEN activity_id = (SELECT MIN(activity_id) FROM {cloud_activities} q) THEN 'FAILED' ELSE 'UNKNOWN' END "
              "AS execution_status) FROM {cloud_activities} a)",
    **one("cloud_steps", changed(always, execution_status="'FAILED'", batch_no="0")),
}
MANIFEST = sql_diff("{cloud_expected_partitions}", "(SELECT partition_key, SUM(row_count) AS row_count FROM {cloud_manifest} f GROUP BY partition_key)",
                    ["partition_key"], ["row_count"]) + " + " + sql_duplicates("{cloud_manifest}", ["file_key"])
EXTRA_FILE = """(SELECT * FROM {cloud_manifest} m UNION ALL SELECT '2026-01-04', 'extra.csv', 1, MAX(snapshot_at), MAX(run_id) FROM {cloud_manifest} m)"""
MEETING = "{{cloud_required_references}} e {} JOIN {{cloud_references}} a ON e.dataset_id = a.dataset_id AND e.reference_id = a.reference_id"
REFERENCES = f"""(SELECT COUNT(*) FROM {MEETING.format('FULL OUTER')} WHERE e.dataset_id IS NULL OR a.dataset_id IS NULL OR a.observed_at IS NULL
    OR a.observed_at > {CLOUD_CLOCK} OR a.observed_at < {CLOUD_CLOCK} - e.sla_minutes * INTERVAL '1' MINUTE)"""
OBSERVED = "cloud_references"
family_query(
    "f17_evidence_faults",
    evidence_family("C23", {ACTIVITY: SOUND[ACTIVITY], "cloud_runs": SOUND["cloud_runs"], TARGET: LATEST}, LINEAGE, {
        "cloud_orphan_run": one(TARGET, changed(LOW, run_id="'unlinked'")),
        "cloud_dependency_missing": one(ACTIVITY, changed(
            lambda src: f"dependency_id IS NOT NULL AND activity_id = {end(src, 'activity_id', 'MAX')}", dependency_id="'missing'")),
        "cloud_unknown_run": one("cloud_runs", changed(always, execution_status="'UNKNOWN'"))}),
    evidence_family("C24", {n: SOUND[n] for n in ("cloud_expected_schema", "cloud_schema")}, SCHEMA, {
        "cloud_schema_type": one("cloud_schema", changed(AMOUNT_COLUMN, data_type="'float'")),
        "cloud_schema_missing": one("cloud_schema", without(AMOUNT_COLUMN)),
        "cloud_schema_extra": {"cloud_schema": "(SELECT * FROM {cloud_schema} s UNION ALL SELECT 'target', 'debug', 'text')"}}),
    evidence_family("C26", {**CONTEXT, TARGET: LATEST, ACTIVITY: SOUND[ACTIVITY]}, METRICS, {
        "cloud_copy_swap": one(TARGET, SHIFTED_KEY), "cloud_copy_missing": one(TARGET, without(LOW)),
        "cloud_copy_metrics": one(ACTIVITY, changed(lambda src: PUBLISHES, rows_read="99")),
        "cloud_copy_unknown": one(ACTIVITY, changed(lambda src: PUBLISHES, rows_read="NULL"))}),
    evidence_family("C28", {**CONTEXT, TARGET: LATEST, ACTIVITY: SOUND[ACTIVITY], "cloud_steps": SOUND["cloud_steps"]}, RECOVERED, {
        "cloud_failed_dependency": FAILED_CHAIN, "cloud_partial_publish": one(TARGET, without(LOW)),
        "cloud_checkpoint": one("cloud_steps", changed(always, batch_no="0"))}),
    evidence_family("C29", {n: SOUND[n] for n in ("cloud_expected_partitions", "cloud_manifest")}, MANIFEST, {
        "cloud_partition_missing": one("cloud_manifest", without(at("partition_key"))), "cloud_partition_extra": {"cloud_manifest": EXTRA_FILE},
        "cloud_file_duplicate": one("cloud_manifest", again(first("file_key", 1)))}),
    evidence_family("C30", {"cloud_context": view("cloud_context"), "cloud_required_references": SOUND["cloud_required_references"],
                            OBSERVED: SOUND[OBSERVED]}, REFERENCES, {
        "cloud_reference_stale": one(OBSERVED, changed(always, observed_at="observed_at - INTERVAL '1' MICROSECOND")),
        "cloud_reference_missing": one(OBSERVED, only(lambda src: "FALSE")), "cloud_reference_null": one(OBSERVED, changed(always, observed_at="NULL")),
        "cloud_reference_future": one(OBSERVED, changed(always, observed_at="observed_at + INTERVAL '61' MINUTE"))}))

# Contracts, each defect on one row and, as ``alt__``, on two

RUN_ID = "'run-1' AS run_id"


def clean_contracts(v: Inputs) -> Tables:
    run = F.lit("run-1").alias("run_id")
    clock = v("cloud_context").select("as_of").scalar().alias("observed_at")
    seen = {"az_files": v("az_expected_files").select("*", clock, run),
            "az_access": v("az_required_access").select("*", F.lit("ALLOWED").alias("outcome"), clock, run)}
    expected = v.tables("db_contract", "db_expected_after", "sy_expected_fact", "sy_expected_report", "az_expected_files", "az_required_access",
                        "cloud_context", "sy_dimension")
    return {
        **expected, **seen, "db_publication": expected["db_contract"].select("*", run), "db_after": expected["db_expected_after"].select("*", run),
        "sy_fact": expected["sy_expected_fact"].select("*", run), "sy_report": expected["sy_expected_report"].select("*", run)}


def contract_family(check: str, expected: str, observed: str, keys: list[str], fields: list[str], key: str, edits: Callable[[int], dict], where: str = "",
                    more: dict | None = None, seen: str = "", domains: bool = True) -> Family:
    """``edits`` gives the edits that hit so many rows."""
    sql = {expected: view(expected), observed: f"SELECT *{seen}, {RUN_ID} FROM {expected}", **(more or {})}
    variants = {"f_clean": NOTHING, **edits(1), **{f"alt__{k}": e for k, e in edits(2).items()}}
    return Family(
        check, clean_contracts, sql, f"({sql_diff(f'{{{expected}}}', f'{{{observed}}}', keys, fields, where)} + {sql_duplicates(f'{{{observed}}}', keys)})",
        variants, {}, {expected: key, observed: key} if domains else {}, scenario=lambda v: (v.removeprefix("alt__"), v.startswith("alt__")))


def on(key: str, n: int, order: str = "NULLS LAST", **values: str) -> Step:
    return changed(first(key, n, order), **values)


def publication_faults(n: int) -> dict:
    p = "db_publication"
    return {"f_lost": one(p, without(first("record_id", n))), "f_classification": one(p, on("record_id", n, classification="'QUARANTINED'")),
            "f_duplicate_publication": one(p, again(first("record_id", n)))}


def version_faults(n: int) -> dict:
    a = "db_after"
    return {"f_stale_overwrite": one(a, on("order_id", n, version="0", amount="amount + 0.01")), "f_duplicate_replay": one(a, again(first("order_id", n))),
            "f_unintended_delete": one(a, without(first("order_id", n, "DESC NULLS FIRST")))}


def fact_faults(n: int) -> dict:
    f = "sy_fact"
    return {"f_fact_missing": one(f, without(first("sale_id", n))), "f_dimension_mapping": one(f, on("sale_id", n, customer_key="-9999")),
            "f_fact_unexpected": one(f, lambda src: again(first("sale_id", n), sale_id=f"sale_id + (SELECT MAX(sale_id) FROM {src} q) + 9000")(src))}


def report_faults(n: int) -> dict:
    """The first rows by region name regions, and all rows of those are hit."""
    r, dimension = "sy_report", "{sy_dimension}"
    doubled = f"(SELECT * FROM {dimension} d UNION ALL SELECT * FROM {dimension} d WHERE {first('customer_key', n)(dimension)})"
    return {"f_report_total": one(r, on("region", n, total="total + 0.01")), "f_report_grain": one(r, on("region", n, region="region || '-wrong'")),
            "f_join_fanout": {r: f"""(SELECT f.sale_date, d.region, COUNT(*) AS sale_count, CAST(SUM(f.amount) AS DECIMAL(14,2)) AS total, {RUN_ID}
                FROM sy_expected_fact f JOIN {doubled} d ON f.customer_key = d.customer_key GROUP BY f.sale_date, d.region)"""}}


def file_faults(n: int) -> dict:
    f = "az_files"
    return {"f_file_missing": one(f, without(first("file_id", n))), "f_file_unexpected": one(f, again(first("file_id", n), file_id="file_id || '-unexpected'")),
            "f_file_duplicate": one(f, again(first("file_id", n))), "f_file_route": one(f, on("file_id", n, route="'customers'", path="'/wrong/route.csv'"))}


def access_faults(n: int) -> dict:
    a, key = "az_access", "observation_id"
    return {"f_access_denied": one(a, on(key, n, outcome="'DENIED'")), "f_access_identity": one(a, on(key, n, identity_id="NULL")),
            "f_access_scope": one(a, on(key, n, scope="NULL")), "f_access_missing": one(a, without(first(key, n))),
            "f_access_future": one(a, on(key, n, observed_at="observed_at + INTERVAL '1' MICROSECOND"))}


SEEN_AT = f", {CLOUD_CLOCK} AS observed_at"
family_query("f18_publication_faults", contract_family(
    "C31", "db_contract", "db_publication", ["record_id"], ["classification", "amount"], "record_id", publication_faults))
family_query("f18_version_faults", contract_family(
    "C32", "db_expected_after", "db_after", ["order_id"], ["version", "amount", "updated_at"], "order_id", version_faults))
family_query("f18_fact_faults", contract_family(
    "C33", "sy_expected_fact", "sy_fact", ["sale_id"], ["customer_key", "amount", "sale_date"], "sale_id", fact_faults))
family_query("f18_report_faults", contract_family(
    "C34", "sy_expected_report", "sy_report", ["sale_date", "region"], ["sale_count", "total"], "region", report_faults,
    more={"sy_dimension": view("sy_dimension")}, domains=False))
family_query("f18_file_faults", contract_family(
    "C35", "az_expected_files", "az_files", ["file_id"], ["path", "route", "byte_count"], "file_id", file_faults, seen=SEEN_AT))
family_query("f18_access_faults", contract_family(
    "C36", "az_required_access", "az_access", ["observation_id"], ["identity_id", "scope", "operation"], "observation_id", access_faults,
    f" OR a.outcome IS DISTINCT FROM 'ALLOWED' OR a.observed_at IS NULL OR a.observed_at > {CLOUD_CLOCK}", seen=f", 'ALLOWED' AS outcome{SEEN_AT}"))
