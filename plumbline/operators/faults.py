"""Defect variants of a table set, as pure DataFrame edits.

``inject(tables, scenario)`` returns the tables with one named defect (or one
named clean control). Inputs are never changed. Edits address rows by key values
found in the data, so they work on tables of any size.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.exprs import net_amount
from plumbline.operators.previews import half_subset
from plumbline.operators.rollups import local_daily, utc_daily
from plumbline.operators.scope import attach
from plumbline.plans import loads

Tables = dict[str, DataFrame]
Edit = Callable[..., Tables]

SCENARIOS: dict[str, Edit] = {}


def scenario(*names: str):
    def register(edit: Edit) -> Edit:
        for name in names:
            SCENARIOS[name] = edit
        return edit

    return register


def inject(tables: Tables, name: str, alternate: bool = False) -> Tables:
    """Tables with the defect. ``alternate`` hits two rows, or another column, instead of one."""
    if name not in SCENARIOS:
        raise ValueError(f"unknown scenario: {name}")
    return {**tables, **SCENARIOS[name](tables, name, alternate)}


# Edits

def lowest(df: DataFrame, key: str) -> Column:
    return df.agg(F.min(key)).scalar()


def highest(df: DataFrame, key: str) -> Column:
    return df.agg(F.max(key)).scalar()


def second(df: DataFrame, key: str) -> Column:
    """The second lowest key value."""
    two = df.select(key).where(F.col(key).isNotNull()).distinct().orderBy(key).limit(2)
    return two.agg(F.max(key)).scalar()


def update(df: DataFrame, condition: Column, **values) -> DataFrame:
    hit = F.coalesce(condition, F.lit(False))
    changed = {}
    for name, value in values.items():
        new = value if isinstance(value, Column) else F.lit(value)
        changed[name] = F.when(hit, new.cast(df.schema[name].dataType)).otherwise(F.col(name))
    return df.withColumns(changed)


def remove(df: DataFrame, condition: Column) -> DataFrame:
    return df.where(~F.coalesce(condition, F.lit(False)))


def repeat(df: DataFrame, condition: Column) -> DataFrame:
    return df.unionByName(df.where(condition))


def first_keys(df: DataFrame, key: str, n: int, descending: bool = False) -> DataFrame:
    """The keys of the first ``n`` rows by key."""
    order = F.col(key).desc_nulls_first() if descending else F.col(key).asc_nulls_last()
    return df.select(key).orderBy(order).limit(n)


def hit_by(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows flagged ``_hit`` when their key is listed; the list has one or two keys."""
    listed = F.broadcast(keys.distinct().withColumn("_hit", F.lit(True)))
    return df.join(listed, key, "left").withColumn("_hit", F.coalesce("_hit", F.lit(False)))


def second_version(events: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The runner-up version of every key."""
    ranking = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_first() for c in order])
    ranked = events.withColumn("_rank", F.row_number().over(ranking)).where(F.col("_rank") <= 2)
    return ranked.where(F.col("_rank") == 2).drop("_rank")


def tied_keys(events: DataFrame, key: str, at: str) -> DataFrame:
    """Keys whose newest instant is shared by several events."""
    newest = events.groupBy(key).agg(F.max(at).alias(at))
    counted = events.join(newest, [key, at], "left_semi").groupBy(key).agg(F.count(F.lit(1)).alias("c"))
    return counted.where("c > 1").select(key)


def replace_rows(target: DataFrame, replacement: DataFrame, key: str) -> DataFrame:
    """Target with the rows of the replaced keys swapped for the given ones."""
    kept = target.join(replacement.select(key), key, "left_anti")
    return kept.unionByName(replacement.select(*target.columns)).select(*target.columns)


# Orders (C01-C06)

def rebuild(t: Tables) -> Tables:
    """Target and daily tables recomputed from the source: the clean baseline."""
    source = t["source_orders"]
    target = source.select("order_id", "customer_id", "ordered_at", net_amount().alias("net_amount"))
    daily = utc_daily(target)
    return {"source_orders": source, "target_orders": target, "gold_daily_sales": daily, "target_daily_sales": daily}


@scenario("clean")
def _clean(t, name, alternate) -> Tables:
    return {}


@scenario("clean_subset")
def _clean_subset(t, name, alternate) -> Tables:
    return rebuild({**t, "source_orders": half_subset(t["source_orders"], "order_id")})


@scenario("clean_zero")
def _clean_zero(t, name, alternate) -> Tables:
    source = t["source_orders"]
    zero = {c: F.lit(0) for c in ("gross_amount", "discount_amount", "refund_amount")}
    return rebuild({**t, "source_orders": update(source, F.col("order_id") == lowest(source, "order_id"), **zero)})


@scenario("missing", "missing_order")
def _missing(t, name, alternate) -> Tables:
    target = t["target_orders"]
    return {"target_orders": remove(target, F.col("order_id") == lowest(target, "order_id"))}


@scenario("swapped", "equal_count_swap")
def _swapped(t, name, alternate) -> Tables:
    """One key lost and another invented: the count stays the same."""
    left = _missing(t, name, alternate)["target_orders"]
    invented = left.orderBy("order_id").limit(1).withColumn("order_id", highest(t["source_orders"], "order_id") + 1)
    return {"target_orders": left.unionByName(invented)}


# What each single-cell order defect does to the lowest or highest key.
_CELL_FAULTS = {
    "invalid_customer": ("low", "customer_id", -1),
    "invalid_customer_last": ("high", "customer_id", 0),
    "null_net_amount": ("low", "net_amount", None),
    "null_last": ("high", "net_amount", None),
    "wrong_net_amount": ("low", "net_amount", "0.01"),
    "wrong_last": ("high", "net_amount", "-0.01"),
}
_DOUBLE_FAULTS = {
    "invalid_customer_two": ("invalid_customer", "invalid_customer_last"),
    "null_two": ("null_net_amount", "null_last"),
    "wrong_two": ("wrong_net_amount", "wrong_last"),
    "duplicate_twice": ("duplicate_order", "duplicate_last"),
    "duplicate_triple": ("duplicate_order", "duplicate_order"),
    "mixed_order_faults": ("missing_order", "null_last", "duplicate_order", "wrong_net_amount", "daily_wrong"),
}


@scenario(*_CELL_FAULTS)
def _cell(t, name, alternate) -> Tables:
    target = t["target_orders"]
    end, column, value = _CELL_FAULTS[name]
    key = lowest(target, "order_id") if end == "low" else highest(target, "order_id")
    new = F.col(column) + F.lit(value).cast("decimal(14,2)") if isinstance(value, str) else F.lit(value)
    return {"target_orders": update(target, F.col("order_id") == key, **{column: new})}


@scenario("duplicate_order", "duplicate_last")
def _duplicate(t, name, alternate) -> Tables:
    target = t["target_orders"]
    key = highest(target, "order_id") if name.endswith("last") else lowest(target, "order_id")
    return {"target_orders": repeat(target, F.col("order_id") == key)}


@scenario("daily_wrong", "daily_missing")
def _daily(t, name, alternate) -> Tables:
    daily = t["target_daily_sales"]
    first = F.col("order_date") == lowest(daily, "order_date")
    if name == "daily_missing":
        return {"target_daily_sales": remove(daily, first)}
    return {"target_daily_sales": update(daily, first, net_revenue=F.col("net_revenue") + F.lit("0.01").cast("decimal(3,2)"))}


@scenario(*_DOUBLE_FAULTS)
def _several(t, name, alternate) -> Tables:
    for part in _DOUBLE_FAULTS[name]:
        t = inject(t, part)
    return t


# Join grain

@scenario("join_fanout", "join_fanout_two", "join_missing", "join_unexpected", "join_null")
def _join_fault(t, name, alternate) -> Tables:
    totals = t["target_order_totals"]
    low, next_ = F.col("order_id") == lowest(totals, "order_id"), F.col("order_id") == second(totals, "order_id")
    if name == "join_missing":
        changed = remove(totals, next_)
    elif name == "join_null":
        changed = update(totals, low, net_amount=None)
    elif name == "join_unexpected":
        extra = totals.agg((F.max("order_id") + 1).alias("order_id"), F.lit("8.00").cast("decimal(14,2)").alias("net_amount"))
        changed = totals.unionByName(extra)
    else:
        factor = F.when(low, F.lit(2)).otherwise(F.lit(1))
        changed = update(totals, low, net_amount=F.col("net_amount") * factor)
        if name == "join_fanout_two":
            changed = update(changed, next_, net_amount=F.col("net_amount") + F.lit("0.01").cast("decimal(3,2)"))
    return {"target_order_totals": changed}


@scenario("join_zero")
def _join_zero(t, name, alternate) -> Tables:
    """Clean control: repeated line amounts are legitimate and add up."""
    lines, totals = t["order_lines"], t["target_order_totals"]
    again = F.col("order_id") == second(totals, "order_id")
    extra = lines.where(again).withColumn("line_id", F.col("line_id") + highest(lines, "line_id"))
    return {
        "order_lines": lines.unionByName(extra),
        "target_order_totals": update(totals, again, net_amount=F.col("net_amount") * 2),
    }


# Clean control of C07-C13: other keys, other days, the same state

@scenario("adv_shifted")
def _moved(t, name, alternate) -> Tables:
    """Every id, dataset name, day and instant moves by the same step, so that nothing is out of place."""
    def step(column: T.StructField) -> Column | None:
        value, kind = F.col(column.name), column.dataType
        if isinstance(kind, T.LongType) and column.name.endswith("_id"):
            return value + 10_000
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            return value + F.make_dt_interval(days=F.lit(5))
        if isinstance(kind, T.DateType):
            return F.date_add(value, 5)
        return F.concat(value, F.lit("_v2")) if column.name == "dataset_id" else None

    def moved(df: DataFrame) -> DataFrame:
        steps = {c.name: step(c) for c in df.schema}
        return df.withColumns({name: value for name, value in steps.items() if value is not None})

    return {table: moved(df) for table, df in t.items()}


# Latest version and type-1 customers

def _version_fault(t, name, source, target, key, at, value) -> Tables:
    events, current = t[source], t[target]
    low = F.col(key) == lowest(current, key)
    kind = name.split("_", 1)[1]
    if kind == "missing":
        return {target: remove(current, F.col(key) == highest(current, key))}
    if kind == "null":
        return {target: update(current, low, **{value: None})}
    runner_up = second_version(events, [key], [at, "event_id"]).select(*current.columns)
    if kind == "tie":
        hit = F.col(key) == tied_keys(events, key, at).agg(F.min(key)).scalar()
    elif kind == "stale_two":
        hit = F.col(key).isin(lowest(runner_up, key)) | (F.col(key) == second(runner_up, key))
    else:
        hit = F.col(key) == lowest(runner_up, key)
    return {target: replace_rows(current, runner_up.where(hit), key)}


@scenario("latest_stale", "latest_stale_two", "latest_tie", "latest_missing", "latest_null")
def _latest_fault(t, name, alternate) -> Tables:
    return _version_fault(t, name, "source_order_events", "target_current_orders", "order_id", "updated_at", "net_amount")


@scenario("scd1_stale", "scd1_tie", "scd1_missing", "scd1_null")
def _type1_fault(t, name, alternate) -> Tables:
    return _version_fault(
        t, name, "source_customer_changes", "target_customers_current", "customer_id", "effective_at", "tier"
    )


# UTC days (C09)

@scenario("utc_connection_zone")
def _utc_zone(t, name, alternate) -> Tables:
    """Clean control: the session zone must not move an order to another day."""
    return {}


@scenario("utc_local_day", "utc_missing", "utc_null")
def _utc_fault(t, name, alternate) -> Tables:
    daily = t["target_utc_daily"]
    if name == "utc_local_day":
        return {"target_utc_daily": local_daily(t["source_time_orders"], "Asia/Bangkok")}
    if name == "utc_missing":
        return {"target_utc_daily": remove(daily, F.col("order_date") == lowest(daily, "order_date"))}
    return {"target_utc_daily": update(daily, F.col("order_date") == highest(daily, "order_date"), net_revenue=None)}


# Incremental loads

@scenario("inc_append", "inc_event_watermark", "inc_stale", "inc_missing")
def _incremental_fault(t, name, alternate) -> Tables:
    return {"incremental_target": loads.run_batches(t["incremental_events"], (1, 2, 2, 3), name)}


# Freshness (C11)

@scenario("fresh_boundary", "fresh_stale", "fresh_load_stale", "fresh_missing", "fresh_null", "fresh_future",
          "fresh_failed", "fresh_multiple")
def _fresh_fault(t, name, alternate) -> Tables:
    needs, seen = t["freshness_requirements"], t["freshness_observations"]
    tightest = F.col("dataset_id") == needs.agg(F.min_by("dataset_id", F.struct("sla_minutes", "dataset_id"))).scalar()
    loosest = F.col("dataset_id") == needs.agg(F.max_by("dataset_id", F.struct("sla_minutes", "dataset_id"))).scalar()
    clock, limit = highest(needs, "as_of"), F.make_dt_interval(mins=needs.agg(F.min("sla_minutes")).scalar())
    instant = F.make_dt_interval(secs=F.lit(1))
    if name == "fresh_boundary":
        limits = needs.groupBy("dataset_id").agg(F.min("sla_minutes").alias("_sla"), F.max("as_of").alias("_at"))
        edge = F.col("_at") - F.make_dt_interval(mins=F.col("_sla"))
        moved = seen.join(limits, "dataset_id", "left").withColumns({
            c: F.coalesce(edge, F.col(c)) for c in ("last_success_at", "last_event_at")
        })
        return {"freshness_observations": moved.select(*seen.columns)}
    if name == "fresh_missing":
        changed = remove(seen, loosest)
    elif name == "fresh_null":
        changed = update(seen, tightest, last_event_at=None)
    elif name == "fresh_future":
        changed = update(seen, tightest, last_event_at=clock + instant)
    elif name == "fresh_failed":
        changed = update(seen, tightest, execution_status="FAILED")
    else:
        late = "last_success_at" if name == "fresh_load_stale" else "last_event_at"
        changed = update(seen, tightest, **{late: clock - limit - instant})
        if name == "fresh_multiple":
            changed = update(changed, loosest, last_success_at=None, last_event_at=None)
    return {"freshness_observations": changed}


# Type-2 history

@scenario("scd2_overlap", "scd2_two_current", "scd2_missing", "scd2_invalid", "scd2_duplicate", "scd2_wrong_tier",
          "scd2_gap")
def _type2_fault(t, name, alternate) -> Tables:
    history = t["target_customer_history"]
    closed, open_ = history.where(F.col("valid_to").isNotNull()), history.where(F.col("valid_to").isNull())
    first = F.col("version_id") == lowest(closed, "version_id")
    then = F.col("version_id") == second(closed, "version_id")
    hour = F.make_dt_interval(hours=F.lit(1))
    if name == "scd2_overlap":
        changed = update(history, first, valid_to=F.col("valid_to") + hour)
    elif name == "scd2_gap":
        changed = update(history, first, valid_to=F.col("valid_to") - hour)
    elif name == "scd2_invalid":
        changed = update(history, first, valid_to=F.col("valid_from"))
    elif name == "scd2_two_current":
        changed = update(history, then, is_current=True)
    elif name == "scd2_missing":
        changed = remove(history, then)
    elif name == "scd2_duplicate":
        copy = open_.where(F.col("customer_id") == lowest(open_, "customer_id"))
        changed = history.unionByName(copy.withColumn("version_id", highest(history, "version_id") + 92))
    else:
        current = F.col("valid_to").isNull() & (F.col("customer_id") == second(history, "customer_id"))
        changed = update(history, current, tier="SILVER")
    return {"target_customer_history": changed}


# ETL loads

def _recount(t: Tables) -> Tables:
    counted = update(
        t["etl_steps"], F.lit(True),
        target_rows=t["etl_target"].agg(F.count(F.lit(1))).scalar(),
        rejected_rows=t["etl_rejects"].agg(F.count(F.lit(1))).scalar(),
    )
    return {**t, "etl_steps": counted}


def etl_outputs(t: Tables, policy: str = "merge") -> Tables:
    """Target, rejects and one RUN step for the batch in the context."""
    batch_no = t["etl_context"].select("batch_no").scalar()
    target, bad = loads.load_text_orders(t["etl_source"], t["etl_customers"], batch_no, policy)
    step = t["etl_context"].select(
        F.lit(1).alias("step_no"), F.lit("RUN").alias("operation"), F.lit("SUCCESS").alias("execution_status"),
        F.lit(0).cast("bigint").alias("target_rows"), F.lit(0).cast("bigint").alias("rejected_rows"),
        F.col("batch_no").alias("checkpoint"),
    )
    return _recount({**t, "etl_target": target, "etl_rejects": bad, "etl_steps": step})


@scenario("etl_append", "etl_skip_late")
def _etl_policy(t, name, alternate) -> Tables:
    return etl_outputs(t, name)


@scenario("etl_wrong_mapping", "etl_missing", "etl_rounding", "etl_null_amount", "etl_drop_reject",
          "etl_accept_invalid", "etl_failed", "etl_partial_publish")
def _etl_fault(t, name, alternate) -> Tables:
    target, bad, steps = t["etl_target"], t["etl_rejects"], t["etl_steps"]
    low, high = F.col("order_id") == lowest(target, "order_id"), F.col("order_id") == highest(target, "order_id")
    # Missing rows and published parts refer to the last order of the source.
    last = F.col("order_id") == highest(t["etl_source"], "order_id")
    if name == "etl_wrong_mapping":
        target = update(target, low, customer_id=highest(t["etl_customers"], "customer_id"))
    elif name in ("etl_missing", "etl_partial_publish"):
        target = remove(target, last)
    elif name == "etl_rounding":
        target = update(target, high, net_amount=F.round("net_amount", 0))
    elif name == "etl_null_amount":
        target = update(target, high, net_amount=None)
    elif name == "etl_drop_reject":
        bad = remove(bad, F.col("order_id") == highest(bad, "order_id"))
    elif name == "etl_accept_invalid":
        wrong = t["etl_source"].where(F.col("order_id") == lowest(bad, "order_id"))
        accepted = wrong.join(t["etl_customers"], "customer_code").select(
            "order_id", "customer_id", F.lit("0.00").cast("decimal(18,2)").alias("net_amount"), "event_id"
        )
        target = target.unionByName(accepted)
    else:
        target = target.limit(0)
        steps = update(steps, F.lit(True), execution_status="FAILED", checkpoint=0)
    return _recount({**t, "etl_target": target, "etl_rejects": bad, "etl_steps": steps})


# Landed API pages

def record_text(record: DataFrame, drop: str | None = None, as_text: str | Sequence[str] = ()) -> Column:
    """JSON text of an order record; amounts travel as text."""
    texts = ("net_amount", as_text) if isinstance(as_text, str) else ("net_amount", *as_text)
    fields = []
    for name in ("order_id", "customer_id", "net_amount"):
        if name != drop:
            value = F.col(name).cast("string") if name in texts else F.col(name)
            fields.append(value.alias(name))
    return F.to_json(F.struct(*fields))


def land_pages(records: DataFrame, statuses: tuple[int | None, ...] = (200,), by: tuple[str, ...] = (),
               last_pages: DataFrame | None = None) -> DataFrame:
    """Attempt rows for records that carry ``page``, ``pos`` and ``text``.

    A page holds the few records of one response. Each page is answered by the
    given statuses in turn; if the last one is not 200 the crawl ends there.
    ``last_pages`` states the last page of each crawl where it may have no records.
    """
    items = F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"])
    pages = records.groupBy(*by, "page").agg(items.alias("items"))
    crawl = records.groupBy(*by).agg(
        F.min("page").alias("first_page"), F.max("page").alias("_last"), F.count(F.lit(1)).alias("total"))
    pages = attach(pages, crawl, by)
    if last_pages is not None:
        pages = attach(pages.drop("_last"), last_pages.select(*by, F.col("last_page").alias("_last")), by)
    follows = F.when(F.col("page") < F.col("_last"), (F.col("page") + 1).cast("string")).otherwise(F.lit("null"))
    good = F.concat(
        F.lit('{"items":['), F.array_join("items", ","), F.lit('],"next_page":'), follows,
        F.lit(',"total":'), F.col("total").cast("string"), F.lit("}"),
    )
    if statuses[-1] != 200:
        pages = pages.where(F.col("page") == F.col("first_page"))
    tries = F.explode(F.array(*[
        F.struct(F.lit(i).alias("attempt"), F.lit(s).cast("int").alias("status")) for i, s in enumerate(statuses, 1)
    ])).alias("try")
    unavailable = F.when(F.col("try.status").isNull(), F.lit('{"error":"TIMEOUT"}')).otherwise(
        F.lit('{"error":"TEMPORARILY_UNAVAILABLE"}'))
    return pages.select("*", tries).select(
        *by, F.col("page").cast("bigint").alias("page"), F.col("try.attempt").alias("attempt"),
        F.col("try.status").alias("status"),
        F.when(F.col("try.status") == 429, F.lit('{"Content-Type":"application/json","Retry-After":"0"}'))
        .when(F.col("try.status").isNotNull(), F.lit('{"Content-Type":"application/json"}')).alias("headers"),
        F.lit(0).cast("bigint").alias("elapsed_ms"),
        (F.col("try.attempt") == len(statuses)).alias("final"),
        F.when(F.col("try.status") == 200, good).otherwise(unavailable).alias("body"),
    )


# Statuses a page is answered with under each request fault, and when retries succeed.
_REQUEST_FAULTS = {
    "api_wrong_status": (503, 503, 503),
    "api_exhausted": (429, 503, 503),
    "api_timeout": (None, None, None),
}
RETRIED = (429, 503, 200)


def numbered(expected: DataFrame, page: Column, pos: Column) -> DataFrame:
    """Expected records as a server would list them."""
    return expected.select("*", page.alias("page"), pos.alias("pos"))


@scenario("api_clean", "api_missing_field", "api_wrong_type", "api_wrong_status", "api_missing_page",
          "api_duplicate_page", "api_exhausted", "api_timeout", "api_ingest_missing", "api_ingest_wrong",
          "api_ingest_duplicate")
def _api_fault(t, name, alternate) -> Tables:
    """Pages landed from ``api_listing`` (expected records with page and position)."""
    listing = t["api_listing"]
    last = F.col("order_id") == highest(listing, "order_id")
    text = record_text(listing)
    if name == "api_missing_field":
        text = F.when(last, record_text(listing, drop="net_amount")).otherwise(text)
    elif name == "api_wrong_type":
        text = F.when(last, record_text(listing, as_text="customer_id")).otherwise(text)
    elif name == "api_ingest_wrong":
        listing = update(listing, last, net_amount=F.col("net_amount") + F.lit("0.01").cast("decimal(3,2)"))
    rows = listing.withColumn("text", text)
    if name in ("api_missing_page", "api_ingest_missing"):
        rows = remove(rows, last)
    elif name in ("api_duplicate_page", "api_ingest_duplicate"):
        rows = rows.unionByName(rows.where(last).withColumn("pos", F.col("pos") + 1))
    usual = RETRIED if t.get("api_retried") is not None else (200,)
    return {"api_attempts": land_pages(rows, _REQUEST_FAULTS.get(name, usual))}


# Evidence (C23-C30)

@scenario("cloud_clean", "cloud_shifted", "cloud_zero", "cloud_sla_boundary")
def _cloud_clean(t, name, alternate) -> Tables:
    return {}


def _at_lowest(df: DataFrame, key: str) -> Column:
    return F.col(key) == lowest(df, key)


def _repeat_first(df: DataFrame, key: str, n: int = 1) -> DataFrame:
    """The first rows by key once more."""
    return df.unionByName(df.orderBy(F.col(key).asc_nulls_last()).limit(n))


def _one_more_cent() -> Column:
    return F.lit("0.01").cast("decimal(3,2)")


def _extra_column(df: DataFrame, column: str) -> DataFrame:
    return df.unionByName(df.sparkSession.createDataFrame([("target", column, "text")], df.schema))


def _extra_file(df: DataFrame) -> DataFrame:
    row = df.agg(
        F.lit("2026-01-04").alias("partition_key"), F.lit("extra.csv").alias("file_key"),
        F.lit(1).cast("bigint").alias("row_count"), F.max("snapshot_at").alias("snapshot_at"),
        F.max("run_id").alias("run_id"),
    )
    return df.unionByName(row)


def _publishes(column: str = "target_dataset") -> Column:
    return F.col(column) == "target"


def _schema_column(alternate: bool) -> Column:
    return F.col("column_name") == ("customer_id" if alternate else "amount")


def _swap_key(df: DataFrame) -> DataFrame:
    return update(df, _at_lowest(df, "order_id"), order_id=F.col("order_id") + 5000)


# One edit of one table each: scenario -> (table, edit of that table).
_EVIDENCE_FAULTS: dict[str, tuple[str, Callable[[DataFrame, bool], DataFrame]]] = {
    "cloud_orphan_run": ("cloud_target", lambda df, alt: update(df, _at_lowest(df, "order_id"), run_id="unlinked")),
    "cloud_dependency_missing": (
        "cloud_activities",
        lambda df, alt: update(df, F.col("dependency_id").isNotNull()
                               & (F.col("activity_id") == highest(df, "activity_id")), dependency_id="missing")),
    "cloud_unknown_run": ("cloud_runs", lambda df, alt: update(df, F.lit(True), execution_status="UNKNOWN", raw_evidence="{}")),
    "cloud_schema_type": ("cloud_schema", lambda df, alt: update(df, _schema_column(alt), data_type="float")),
    "cloud_schema_missing": ("cloud_schema", lambda df, alt: remove(df, _schema_column(alt))),
    "cloud_schema_extra": ("cloud_schema", lambda df, alt: _extra_column(df, "new_field" if alt else "debug")),
    "cloud_layer_amount": (
        "cloud_target",
        lambda df, alt: update(df, _at_lowest(df, "order_id"), amount=F.col("amount") + _one_more_cent())),
    "cloud_layer_duplicate": ("cloud_target", lambda df, alt: _repeat_first(df, "order_id")),
    "cloud_copy_missing": ("cloud_target", lambda df, alt: remove(df, _at_lowest(df, "order_id"))),
    "cloud_copy_swap": ("cloud_target", lambda df, alt: _swap_key(df)),
    "cloud_copy_metrics": ("cloud_activities", lambda df, alt: update(df, _publishes(), rows_read=123 if alt else 99)),
    "cloud_copy_unknown": ("cloud_activities", lambda df, alt: update(df, _publishes(), rows_read=None)),
    "cloud_partial_publish": ("cloud_target", lambda df, alt: remove(df, _at_lowest(df, "order_id"))),
    "cloud_checkpoint": ("cloud_steps", lambda df, alt: update(df, F.lit(True), batch_no=0)),
    "cloud_partition_missing": ("cloud_manifest", lambda df, alt: remove(df, _at_lowest(df, "partition_key"))),
    "cloud_partition_extra": ("cloud_manifest", lambda df, alt: _extra_file(df)),
    "cloud_file_duplicate": ("cloud_manifest", lambda df, alt: _repeat_first(df, "file_key")),
    "cloud_reference_stale": (
        "cloud_references",
        lambda df, alt: update(df, F.lit(True), observed_at=F.col("observed_at") - F.expr("interval '0.000001' second"))),
    "cloud_reference_missing": ("cloud_references", lambda df, alt: df.limit(0)),
    "cloud_reference_null": ("cloud_references", lambda df, alt: update(df, F.lit(True), observed_at=None)),
    "cloud_reference_future": (
        "cloud_references",
        lambda df, alt: update(df, F.lit(True), observed_at=F.col("observed_at") + F.expr("interval '61' minute"))),
}


@scenario(*_EVIDENCE_FAULTS)
def _evidence_fault(t, name, alternate) -> Tables:
    table, edit = _EVIDENCE_FAULTS[name]
    return {table: edit(t[table], alternate)}


@scenario("cloud_layer_swap")
def _layer_swap(t, name, alternate) -> Tables:
    return {table: _swap_key(t[table]) for table in ("cloud_silver", "cloud_target")}


@scenario("cloud_skip_late", "cloud_boundary_skip", "cloud_replay_duplicate")
def _publish_fault(t, name, alternate) -> Tables:
    context = t["cloud_context"]
    return loads.publish_layers(
        t["cloud_source"], context.select("batch_no").scalar(), context.select("as_of").scalar(), name
    )


@scenario("cloud_failed_dependency")
def _failed_dependency(t, name, alternate) -> Tables:
    activities = t["cloud_activities"]
    first = F.when(_at_lowest(activities, "activity_id"), F.lit("FAILED")).otherwise(F.lit("UNKNOWN"))
    return {
        "cloud_activities": update(activities, F.lit(True), execution_status=first),
        "cloud_runs": update(t["cloud_runs"], F.lit(True), execution_status="FAILED"),
        "cloud_steps": update(t["cloud_steps"], F.lit(True), execution_status="FAILED", batch_no=0),
    }


# Contracts

def _on_first(df: DataFrame, key: str, n: int, descending: bool = False, **values) -> DataFrame:
    flagged = hit_by(df, first_keys(df, key, n, descending), key)
    return update(flagged, F.col("_hit"), **values).select(*df.columns)


def _without_first(df: DataFrame, key: str, n: int, descending: bool = False) -> DataFrame:
    flagged = hit_by(df, first_keys(df, key, n, descending), key)
    return flagged.where(~F.col("_hit")).select(*df.columns)


def _invented(df: DataFrame, key: str, n: int, new_key: Column) -> DataFrame:
    """The first rows once more under keys that do not exist."""
    return df.unionByName(df.orderBy(F.col(key).asc_nulls_last()).limit(n).withColumn(key, new_key))


# Scenario -> (table, edit of that table hitting n rows).
_CONTRACT_FAULTS: dict[str, tuple[str, Callable[[DataFrame, int], DataFrame]]] = {
    "f_lost": ("db_publication", lambda df, n: _without_first(df, "record_id", n)),
    "f_classification": ("db_publication", lambda df, n: _on_first(df, "record_id", n, classification="QUARANTINED")),
    "f_duplicate_publication": ("db_publication", lambda df, n: _repeat_first(df, "record_id", n)),
    "f_stale_overwrite": (
        "db_after", lambda df, n: _on_first(df, "order_id", n, version=0, amount=F.col("amount") + _one_more_cent())),
    "f_duplicate_replay": ("db_after", lambda df, n: _repeat_first(df, "order_id", n)),
    "f_unintended_delete": ("db_after", lambda df, n: _without_first(df, "order_id", n, descending=True)),
    "f_fact_missing": ("sy_fact", lambda df, n: _without_first(df, "sale_id", n)),
    "f_fact_unexpected": ("sy_fact", lambda df, n: _invented(df, "sale_id", n, F.col("sale_id") + highest(df, "sale_id") + 9000)),
    "f_dimension_mapping": ("sy_fact", lambda df, n: _on_first(df, "sale_id", n, customer_key=-9999)),
    "f_report_total": ("sy_report", lambda df, n: _on_first(df, "region", n, total=F.col("total") + _one_more_cent())),
    "f_report_grain": ("sy_report", lambda df, n: _on_first(df, "region", n, region=F.concat("region", F.lit("-wrong")))),
    "f_file_missing": ("az_files", lambda df, n: _without_first(df, "file_id", n)),
    "f_file_unexpected": ("az_files", lambda df, n: _invented(df, "file_id", n, F.concat("file_id", F.lit("-unexpected")))),
    "f_file_duplicate": ("az_files", lambda df, n: _repeat_first(df, "file_id", n)),
    "f_file_route": ("az_files", lambda df, n: _on_first(df, "file_id", n, route="customers", path="/wrong/route.csv")),
    "f_access_denied": ("az_access", lambda df, n: _on_first(df, "observation_id", n, outcome="DENIED")),
    "f_access_identity": ("az_access", lambda df, n: _on_first(df, "observation_id", n, identity_id=None)),
    "f_access_scope": ("az_access", lambda df, n: _on_first(df, "observation_id", n, scope=None)),
    "f_access_missing": ("az_access", lambda df, n: _without_first(df, "observation_id", n)),
    "f_access_future": (
        "az_access",
        lambda df, n: _on_first(
            df, "observation_id", n, observed_at=F.col("observed_at") + F.expr("interval '0.000001' second"))),
}


@scenario("f_clean", "f_shifted", "f_zero")
def _contract_clean(t, name, alternate) -> Tables:
    return {}


@scenario(*_CONTRACT_FAULTS)
def _contract_fault(t, name, alternate) -> Tables:
    table, edit = _CONTRACT_FAULTS[name]
    return {table: edit(t[table], 2 if alternate else 1)}


@scenario("f_join_fanout")
def _fanout(t, name, alternate) -> Tables:
    """A dimension that lists customers twice, and the report published from it."""
    dimension = _repeat_first(t["sy_dimension"], "customer_key", 2 if alternate else 1)
    return {"sy_dimension": dimension, "sy_report": loads.publish_report(t["sy_fact"], dimension)}
