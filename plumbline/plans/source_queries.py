"""Sources, layer runs, rules, faults, certification and verdicts over the given tables."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.contracts import STATUSES, Dataset, catalog, not_null, record_count, same_fields, same_keys, schema_of, unique, worst
from plumbline.functions.exprs import epoch_micros, net_amount, run_problems
from plumbline.operators import certify, verdicts
from plumbline.operators.faults import inject, rebuild
from plumbline.operators import suites
from plumbline.operators.rules import FrameSource, execute_rules, results_frame
from plumbline.plans import fault_runs, loads, orders as layered
from plumbline.plans.check_queries import CRAWL, api_tables, landed_attempts
from plumbline.plans.inputs import Inputs
from plumbline.plans.quality import inspect_quality, run_quality_suite
from plumbline.plans.registry import query
from plumbline.plans.suites import EXPECTED_FAILURES
from plumbline.session import work_dir
from plumbline.sources import evidence as bundles
from plumbline.sources import generator, pages
from plumbline.sources.commits import CommitConflict
from plumbline.sources.store import Store
from plumbline.streaming import keyed
from plumbline.streaming import merge as stream

Tables = dict[str, DataFrame]


def as_utc(df: DataFrame, *names: str) -> DataFrame:
    """Timestamps without zone taken as UTC instants."""
    return df.withColumns({n: F.timestamp_micros(epoch_micros(df, n)) for n in names})


def seeded_store(v: Inputs) -> Store:
    store = Store(v.spark, work_dir(v.spark, "layers"))
    seed(store, v)
    return store


def seed(store: Store, v: Inputs) -> None:
    customers = v("customer").select(F.col("c_custkey").alias("customer_id"), F.lit("VN").alias("country_code"))
    layered.seed_source(store, customers, as_utc(v("source_orders"), "ordered_at", "updated_at"))


# Generators

GENERATED = """
    SELECT id AS order_id, id * 73 % 1000 + 1 AS customer_id, gross AS gross_amount,
           CAST(CAST(id * 37 % 1500 AS DECIMAL(14,2)) * 0.01 AS DECIMAL(14,2)) AS discount_amount,
           CASE WHEN id % 17 = 0 THEN CAST(ROUND(gross * 0.10, 2) AS DECIMAL(14,2)) ELSE CAST(0 AS DECIMAL(14,2)) END AS refund_amount,
           1767225600000000 + id * 37 % 43200 * 60000000 AS ordered_us,
           1767225600000000 + id * 37 % 43200 * 60000000 + id % 48 * 3600000000 AS updated_us
    FROM (SELECT o_orderkey + 1 AS id,
                 CAST(CAST(5000 + (o_orderkey + 1) * 7919 % 500000 AS DECIMAL(14,2)) * 0.01 AS DECIMAL(14,2)) AS gross FROM orders) g"""


def generated_orders(v: Inputs) -> DataFrame:
    return generator.orders_from_ids(v("orders").select((F.col("o_orderkey") + 1).alias("order_id")), 1000)


@query("s01_customer_generator", """
    SELECT c_custkey + 1 AS customer_id, CASE c_custkey % 5 WHEN 0 THEN 'VN' WHEN 1 THEN 'US' WHEN 2 THEN 'GB' WHEN 3 THEN 'SG'
           ELSE 'AU' END AS country_code FROM customer""")
def _customers(v):
    return generator.customers_from_ids(v("customer").select((F.col("c_custkey") + 1).alias("customer_id")))


@query("s02_order_generator", GENERATED)
def _orders(v):
    made = generated_orders(v)
    return made.withColumns({"ordered_us": F.unix_micros("ordered_at"), "updated_us": F.unix_micros("updated_at")}).drop(
        "ordered_at", "updated_at")


@query("s03_expected_revenue", f"""
    SELECT CAST(SUM(CAST(gross_amount - discount_amount - refund_amount AS DECIMAL(14,2))) AS DECIMAL(18,2)) AS net_revenue
    FROM ({GENERATED}) o""")
def _revenue(v):
    return generator.expected_net_revenue(generated_orders(v))


# Layers

NET = "CAST(SUM(net_amount) AS DECIMAL(18,2))"


@query("s04_seed_source", f"""
    SELECT (SELECT COUNT(*) FROM customer) AS customers, COUNT(*) AS orders, {NET} AS net_revenue FROM clean_orders""")
def _seed(v):
    """Seeding twice leaves one copy."""
    store = seeded_store(v)
    seed(store, v)
    totals = store.read("source.orders").agg(
        F.count(F.lit(1)).alias("orders"), F.sum(net_amount()).cast("decimal(18,2)").alias("net_revenue"))
    return totals.select(
        store.read("source.customers").agg(F.count(F.lit(1))).scalar().alias("customers"), "orders", "net_revenue")


@query("s05_run_scoped_scan", "SELECT COUNT(*) AS n, MIN(order_id) AS lowest, MAX(order_id) AS highest FROM clean_orders WHERE order_id % 2 = 0")
def _scan(v):
    store = Store(v.spark, work_dir(v.spark, "runs"))
    reports = as_utc(v("clean_orders"), "ordered_at")
    for run_id, rest in (("even", 0), ("odd", 1)):
        store.write_run("target.orders_report", reports.where(F.col("order_id") % 2 == rest), run_id)
    return store.read_run("target.orders_report", "even").agg(
        F.count(F.lit(1)).alias("n"), F.min("order_id").alias("lowest"), F.max("order_id").alias("highest"))


def staged(v: Inputs, last: str) -> tuple[Store, str]:
    """A run up to the given stage."""
    names = list(layered.STAGE_STEPS)
    steps = {n: layered.STAGE_STEPS[n] for n in names[: names.index(last) + 1]}
    store = seeded_store(v)
    run_id, _ = layered.run_orders(store, steps=steps)
    return store, run_id


@query("s06_bronze_layer", "SELECT order_id, customer_id, gross_amount, discount_amount, refund_amount, TRUE AS stamped FROM source_orders")
def _bronze(v):
    store, run_id = staged(v, "BRONZE")
    return store.read_run("bronze.orders", run_id).select(
        "order_id", "customer_id", "gross_amount", "discount_amount", "refund_amount", F.col("ingested_at").isNotNull().alias("stamped"))


@query("s07_silver_layer", "SELECT order_id, customer_id, net_amount FROM clean_orders")
def _silver(v):
    store, run_id = staged(v, "SILVER")
    return store.read_run("silver.orders", run_id).select("order_id", "customer_id", "net_amount")


@query("s08_gold_layer", """
    SELECT CAST(ordered_at AS DATE) AS order_date, COUNT(*) AS order_count, CAST(SUM(gross_amount) AS DECIMAL(18,2)) AS gross_revenue,
           CAST(SUM(CAST(gross_amount - discount_amount - refund_amount AS DECIMAL(14,2))) AS DECIMAL(18,2)) AS net_revenue
    FROM source_orders GROUP BY CAST(ordered_at AS DATE)""")
def _gold(v):
    store, run_id = staged(v, "GOLD")
    return store.read_run("gold.daily_sales", run_id).drop("run_id")


@query("s09_target_reports", """
    SELECT g.order_date, g.order_count, g.net_revenue, o.report_rows FROM gold_daily_sales g
    JOIN (SELECT CAST(ordered_at AS DATE) AS order_date, COUNT(*) AS report_rows FROM clean_orders GROUP BY 1) o ON g.order_date = o.order_date""")
def _target(v):
    from plumbline.functions.exprs import utc_day

    store, run_id = staged(v, "TARGET")
    report = store.read_run("target.orders_report", run_id)
    per_day = report.groupBy(utc_day(report, "ordered_at").alias("order_date")).agg(F.count(F.lit(1)).alias("report_rows"))
    return store.read_run("target.daily_sales_report", run_id).drop("run_id").join(per_day, "order_date")


@query("s10_stage_metrics", f"""
    SELECT 'SOURCE' AS stage_name, COUNT(*) AS row_count, CAST({NET} AS VARCHAR) AS net_revenue FROM clean_orders
    UNION ALL SELECT 'BRONZE', COUNT(*), NULL FROM clean_orders
    UNION ALL SELECT 'SILVER', COUNT(*), CAST({NET} AS VARCHAR) FROM clean_orders
    UNION ALL SELECT 'GOLD', (SELECT COUNT(*) FROM gold_daily_sales), CAST({NET} AS VARCHAR) FROM clean_orders
    UNION ALL SELECT 'TARGET', COUNT(*), CAST({NET} AS VARCHAR) FROM clean_orders""")
def _metrics(v):
    store, run_id = staged(v, "TARGET")
    rows = store.read("metadata.stage_runs").where(F.col("run_id") == run_id)
    return rows.select("stage_name", "row_count", F.get_json_object("metrics", "$.net_revenue").alias("net_revenue"))


@query("s11_run_log", """
    SELECT 'good' AS run, 'SUCCESS' AS execution_status, 'NOT_RUN' AS data_quality_status, 'BRONZE' AS stage_name,
           'SUCCESS' AS stage_status, COUNT(*) AS row_count FROM orders
    UNION ALL SELECT 'good', 'SUCCESS', 'NOT_RUN', 'SOURCE', 'SUCCESS', COUNT(*) FROM orders
    UNION ALL SELECT 'bad', 'FAILED', 'NOT_RUN', 'SOURCE', 'SUCCESS', COUNT(*) FROM orders
    UNION ALL SELECT 'bad', 'FAILED', 'NOT_RUN', 'BRONZE', 'FAILED', NULL""")
def _log(v):
    """A failing stage is on record, and the run that worked keeps its own record."""
    def broken(store, run_id):
        raise ValueError("no space")

    store, _ = staged(v, "SOURCE")
    first = {n: layered.STAGE_STEPS[n] for n in ("SOURCE", "BRONZE")}
    layered.run_orders(store, "good", first)
    try:
        layered.run_orders(store, "bad", {**first, "BRONZE": broken})
    except layered.StageFailed:
        pass
    runs = layered.current_runs(store).select(F.col("run_id").alias("run"), "execution_status", "data_quality_status")
    stages = store.read("metadata.stage_runs").select(
        F.col("run_id").alias("run"), "stage_name", F.col("execution_status").alias("stage_status"), "row_count")
    return runs.join(stages, "run").where(F.col("run").isin("good", "bad"))


@query("s12_run_inspection", """
    SELECT 'latest' AS run_id, 'SUCCESS' AS execution_status, stage_name, (SELECT COUNT(*) FROM orders) AS row_count
    FROM (VALUES ('SOURCE'), ('BRONZE')) s(stage_name)""")
def _inspect(v):
    store, _ = staged(v, "SOURCE")
    layered.run_orders(store, "latest", {n: layered.STAGE_STEPS[n] for n in ("SOURCE", "BRONZE")})
    found = layered.inspect_run(store)
    rows = [(found["run_id"], found["execution_status"], s["stage_name"], s["row_count"]) for s in found["stages"]]
    return v.spark.createDataFrame(rows, "run_id string, execution_status string, stage_name string, row_count bigint")


@query("s13_validation_log", f"""
    SELECT 'orders_quality_v2' AS suite_id, check_type, 'PASS' AS status, n AS rules, (SELECT COUNT(*) FROM orders) AS source_rows
    FROM (VALUES ('RECORD_COUNT', 5), ('UNIQUENESS', 5), ('NOT_NULL', 5), ('SCHEMA', 5), ('KEY_RECONCILIATION', 3),
                 ('FIELD_RECONCILIATION', 3)) c(check_type, n)""")
def _suite(v):
    """The built-in suite over a complete run: 26 rules, all of them passing."""
    store, run_id = staged(v, "TARGET")
    run_quality_suite(store, run_id)
    found = inspect_quality(store, run_id)
    rows = v.spark.createDataFrame(
        [(found["suite_id"], r["check_type"], r["status"]) for r in found["results"]], "suite_id string, check_type string, status string")
    counted = rows.groupBy("suite_id", "check_type", "status").agg(F.count(F.lit(1)).cast("int").alias("rules"))
    return counted.withColumn("source_rows", store.read_run("bronze.orders", run_id).agg(F.count(F.lit(1))).scalar())


@query("s14_order_snapshot", """
    SELECT 'source_orders' AS name, COUNT(*) AS n FROM source_orders UNION ALL SELECT 'target_orders', COUNT(*) FROM clean_orders
    UNION ALL SELECT 'gold_daily_sales', COUNT(*) FROM gold_daily_sales UNION ALL SELECT 'target_daily_sales', COUNT(*) FROM gold_daily_sales""")
def _snapshot(v):
    store, run_id = staged(v, "TARGET")
    counts = [t.agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("n")) for n, t in layered.order_snapshot(store, run_id).items()]
    first, *rest = counts
    for part in rest:
        first = first.unionByName(part)
    return first


@query("s04_conflicting_commit", """
    SELECT 1 AS step, 'first' AS writer, 'published' AS outcome, 1 AS version, COUNT(*) FILTER (WHERE order_id % 3 = 0) AS n FROM clean_orders
    UNION ALL SELECT 2, 'second', 'conflict', 1, COUNT(*) FILTER (WHERE order_id % 3 = 0) FROM clean_orders
    UNION ALL SELECT 3, 'second', 'published', 2, COUNT(*) FILTER (WHERE order_id % 3 = 1) FROM clean_orders""")
def _conflict(v):
    """Two writers on one parent: the first one commits, the second one learns of it, reads on and publishes on the new parent."""
    store, rows, told = Store(v.spark, work_dir(v.spark, "snapshots")), v("clean_orders"), []
    parent = store.version("target.orders")
    for step, (writer, rest, on) in enumerate((("first", 0, parent), ("second", 1, parent), ("second", 1, None)), 1):
        try:
            store.publish("target.orders", rows.where(F.col("order_id") % 3 == rest), f"{writer}{step}", store.version("target.orders") if on is None else on)
            outcome = "published"
        except CommitConflict:
            outcome = "conflict"
        told.append(store.current("target.orders").agg(
            F.lit(step).alias("step"), F.lit(writer).alias("writer"), F.lit(outcome).alias("outcome"),
            F.lit(store.version("target.orders")).alias("version"), F.count(F.lit(1)).alias("n")))
    return reduce(DataFrame.unionByName, told)


@query("s15_clean_baseline", "SELECT order_date, order_count, net_revenue FROM gold_daily_sales")
def _baseline(v):
    return rebuild({"source_orders": v("source_orders")})["target_daily_sales"]


@query("s04_published_snapshot", "SELECT COUNT(*) AS n FROM clean_orders WHERE order_id % 3 = 1")
def _published(v):
    """Readers see the snapshot published last, not one that was only written."""
    store = Store(v.spark, work_dir(v.spark, "snapshots"))
    rows = v("clean_orders")
    for snapshot, rest in (("a", 0), ("b", 1)):
        store.publish("target.orders", rows.where(F.col("order_id") % 3 == rest), snapshot)
    rows.write.mode("overwrite").parquet(f"{store.path('target.orders')}/snapshot=c")
    return store.current("target.orders").agg(F.count(F.lit(1)).alias("n"))


# Evidence bundles: twenty-five customers each

BUNDLES = """(SELECT c_custkey, CAST(FLOOR(c_custkey * 0.04) AS BIGINT) AS bundle, 'act-' || CAST(c_custkey AS STRING) AS activity_id,
    'run-' || CAST(c_custkey AS STRING) AS run_id, c_custkey % 211 = 7 AS negative, c_custkey % 307 = 9 AS elsewhere FROM customer)"""
ACCEPTED = f"""(SELECT * FROM {BUNDLES} b WHERE bundle NOT IN (SELECT bundle FROM {BUNDLES} x WHERE negative OR elsewhere))"""
CAPTURED = datetime(2026, 1, 3, 12, tzinfo=timezone.utc)


def customer_records(v: Inputs) -> tuple[DataFrame, Tables]:
    """Headers and records of bundles, some with a field that version 1 refuses."""
    people = v("customer").select("c_custkey", F.floor(F.col("c_custkey") / F.lit(25)).alias("bundle"))
    clock = F.lit(CAPTURED)
    header = people.select("bundle").distinct().select(
        "bundle", F.lit("ADF").alias("provider"), F.lit("workspace").alias("resource_id"), clock.alias("as_of"), F.lit(1).alias("batch_no"))
    key = F.col("c_custkey")
    runs = people.select(
        "bundle", F.concat(F.lit("run-"), key).alias("run_id"),
        F.when(key % 3 == 0, F.lit("Succeeded")).when(key % 3 == 1, F.lit("Paused")).alias("execution_status"),
        clock.alias("started_at"), clock.alias("ended_at"))
    activities = people.select(
        "bundle", F.concat(F.lit("act-"), key).alias("activity_id"), F.concat(F.lit("run-"), key).alias("run_id"),
        F.lit(None).cast("string").alias("dependency_id"), F.lit("Completed").alias("execution_status"),
        F.when(key % 307 == 9, F.lit("elsewhere")).otherwise(F.lit("source")).alias("source_dataset"), F.lit("target").alias("target_dataset"),
        F.when(key % 211 == 7, F.lit(-1)).otherwise(key).alias("rows_read"), key.alias("rows_written"))
    return header, {"runs": runs, "activities": activities}


def customer_bundles(v: Inputs) -> DataFrame:
    """The bundles as one document each."""
    return bundles.with_hash(bundles.export_bundles(*customer_records(v)))


@query("s16_evidence_json", f"""
    SELECT bundle, activity_id, run_id, 'SUCCESS' AS execution_status, c_custkey AS rows_read FROM {ACCEPTED} a""")
def _json(v):
    """Record lines written as text, read back, judged and typed; a bundle with a refused record is refused whole."""
    path = work_dir(v.spark, "bundles")
    header, sections = customer_records(v)
    bundles.record_lines(header, sections).write.text(path)
    found = bundles.parse_records(v.spark.read.text(path))
    return found.sections["activities"].select(F.col("bundle").cast("bigint").alias("bundle"), "activity_id", "run_id", "execution_status", "rows_read")


@query("v01_evidence_problems", f"""
    SELECT bundle, 'activities' AS section, 'invalid integer: rows_read' AS reason FROM {BUNDLES} a WHERE negative
    UNION ALL SELECT bundle, 'activities', 'invalid dataset: source_dataset' FROM {BUNDLES} b WHERE elsewhere""")
def _problems(v):
    return bundles.parse_bundles(customer_bundles(v)).problems.select("bundle", "section", "reason")


@query("v01_normalised_runs", f"""
    SELECT run_id, CASE WHEN c_custkey % 3 = 0 THEN 'SUCCESS' ELSE 'UNKNOWN' END AS execution_status FROM {ACCEPTED} a""")
def _runs(v):
    return bundles.parse_bundles(customer_bundles(v)).sections["runs"].select("run_id", "execution_status")


@query("s19_record_lines", """
    SELECT CAST(customer_id % 5 AS VARCHAR) AS bundle, order_id, net_amount AS amount FROM clean_orders""")
def _record_lines(v):
    """Every order in one of five bundles: out as record lines, judged and typed again."""
    orders = v("clean_orders").withColumn("bundle", (F.col("customer_id") % 5).cast("string"))
    clock = F.lit(CAPTURED)
    header = orders.groupBy("bundle").agg(F.first(F.lit("Fabric")).alias("provider"), F.first(clock).alias("as_of")).withColumns(
        {"resource_id": F.lit("workspace"), "batch_no": F.lit(1)})
    rows = orders.select(
        "bundle", "order_id", "customer_id", F.col("net_amount").alias("amount"), clock.alias("updated_at"), F.col("order_id").alias("event_id"),
        F.lit(1).alias("batch_no"), F.lit("run-1").alias("run_id"))
    found = bundles.parse_records(bundles.record_lines(header, {"datasets.source": rows}))
    return found.sections["datasets.source"].select("bundle", "order_id", "amount")


CSV_ROWS = "(SELECT order_id, customer_id, net_amount, order_id % 97 AS file_no FROM clean_orders)"


@query("s17_evidence_csv", f"""
    SELECT file_no, COUNT(*) AS n, CAST(SUM(net_amount) AS DECIMAL(18,2)) AS total FROM {CSV_ROWS} r
    WHERE file_no NOT IN (SELECT file_no FROM {CSV_ROWS} x WHERE order_id % 991 = 0) GROUP BY file_no""")
def _csv(v):
    """CSV snapshots: a file with one malformed amount is refused whole."""
    rows = v("clean_orders").select(
        F.lit("target").alias("dataset"), "order_id", "customer_id",
        F.when(F.col("order_id") % 991 == 0, F.lit("1,5")).otherwise(F.col("net_amount").cast("string")).alias("amount"),
        F.lit("2026-01-01T07:00:00+00:00").alias("updated_at"), F.col("order_id").alias("event_id"), F.lit(1).alias("batch_no"),
        F.lit("run-1").alias("run_id"), (F.col("order_id") % 97).alias("file_no"))
    path = work_dir(v.spark, "csv")
    rows.write.partitionBy("file_no").mode("overwrite").option("header", True).csv(path)
    good = bundles.read_csv_snapshots(v.spark, f"{path}/*/*").sections["datasets.target"]
    named = good.withColumn("file_no", F.regexp_extract("bundle", "file_no=([0-9]+)", 1).cast("bigint"))
    return named.groupBy("file_no").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").cast("decimal(18,2)").alias("total"))


@query("s18_contract_evidence", """
    SELECT record_id, classification, amount FROM db_contract WHERE FLOOR(record_id * 0.04) % 7 <> 3""")
def _contract_json(v):
    """Typed contract evidence; bundles that bring their own truth are refused."""
    rows = v("db_contract").select(
        F.floor(F.col("record_id") / F.lit(25)).alias("bundle"), "record_id", "classification",
        F.col("amount").cast("string").alias("amount"))
    published = F.struct("record_id", "classification", "amount", F.lit("run-1").alias("run_id"))
    grouped = rows.groupBy("bundle").agg(F.collect_list(published).alias("db_publication"))
    empty = F.array().cast("array<struct<a:int>>")
    data = F.struct(empty.alias("db_source"), "db_publication")
    truth = F.struct(empty.alias("db_source"), "db_publication", empty.alias("db_contract"))

    def document(datasets):
        return F.to_json(F.struct(
            F.lit(1).alias("version"), F.lit(bundles.CONTRACT_KIND).alias("kind"),
            F.lit("lab_031_databricks_classification").alias("lab_id"), F.lit("standard").alias("contract_id"),
            F.lit("Databricks").alias("provider"), F.lit("workspace").alias("resource_id"),
            F.lit("2026-02-01T12:00:00Z").alias("as_of"), F.lit(1).alias("batch_no"), empty.alias("runs"), empty.alias("steps"),
            datasets.alias("datasets")), {"ignoreNullFields": "false"})

    content = F.when(F.col("bundle") % 7 == 3, document(truth)).otherwise(document(data))
    found = bundles.parse_contract_bundles(grouped.select("bundle", content.alias("content")), "lab_031_databricks_classification")
    return found.sections["datasets.db_publication"].select("record_id", "classification", "amount")


@query("s19_evidence_export", f"""
    SELECT bundle, COUNT(*) AS runs, CAST(SUM(c_custkey) AS BIGINT) AS rows_written FROM {ACCEPTED} a GROUP BY bundle""")
def _export(v):
    """What the reader makes of exported documents."""
    found = bundles.parse_bundles(customer_bundles(v))
    return found.sections["activities"].groupBy("bundle").agg(
        F.count(F.lit(1)).alias("runs"), F.sum("rows_written").alias("rows_written"))


@query("s20_import_provenance", f"""
    SELECT CAST(bundle AS VARCHAR) AS filename, CAST(to_json(list_sort(list('run-' || CAST(c_custkey AS VARCHAR)))) AS VARCHAR) AS run_ids, TRUE AS hashed
    FROM {ACCEPTED} a GROUP BY bundle""")
def _provenance(v):
    found = bundles.parse_bundles(customer_bundles(v))
    rows = bundles.provenance(found, "json", CAPTURED)
    hashed = (F.sha2("raw_content", 256) == F.col("sha256")) & (F.length("sha256") == 64)
    return rows.select(F.col("filename").cast("string").alias("filename"), F.col("run_ids").cast("string").alias("run_ids"),
                       hashed.alias("hashed"))


# API pages

@query("s21_page_records", """
    SELECT crawl_id, page, CAST(ROW_NUMBER() OVER (PARTITION BY crawl_id, page ORDER BY pos) - 1 AS INT) AS pos,
           CASE WHEN text_key THEN '"' || CAST(order_id AS STRING) || '"' ELSE CAST(order_id AS STRING) END AS record_key
    FROM api_delivered""")
def _records(v):
    return pages.page_records(api_tables(v)["api_attempts"], CRAWL).select("crawl_id", "page", "pos", "record_key")


@query("s21_request_summary", """
    SELECT p.crawl_id, CAST(SUM(1 + l.retries) AS BIGINT) AS request_count, CAST(SUM(l.retries) AS BIGINT) AS retries,
           CASE WHEN MAX(p.failed_page) <= MAX(p.last_page) THEN 'FAILED' ELSE 'SUCCESS' END AS execution_status
    FROM api_last_page p JOIN
        (SELECT DISTINCT l.crawl_id, l.page, CASE WHEN l.page = q.failed_page THEN 2 WHEN l.page % 10 = 0 THEN 1 ELSE 0 END AS retries
         FROM api_listing l JOIN api_last_page q ON l.crawl_id = q.crawl_id WHERE NOT l.lost AND l.page <= q.failed_page) l
    ON p.crawl_id = l.crawl_id GROUP BY p.crawl_id""")
def _requests(v):
    return pages.request_summary(landed_attempts(v), CRAWL)


@query("s21_final_attempts", """
    SELECT crawl_id, page, CASE WHEN page % 10 = 0 THEN 2 ELSE 1 END AS final_attempt FROM
        (SELECT DISTINCT l.crawl_id, l.page FROM api_listing l JOIN api_last_page q ON l.crawl_id = q.crawl_id
         WHERE NOT l.lost AND l.page < q.failed_page) p""")
def _final(v):
    """Which attempt is final follows from the statuses alone."""
    marked = pages.finalize_attempts(landed_attempts(v), CRAWL)
    return marked.where(F.col("final") & (F.col("status") == 200)).select(
        "crawl_id", "page", F.col("attempt").cast("int").alias("final_attempt"))


# Stream

@query("m01_stream_merge", """
    SELECT event_id, order_id, event_at, net_amount FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id
        ORDER BY event_at DESC NULLS FIRST, event_id DESC NULLS FIRST) AS rn FROM incremental_events) r WHERE rn = 1""")
def _stream(v):
    """Batches landed as files and merged as a stream, one of them delivered twice."""
    root = work_dir(v.spark, "stream")
    columns = ["event_id", "order_id", "event_at", "net_amount"]
    events = v("incremental_events")
    events.select("batch_no", *columns).write.partitionBy("batch_no").mode("overwrite").parquet(f"{root}/landed")
    events.where("batch_no = 1").select("batch_no", *columns).write.partitionBy("batch_no").mode("append").parquet(f"{root}/landed")
    schema = events.select(*columns).schema
    arriving = stream.read_events(v.spark, f"{root}/landed/*", schema, files_per_batch=8)
    keys, order = ["order_id"], ["event_at", "event_id"]
    stream.start_merge(arriving, f"{root}/target", f"{root}/checkpoint", keys, order).awaitTermination()
    return stream.merged(v.spark, f"{root}/target", schema, keys, order)


@query("m01_stream_state", """
    SELECT event_id, order_id, event_at, net_amount FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id
        ORDER BY event_at DESC NULLS FIRST, event_id DESC NULLS FIRST) AS rn FROM incremental_events) r WHERE rn = 1""")
def _stream_state(v):
    """The stream stops and starts again between the batches; the last one is late and the first one comes twice."""
    return keyed_stream(v)[0]


def keyed_stream(v: Inputs) -> tuple[DataFrame, DataFrame]:
    root = work_dir(v.spark, "keyed")
    columns = ["event_id", "order_id", "event_at", "net_amount"]
    events = v("incremental_events")
    schema = events.select(*columns).schema
    for batches in ((3,), (1, 2), (1,)):
        events.where(F.col("batch_no").isin(*batches)).select(*columns).write.mode("append").parquet(f"{root}/landed")
        arriving = stream.read_events(v.spark, f"{root}/landed", schema)
        keyed.start_keyed_merge(arriving, f"{root}/changes", f"{root}/checkpoint", ["order_id"], ["event_at", "event_id"]).awaitTermination()
    return keyed.current(v.spark, f"{root}/checkpoint", schema, ["order_id"]), keyed.batch_summary(v.spark, f"{root}/changes")


@query("m01_stream_batches", """
    WITH arrived AS (SELECT *, CASE WHEN batch_no = 3 THEN 0 ELSE 1 END AS batch_id FROM incremental_events),
    ranked AS (SELECT a.*, ROW_NUMBER() OVER (PARTITION BY order_id, batch_id ORDER BY event_at DESC NULLS FIRST, event_id DESC NULLS FIRST) AS rn
        FROM arrived a),
    best AS (SELECT * FROM ranked WHERE rn = 1),
    stored AS (SELECT b.batch_id, s.order_id, MAX(s.event_at) AS event_at FROM (SELECT DISTINCT batch_id FROM arrived) b
        JOIN best s ON s.batch_id < b.batch_id GROUP BY b.batch_id, s.order_id),
    winner AS (SELECT w.batch_id, w.order_id, w.event_at, MAX(s.event_id) AS event_id FROM stored w
        JOIN best s ON s.order_id = w.order_id AND s.event_at = w.event_at AND s.batch_id < w.batch_id GROUP BY w.batch_id, w.order_id, w.event_at),
    judged AS (SELECT a.batch_id, a.order_id, w.order_id IS NULL AS fresh,
            w.order_id IS NOT NULL AND (a.event_at < w.event_at OR (a.event_at = w.event_at AND a.event_id < w.event_id)) AS late
        FROM arrived a LEFT JOIN winner w ON a.batch_id = w.batch_id AND a.order_id = w.order_id),
    per_key AS (SELECT batch_id, order_id, COUNT(*) AS n, SUM(CAST(late AS INT)) AS late, BOOL_OR(fresh) AS fresh, BOOL_AND(late) AS kept
        FROM judged GROUP BY batch_id, order_id)
    SELECT CAST(batch_id AS BIGINT) AS batch_id, CAST(SUM(n) AS BIGINT) AS rows, CAST(SUM(late) AS BIGINT) AS late, CAST(0 AS BIGINT) AS repeated,
        COUNT(*) FILTER (WHERE fresh) AS new, COUNT(*) FILTER (WHERE NOT fresh AND NOT kept) AS replaced, COUNT(*) FILTER (WHERE kept) AS kept
    FROM per_key GROUP BY batch_id
    UNION ALL SELECT 2, COUNT(*), COUNT(*) - COUNT(*) FILTER (WHERE stored_now), COUNT(*) FILTER (WHERE stored_now), 0, 0, COUNT(DISTINCT order_id)
    FROM (SELECT e.order_id, r.event_id IS NOT NULL AS stored_now FROM incremental_events e LEFT JOIN
        (SELECT event_id FROM (SELECT event_id, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY event_at DESC NULLS FIRST, event_id DESC NULLS FIRST) AS rn
         FROM incremental_events) x WHERE rn = 1) r ON e.event_id = r.event_id WHERE e.batch_no = 1) again""")
def _stream_batches(v):
    """What each batch did: late rows lose, and the repeated batch changes nothing."""
    return keyed_stream(v)[1]


# Rules

RULE_DATASETS = catalog(
    Dataset("source", "source.orders", run_scoped=False),
    Dataset("target", "target.orders", run_scoped=False),
    Dataset("daily", "target.daily", run_scoped=False, counted_by="order_count"),
)


def rule_source(v: Inputs) -> FrameSource:
    return FrameSource(
        {"source": v("clean_orders"), "target": v("target_orders"), "daily": v("target_daily_sales")},
        {"SOURCE": v("source_orders").agg(F.count(F.lit(1)))},
    )


def _extract(frame: DataFrame, **paths: str) -> DataFrame:
    return frame.select("rule_id", "status", *[F.get_json_object("actual", p).cast("bigint").alias(n) for n, p in paths.items()])


COUNT_RULES = (record_count("count_target", "target"), record_count("count_daily", "daily"))


@query("q01_record_count", """
    SELECT 'count_target' AS rule_id, CASE WHEN COUNT(*) = (SELECT COUNT(*) FROM orders) THEN 'PASS' ELSE 'FAIL' END AS status,
           COUNT(*) AS n FROM target_orders
    UNION ALL SELECT 'count_daily', CASE WHEN SUM(order_count) = (SELECT COUNT(*) FROM orders) THEN 'PASS' ELSE 'FAIL' END,
           CAST(SUM(order_count) AS BIGINT) FROM target_daily_sales""")
def _q1(v):
    results = execute_rules(COUNT_RULES, rule_source(v), RULE_DATASETS)
    return _extract(results_frame(v.spark, results), n="$.count")


@query("q02_uniqueness", """
    SELECT 'unique' AS rule_id, 'FAIL' AS status, COUNT(*) AS duplicate_groups, CAST(SUM(c - 1) AS BIGINT) AS duplicate_rows
    FROM (SELECT COUNT(*) AS c FROM target_orders GROUP BY order_id HAVING COUNT(*) > 1) d""")
def _q2(v):
    results = execute_rules([unique("unique", "target", columns=("order_id",))], rule_source(v), RULE_DATASETS)
    return _extract(results_frame(v.spark, results), duplicate_groups="$.duplicate_groups", duplicate_rows="$.duplicate_rows")


@query("q03_not_null", """
    SELECT 'required' AS rule_id, 'FAIL' AS status, COUNT(*) - COUNT(customer_id) AS customer_id, COUNT(*) - COUNT(net_amount) AS net_amount
    FROM target_orders""")
def _q3(v):
    results = execute_rules([not_null("required", "target", columns=("customer_id", "net_amount"))], rule_source(v), RULE_DATASETS)
    return _extract(results_frame(v.spark, results), customer_id="$.null_counts.customer_id", net_amount="$.null_counts.net_amount")


# The columns of a given table as DuckDB tells them, in the names that rules use.
STORED = """(SELECT column_name, CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'integer' WHEN 'DOUBLE' THEN 'double'
    WHEN 'VARCHAR' THEN 'text' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE column_type END AS kind FROM (DESCRIBE SELECT * FROM {0}))"""
WANTED = {
    "right": (("p_partkey", "bigint"), ("p_name", "text"), ("p_brand", "text"), ("p_type", "text"), ("p_size", "integer"), ("p_retailprice", "double")),
    "wrong": (("p_partkey", "bigint"), ("p_name", "bigint"), ("p_brand", "text"), ("p_colour", "text"), ("p_size", "text")),
}


def _wanted_sql(rule_id: str) -> str:
    values = ", ".join(f"('{name}', '{kind}')" for name, kind in WANTED[rule_id])
    return f"""SELECT '{rule_id}' AS rule_id, COALESCE(w.column_name, s.column_name) AS column_name,
        CASE WHEN s.column_name IS NULL THEN 'absent' WHEN w.column_name IS NULL THEN 'extra' ELSE 'different' END AS reason,
        w.kind AS expected, s.kind AS actual
        FROM (VALUES {values}) w(column_name, kind) FULL JOIN {STORED.format('part')} s ON w.column_name = s.column_name
        WHERE w.kind IS DISTINCT FROM s.kind"""


@query("q04_schema", f"""
    SELECT r.rule_id, CASE WHEN d.column_name IS NULL THEN 'PASS' ELSE 'FAIL' END AS status, d.column_name, d.reason, d.expected, d.actual
    FROM (VALUES ('right'), ('wrong')) r(rule_id) LEFT JOIN ({" UNION ALL ".join(_wanted_sql(r) for r in WANTED)}) d ON r.rule_id = d.rule_id""")
def _q4(v):
    """Columns that are absent, extra or of another type, one row of evidence each."""
    source = FrameSource({"parts": v("part")})
    rules = [schema_of(name, "parts", columns=[(c, kind, True) for c, kind in columns]) for name, columns in WANTED.items()]
    frame = results_frame(v.spark, execute_rules(rules, source, catalog(Dataset("parts", "part", run_scoped=False))))
    rows = frame.select("rule_id", "status", F.explode_outer("evidence").alias("e"))

    def at(path: str):
        return F.get_json_object("e", path)

    return rows.select(
        "rule_id", "status", at("$.column").alias("column_name"), at("$.reason").alias("reason"), at("$.expected[0]").alias("expected"),
        at("$.actual[0]").alias("actual"))


@query("q07_suite_problems", """
    WITH rules AS (SELECT *, kind IN ('KEY_RECONCILIATION', 'FIELD_RECONCILIATION') AS paired FROM declared_rules),
    named AS (SELECT suite_id, place, COUNT(*) AS n FROM declared_datasets GROUP BY suite_id, place),
    listed AS (SELECT suite_id, place, COUNT(*) AS n, COUNT(DISTINCT column_name) AS different,
        BOOL_AND(regexp_matches(column_name, '^[a-z_][a-z0-9_]*$')) AS plain FROM declared_columns GROUP BY suite_id, place)
    SELECT DISTINCT suite_id, CAST(NULL AS BIGINT) AS place, 'suite id is not a plain name' AS problem FROM rules
        WHERE NOT regexp_matches(suite_id, '^[a-z_][a-z0-9_]*$')
    UNION ALL SELECT suite_id, place, 'blank rule id' FROM rules WHERE TRIM(rule_id) = ''
    UNION ALL SELECT suite_id, place, 'evidence is not between 1 and 100' FROM rules WHERE paired AND (evidence < 1 OR evidence > 100)
    UNION ALL SELECT suite_id, place, 'rule id used again' FROM rules r WHERE TRIM(rule_id) <> '' AND EXISTS
        (SELECT 1 FROM rules e WHERE e.suite_id = r.suite_id AND e.rule_id = r.rule_id AND e.place < r.place)
    UNION ALL SELECT suite_id, place, 'no such dataset: ' || dataset_id FROM declared_datasets
        WHERE dataset_id NOT IN (SELECT dataset_id FROM declared_catalog)
    UNION ALL SELECT r.suite_id, r.place, 'wrong number of datasets' FROM rules r LEFT JOIN named n ON r.suite_id = n.suite_id AND r.place = n.place
        WHERE COALESCE(n.n, 0) <> CASE WHEN paired THEN 2 ELSE 1 END
    UNION ALL SELECT r.suite_id, r.place, 'no columns' FROM rules r WHERE kind <> 'RECORD_COUNT' AND NOT EXISTS
        (SELECT 1 FROM listed l WHERE l.suite_id = r.suite_id AND l.place = r.place)
    UNION ALL SELECT r.suite_id, r.place, 'column used again' FROM rules r JOIN listed l ON r.suite_id = l.suite_id AND r.place = l.place
        WHERE kind <> 'RECORD_COUNT' AND l.different < l.n
    UNION ALL SELECT r.suite_id, r.place, 'column is not a plain name' FROM rules r JOIN listed l ON r.suite_id = l.suite_id AND r.place = l.place
        WHERE kind <> 'RECORD_COUNT' AND NOT l.plain""")
def _q7(v):
    return suites.suite_problems(v("declared_rules"), v("declared_datasets"), v("declared_columns"), v("declared_catalog"))


@query("q07_catalog_problems", """
    SELECT dataset_id, 'dataset id used again' AS problem FROM declared_catalog GROUP BY dataset_id HAVING COUNT(*) > 1
    UNION ALL SELECT DISTINCT dataset_id, 'dataset id is not a plain name' FROM declared_catalog WHERE NOT regexp_matches(dataset_id, '^[a-z_][a-z0-9_]*$')""")
def _q7_catalog(v):
    return suites.catalog_problems(v("declared_catalog"))


@query("q05_key_reconciliation", """
    SELECT 'keys' AS rule_id, 'FAIL' AS status,
           (SELECT COUNT(*) FROM (SELECT order_id FROM clean_orders EXCEPT SELECT order_id FROM target_orders) m) AS missing_count,
           (SELECT COUNT(*) FROM (SELECT order_id FROM target_orders EXCEPT SELECT order_id FROM clean_orders) u) AS unexpected_count,
           20 AS evidence_rows""")
def _q5(v):
    rule = same_keys("keys", "source", "target", key=("order_id",))
    frame = results_frame(v.spark, execute_rules([rule], rule_source(v), RULE_DATASETS))
    return _extract(frame, missing_count="$.missing_count", unexpected_count="$.unexpected_count").join(
        frame.select("rule_id", F.size("evidence").alias("evidence_rows")), "rule_id")


FIELD_RULE = same_fields(
    "fields", "source", "target", key=("order_id",), fields=[("customer_id", "customer_id"), ("net_amount", "net_amount")], evidence=100)


@query("q06_field_reconciliation", """
    SELECT 'fields' AS rule_id, 'FAIL' AS status,
           (SELECT COUNT(*) FROM clean_orders s JOIN target_orders t ON s.order_id = t.order_id
            WHERE s.customer_id IS DISTINCT FROM t.customer_id)
         + (SELECT COUNT(*) FROM clean_orders s JOIN target_orders t ON s.order_id = t.order_id
            WHERE s.net_amount IS DISTINCT FROM t.net_amount) AS mismatch_count""")
def _q6(v):
    return _extract(results_frame(v.spark, execute_rules([FIELD_RULE], rule_source(v), RULE_DATASETS)), mismatch_count="$.mismatch_count")


@query("q06_field_evidence", """
    SELECT field, order_id, expected, actual FROM (
        SELECT 1 AS turn, 'customer_id' AS field, s.order_id, CAST(s.customer_id AS VARCHAR) AS expected,
               CAST(t.customer_id AS VARCHAR) AS actual
        FROM clean_orders s JOIN target_orders t ON s.order_id = t.order_id WHERE s.customer_id IS DISTINCT FROM t.customer_id
        UNION ALL SELECT 2, 'net_amount', s.order_id, CAST(s.net_amount AS VARCHAR), CAST(t.net_amount AS VARCHAR)
        FROM clean_orders s JOIN target_orders t ON s.order_id = t.order_id WHERE s.net_amount IS DISTINCT FROM t.net_amount) cells
    ORDER BY turn, order_id, actual NULLS FIRST LIMIT 100""")
def _q6_evidence(v):
    frame = results_frame(v.spark, execute_rules([FIELD_RULE], rule_source(v), RULE_DATASETS))
    rows = frame.select(F.explode("evidence").alias("e"))

    def at(path):
        return F.get_json_object("e", path)

    return rows.select(
        at("$.source_column").alias("field"), at("$.key.order_id").cast("bigint").alias("order_id"),
        at("$.expected").alias("expected"), at("$.actual").alias("actual"))


@query("q08_suite_with_errors", """
    SELECT 'count_daily' AS rule_id, CASE WHEN SUM(order_count) = (SELECT COUNT(*) FROM orders) THEN 'PASS' ELSE 'FAIL' END AS status,
           'ERROR' AS suite_status FROM target_daily_sales
    UNION ALL SELECT 'unknown_column', 'ERROR', 'ERROR' UNION ALL SELECT 'required_key', 'PASS', 'ERROR'
    UNION ALL SELECT 'unknown_stage', 'ERROR', 'ERROR'""")
def _q8(v):
    """A rule that cannot be evaluated is an ERROR of its own; the others still report."""
    rules = [
        record_count("count_daily", "daily"), not_null("unknown_column", "target", columns=("no_such_column",)),
        not_null("required_key", "target", columns=("order_id",)), record_count("unknown_stage", "target", stage="NO_STAGE"),
    ]
    results = execute_rules(rules, rule_source(v), RULE_DATASETS)
    folded = worst(r.status for r in results)
    return results_frame(v.spark, results).select("rule_id", "status").withColumn("suite_status", F.lit(str(folded)))


@query("q09_status_fold", """
    SELECT event_type, CASE WHEN COUNT(*) FILTER (WHERE value < 0.05) > 0 THEN 'ERROR' WHEN COUNT(*) FILTER (WHERE value > 150) > 0 THEN 'FAIL'
           ELSE 'PASS' END AS status FROM events GROUP BY event_type""")
def _q9(v):
    """The gravest status of each group, as the greatest place in the order of statuses."""
    status = F.when(F.col("value") < 0.05, F.lit("ERROR")).when(F.col("value") > 150, F.lit("FAIL")).otherwise(F.lit("PASS"))
    order = F.array(*[F.lit(s) for s in STATUSES])
    gravest = v("events").groupBy("event_type").agg(F.max(F.array_position(order, status)).alias("place"))
    return gravest.select("event_type", F.element_at(order, F.col("place").cast("int")).alias("status"))


@query("q11_run_invariants", """
    SELECT activity_id, problem FROM (
        SELECT activity_id, rows_read, started_at, ended_at, 'negative_rows' AS problem FROM timed_activities WHERE rows_read < 0
        UNION ALL SELECT activity_id, rows_read, started_at, ended_at, 'end_without_start' FROM timed_activities
            WHERE ended_at IS NOT NULL AND started_at IS NULL
        UNION ALL SELECT activity_id, rows_read, started_at, ended_at, 'end_before_start' FROM timed_activities WHERE ended_at < started_at) p""")
def _q11(v):
    """Every activity with the times of its run, some of them impossible."""
    timed = v("timed_activities")
    return timed.select("activity_id", F.explode(run_problems("started_at", "ended_at", "rows_read")).alias("problem"))


# Faults and certification

@query("f11_local_days", """
    SELECT CAST(ordered_at + INTERVAL '7' HOUR AS DATE) AS order_date, COUNT(*) AS order_count,
           CAST(SUM(net_amount) AS DECIMAL(18,2)) AS net_revenue FROM source_time_orders GROUP BY 1""")
def _local(v):
    return inject({"source_time_orders": v("source_time_orders"), "target_utc_daily": v("clean_utc_daily")}, "utc_local_day")["target_utc_daily"]


@query("f12_load_policies", """
    SELECT 'inc_append' AS policy, COUNT(*) FILTER (WHERE batch_no <> 2) + 2 * COUNT(*) FILTER (WHERE batch_no = 2) AS target_rows
        FROM incremental_events
    UNION ALL SELECT 'inc_stale', COUNT(DISTINCT order_id) FROM incremental_events
    UNION ALL SELECT 'inc_missing', COUNT(DISTINCT order_id) FROM incremental_events
        WHERE event_id <> (SELECT MIN(event_id) FROM incremental_events WHERE batch_no = 3)""")
def _policies(v):
    parts = [
        loads.run_batches(v("incremental_events"), (1, 2, 2, 3), p).agg(F.lit(p).alias("policy"), F.count(F.lit(1)).alias("target_rows"))
        for p in ("inc_append", "inc_stale", "inc_missing")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("f16_page_faults", """
    SELECT 'api_missing_page' AS scenario, COUNT(*) - 1 AS records, COUNT(DISTINCT order_id) - 1 AS ids FROM api_expected
    UNION ALL SELECT 'api_duplicate_page', COUNT(*) + 1, COUNT(DISTINCT order_id) FROM api_expected
    UNION ALL SELECT 'api_exhausted', 0, 0""")
def _page_faults(v):
    """Edits of landed pages; a crawl that never succeeds delivers nothing."""
    listing = v("api_listing").select(
        "order_id", "customer_id", "net_amount", (F.floor(F.col("order_id") * F.lit(0.2).cast("decimal(2,1)")) + 1).alias("page"), "pos")
    parts = []
    for name in ("api_missing_page", "api_duplicate_page", "api_exhausted"):
        found = pages.page_records(inject({"api_listing": listing}, name)["api_attempts"])
        per_id = found.groupBy("record_key").agg(F.count(F.lit(1)).alias("c"))
        parts.append(per_id.agg(
            F.lit(name).alias("scenario"), F.coalesce(F.sum("c"), F.lit(0)).alias("records"), F.count(F.lit(1)).alias("ids")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("f19_fault_lifecycle", """
    SELECT 'null_net_amount' AS scenario_id, 'RESET' AS status, 'SET_NULL' AS action, MIN(order_id) AS order_id, TRUE AS failed_as_expected,
           COUNT(*) AS published_rows FROM clean_orders""")
def _lifecycle(v):
    """Damage a copy, check it, reset it; the published report keeps every row."""
    store, run_id = staged(v, "TARGET")
    applied = fault_runs.apply_fault(store, "null_net_amount", run_id)
    quality = fault_runs.check_fault(store, applied["fault_run_id"])
    failing = {r.rule.id for r in quality.results if r.status == "FAIL"}
    expected = failing >= set(EXPECTED_FAILURES["null_net_amount"])
    fault_runs.reset_fault(store, applied["fault_run_id"])
    fault = fault_runs.reset_fault(store, applied["fault_run_id"])
    row = v.spark.createDataFrame(
        [(fault["scenario_id"], fault["status"], fault["mutation_evidence"], expected)],
        "scenario_id string, status string, evidence string, failed_as_expected boolean")
    return row.select(
        "scenario_id", "status", F.get_json_object("evidence", "$.action").alias("action"),
        F.get_json_object("evidence", "$.key.order_id").cast("bigint").alias("order_id"), "failed_as_expected",
        store.read_run("target.orders_report", run_id).agg(F.count(F.lit(1))).scalar().alias("published_rows"))


CHECK_TEXT = "SELECT COUNT(*) AS violation_count FROM target_orders WHERE net_amount IS NULL"


@query("g02_result_contract", "SELECT COUNT(*) FILTER (WHERE net_amount IS NULL) AS violation_count FROM target_orders")
def _result(v):
    count = certify.violation_count(certify.sql_check(CHECK_TEXT, {"target_orders": v("target_orders")}))
    return v.spark.createDataFrame([(count,)], "violation_count bigint")


@query("g04_ad_hoc_check", """
    SELECT CAST(customer_id AS VARCHAR) AS customer_id, CAST(COUNT(*) AS VARCHAR) AS n FROM target_orders GROUP BY target_orders.customer_id
    ORDER BY COUNT(*) DESC, target_orders.customer_id LIMIT 100""")
def _ad_hoc(v):
    shown = certify.run_check_text(
        "SELECT customer_id, COUNT(*) AS n FROM target_orders GROUP BY customer_id ORDER BY n DESC, customer_id;",
        {"target_orders": v("target_orders")})
    return v.spark.createDataFrame(list(shown.rows), "customer_id string, n string")


# Verdicts

GAP_TABLES = ("cloud_context", "cloud_runs", "cloud_activities", "cloud_source", "cloud_target", "cloud_schema", "cloud_manifest",
              "cloud_references", "cloud_steps")


def _gap_oracle(check: str, *more: str) -> str:
    flags = [("runs_unknown", """SELECT COUNT(*) = 0 OR bool_or(execution_status = 'UNKNOWN' OR started_at IS NULL OR ended_at IS NULL)
        FROM cloud_runs"""), *[(n, GAP_SQL[n]) for n in more]]
    parts = " UNION ALL ".join(f"SELECT '{n}' AS gap, ({sql}) AS found" for n, sql in flags)
    return f"SELECT '{check}' AS check_id, gap FROM ({parts}) g WHERE found"


GAP_SQL = {
    "activity_unknown": """SELECT COUNT(*) = 0 OR bool_or(execution_status = 'UNKNOWN' OR rows_read IS NULL OR rows_written IS NULL)
        FROM cloud_activities""",
    "manifest_incomplete": "SELECT COUNT(*) = 0 OR bool_or(row_count IS NULL OR snapshot_at IS NULL) FROM cloud_manifest",
    "reference_undated": "SELECT COUNT(*) = 0 OR bool_or(observed_at IS NULL) FROM cloud_references",
    "checkpoint_missing": "SELECT COUNT(*) = 0 FROM cloud_steps",
}


def gap_query(check: str, name: str, *more: str):
    @query(name, _gap_oracle(check, *more))
    def run(v: Inputs) -> DataFrame:
        found = verdicts.evidence_gaps(v.tables(*GAP_TABLES), check)
        return found.select(F.lit(check).alias("check_id"), F.explode("evidence_gaps").alias("gap"))


gap_query("C26", "e01_copy_evidence_gaps", "activity_unknown")
gap_query("C28", "e01_recovery_evidence_gaps", "activity_unknown", "checkpoint_missing")
gap_query("C29", "e01_manifest_evidence_gaps", "manifest_incomplete")
gap_query("C30", "e01_reference_evidence_gaps", "reference_undated")


@query("e02_contract_evidence_gaps", """
    SELECT gap FROM (
        SELECT 'runs_unknown' AS gap,
               (SELECT bool_or(execution_status = 'UNKNOWN' OR started_at IS NULL OR ended_at IS NULL) FROM cloud_runs) AS found
        UNION ALL SELECT 'run_reference_missing', EXISTS (SELECT 1 FROM az_files f WHERE f.run_id NOT IN (SELECT run_id FROM cloud_runs))
               OR EXISTS (SELECT 1 FROM cloud_steps s WHERE s.run_id NOT IN (SELECT run_id FROM cloud_runs))
        UNION ALL SELECT 'capture_beyond_clock',
               (SELECT bool_or(observed_at IS NULL OR observed_at > (SELECT as_of FROM cloud_context)) FROM az_files)) g
    WHERE found""")
def _contract_gaps(v):
    tables = v.tables("cloud_context", "cloud_runs", "cloud_steps", "az_files")
    return verdicts.contract_gaps(tables, "C35", ["az_files"]).select(F.explode("evidence_gaps").alias("gap"))


@query("e02_unreferenced_runs", """
    SELECT DISTINCT run_id FROM cloud_target WHERE run_id NOT IN (SELECT run_id FROM cloud_runs)""")
def _unreferenced(v):
    tables = v.tables("cloud_target", "cloud_runs", "cloud_steps")
    return verdicts.unreferenced_runs(tables, ["cloud_target"])


@query("e03_access_state", """
    SELECT CASE WHEN bool_or(outcome = 'DENIED') THEN 'ACCESS_ERROR' ELSE 'INCOMPLETE' END AS access_status FROM az_access""")
def _access(v):
    return verdicts.access_state(v.tables("cloud_context", "az_required_access", "az_access"))


VERDICT = """CASE WHEN c_custkey % 19 = 0 THEN 'ERROR' WHEN c_custkey % 5 = 0 THEN 'NOT_VERIFIED' WHEN c_custkey % 7 = 0 THEN 'NOT_RUN'
    WHEN c_custkey % 3 = 0 THEN 'PASS' ELSE 'FAIL' END"""


def judged_customers(v: Inputs) -> DataFrame:
    key = F.col("c_custkey")
    evidence_status = F.when(key % 5 == 0, F.lit("NOT_VERIFIED")).otherwise(F.lit("AVAILABLE"))
    count = F.when(key % 7 == 0, F.lit(None).cast("bigint")).otherwise(key % 3)
    return v("customer").select("c_custkey", verdicts.combined_verdict(evidence_status, count, key % 19 == 0).alias("verdict"))


@query("e04_combined_verdict", f"SELECT c_custkey, {VERDICT} AS verdict FROM customer")
def _verdict(v):
    return judged_customers(v)


@query("e05_stale_verdicts", f"SELECT c_custkey AS subject, CASE WHEN c_custkey % 4 = 0 THEN 'NOT_RUN' ELSE {VERDICT} END AS status FROM customer")
def _stale(v):
    made = judged_customers(v).select(F.col("c_custkey").alias("subject"), (F.col("c_custkey") % 4).alias("revision"), F.col("verdict").alias("status"))
    current = v("customer").select(
        F.col("c_custkey").alias("subject"), F.greatest(F.col("c_custkey") % 4, F.lit(1)).alias("current_revision"))
    return verdicts.valid_verdicts(made, current).select("subject", "status")
