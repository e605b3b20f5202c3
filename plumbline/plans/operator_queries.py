"""Projections, joins, aggregates, windows, set operations and merges over the given tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from plumbline import schemas
from plumbline.functions import exprs
from plumbline.operators import previews, reconcile, rollups, scope, versions
from plumbline.operators.checks import evidence, history
from plumbline.operators.faults import first_keys, hit_by
from plumbline.plans import loads
from plumbline.plans.check_queries import DAILY, OVERLAPS, PER_DATASET
from plumbline.plans.registry import query, sql_diff
from plumbline.session import work_dir
from plumbline.sources.commits import StepLog
from plumbline.sources.store import Store

# Projections and predicates


@query("p01_net_amount", "SELECT order_id, CAST(gross_amount - discount_amount - refund_amount AS DECIMAL(14,2)) AS net_amount FROM source_orders")
def _net(v):
    return v("source_orders").select("order_id", exprs.net_amount().alias("net_amount"))


@query("p02_null_safe_inequality", """
    SELECT s.order_id, t.net_amount FROM clean_orders s JOIN target_orders t ON s.order_id = t.order_id
    WHERE s.net_amount IS DISTINCT FROM t.net_amount""")
def _distinct(v):
    s, t = v("clean_orders").alias("s"), v("target_orders").alias("t")
    joined = s.join(t, F.col("s.order_id") == F.col("t.order_id"))
    return joined.where(exprs.distinct_from("s.net_amount", "t.net_amount")).select("s.order_id", "t.net_amount")


@query("p03_row_difference", """
    SELECT e.order_date AS expected_date, a.order_date AS actual_date FROM gold_daily_sales e
    FULL OUTER JOIN target_daily_sales a ON e.order_date = a.order_date
    WHERE e.order_date IS NULL OR a.order_date IS NULL OR e.order_count IS DISTINCT FROM a.order_count
          OR e.net_revenue IS DISTINCT FROM a.net_revenue""")
def _row_difference(v):
    """Differing days with both keys; a day is one row per side, so the join stays small."""
    e, a = v("gold_daily_sales").alias("e"), v("target_daily_sales").alias("a")
    joined = e.join(a, F.col("e.order_date") == F.col("a.order_date"), "full")
    differs = exprs.row_differs("e", "a", "order_date", ["order_count", "net_revenue"])
    return joined.where(differs).select(F.col("e.order_date").alias("expected_date"), F.col("a.order_date").alias("actual_date"))


@query("p04_business_rule_filter", "SELECT order_id, customer_id FROM target_orders WHERE customer_id <= 0")
def _business(v):
    return v("target_orders").where(F.col("customer_id") <= 0).select("order_id", "customer_id")


@query("p05_null_filter", "SELECT order_id FROM target_orders WHERE net_amount IS NULL")
def _nulls(v):
    return v("target_orders").where(F.col("net_amount").isNull()).select("order_id")


@query("p06_amount_format", """
    SELECT order_id, regexp_matches(gross_text, '^[0-9]+([.][0-9]{1,2})?$')
           AND regexp_matches(discount_text, '^[0-9]+([.][0-9]{1,2})?$') AS well_formed FROM etl_source""")
def _format(v):
    return v("etl_source").select("order_id", exprs.amounts_ok().alias("well_formed"))


@query("p07_classification", "SELECT record_id, classification, amount FROM db_contract")
def _classes(v):
    return loads.publish_classification(v("db_source")).select("record_id", "classification", "amount")


STATUS_WORDS = """CASE o_orderstatus WHEN 'F' THEN 'Failed' WHEN 'O' THEN 'InProgress' WHEN 'P' THEN 'Succeeded' ELSE o_orderstatus END"""


@query("p08_status_normalisation", f"""
    SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'UNKNOWN' WHEN o_orderkey % 7 = 0 THEN 'CANCELLED'
        WHEN {STATUS_WORDS} = 'Failed' THEN 'FAILED' WHEN {STATUS_WORDS} = 'InProgress' THEN 'RUNNING'
        WHEN {STATUS_WORDS} = 'Succeeded' THEN 'SUCCESS' ELSE 'UNKNOWN' END AS state FROM orders""")
def _states(v):
    word = F.expr(STATUS_WORDS)
    given = F.when(F.col("o_orderkey") % 11 == 0, F.lit("Paused")).when(F.col("o_orderkey") % 7 == 0, F.lit("Cancelled")).otherwise(word)
    return v("orders").select("o_orderkey", exprs.normalized_state(given).alias("state"))


@query("p09_visibility_filter", """
    SELECT event_id FROM cloud_source WHERE batch_no <= (SELECT batch_no FROM cloud_context)
    AND updated_at <= (SELECT as_of FROM cloud_context)""")
def _visible(v):
    context = v("cloud_context").select(F.col("batch_no").alias("upto"), "as_of")
    rows = scope.attach(v("cloud_source"), context)
    return rows.where((F.col("batch_no") <= F.col("upto")) & (F.col("updated_at") <= F.col("as_of"))).select("event_id")


@query("p10_existence_flag", """
    SELECT c_mktsegment, CASE WHEN SUM(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END) > 0 THEN 0 ELSE 1 END AS no_debt,
           COALESCE(MAX(c_acctbal) > 9000, FALSE) AS any_rich FROM customer GROUP BY c_mktsegment""")
def _existence(v):
    return v("customer").groupBy("c_mktsegment").agg(
        F.when(F.bool_or(F.col("c_acctbal") < 0), F.lit(0)).otherwise(F.lit(1)).alias("no_debt"),
        F.coalesce(F.bool_or(F.col("c_acctbal") > 9000), F.lit(False)).alias("any_rich"),
    )


@query("p11_column_profile", """
    SELECT 'o_orderkey' AS column_name, 'bigint' AS data_type, COUNT(*) - COUNT(o_orderkey) AS null_rows FROM orders
    UNION ALL SELECT 'o_custkey', 'bigint', COUNT(*) - COUNT(o_custkey) FROM orders
    UNION ALL SELECT 'o_orderstatus', 'text', COUNT(*) - COUNT(o_orderstatus) FROM orders
    UNION ALL SELECT 'o_totalprice', 'double', COUNT(*) - COUNT(o_totalprice) FROM orders
    UNION ALL SELECT 'o_orderdate', 'timestamp_ntz', COUNT(*) - COUNT(o_orderdate) FROM orders
    UNION ALL SELECT 'o_orderpriority', 'text', COUNT(*) - COUNT(o_orderpriority) FROM orders""")
def _columns(v):
    orders = v("orders")
    counts = orders.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in orders.columns])
    listed = F.array(*[
        F.struct(F.lit(f.name).alias("column_name"), F.lit(schemas.type_name(f.dataType)).alias("data_type"),
                 F.col(f.name).alias("null_rows")) for f in orders.schema
    ])
    return counts.select(F.explode(listed).alias("c")).select("c.*")


@query("p12_json_types", """
    SELECT event_id, json_type(props, '$.k') IN ('UBIGINT', 'BIGINT') AS is_integer, json_type(props, '$.k') = 'VARCHAR' AS is_string,
           json_type(props, '$.missing') IS NOT NULL AS has_missing FROM events""")
def _json(v):
    doc = F.col("doc")
    return v("events").select("event_id", F.try_parse_json("props").alias("doc")).select(
        "event_id", exprs.json_type_ok(doc, "k", "integer").alias("is_integer"),
        exprs.json_type_ok(doc, "k", "string").alias("is_string"), exprs.json_has_value(doc, "missing").alias("has_missing"),
    )


@query("p13_bounded_cells", """
    SELECT LEFT(CAST(o_orderkey AS VARCHAR), 5) AS o_orderkey, LEFT(o_orderpriority, 5) AS o_orderpriority
    FROM orders ORDER BY orders.o_orderkey LIMIT 51""")
def _cells(v):
    ordered = v("orders").select("o_orderkey", "o_orderpriority").orderBy("o_orderkey")
    return previews.preview_frame(ordered, rows=50, chars=4)


# Joins


@query("j01_inner_reconcile", """
    SELECT s.order_id, COUNT(*) AS differing FROM clean_orders s JOIN target_orders t ON s.order_id = t.order_id
    WHERE s.net_amount IS DISTINCT FROM t.net_amount OR s.customer_id IS DISTINCT FROM t.customer_id GROUP BY s.order_id""")
def _inner(v):
    per_key = reconcile.key_counts(v("clean_orders"), v("target_orders"), ["order_id"], ["net_amount", "customer_id"])
    return per_key.select("order_id", reconcile.differing_pairs(["order_id"]).alias("differing")).where("differing > 0")


@query("j02_inner_lookup", """
    SELECT c.customer_id, COUNT(*) AS orders FROM etl_source s JOIN etl_customers c ON s.customer_code = c.customer_code
    GROUP BY c.customer_id""")
def _lookup(v):
    mapped = v("etl_source").join(v("etl_customers"), "customer_code")
    return mapped.groupBy("customer_id").agg(F.count(F.lit(1)).alias("orders"))


@query("j03_rollup_join", """
    SELECT f.sale_date, d.region, COUNT(*) AS sale_count, CAST(SUM(f.amount) AS DECIMAL(14,2)) AS total
    FROM sy_expected_fact f JOIN sy_fanout_dimension d ON f.customer_key = d.customer_key GROUP BY f.sale_date, d.region""")
def _rollup_join(v):
    return rollups.region_report(v("sy_expected_fact"), v("sy_fanout_dimension"))


@query("j04_full_outer_diff", """
    SELECT COALESCE(e.order_id, a.order_id) AS order_id,
           COUNT(*) FILTER (WHERE e.order_id IS NULL OR a.order_id IS NULL) AS unmatched,
           COUNT(*) FILTER (WHERE e.order_id IS NOT NULL AND a.order_id IS NOT NULL) AS differing
    FROM clean_orders e FULL OUTER JOIN target_orders a ON e.order_id = a.order_id
    WHERE e.order_id IS NULL OR a.order_id IS NULL OR e.net_amount IS DISTINCT FROM a.net_amount
          OR e.customer_id IS DISTINCT FROM a.customer_id
    GROUP BY COALESCE(e.order_id, a.order_id)""")
def _full(v):
    per_key = reconcile.diff_by_key(v("clean_orders"), v("target_orders"), ["order_id"], ["net_amount", "customer_id"])
    return per_key.where("unmatched + differing > 0")


@query("j05_full_outer_two_keys", f"SELECT {sql_diff('sy_expected_report', 'sy_report', ['sale_date', 'region'], ['sale_count', 'total'])} AS n")
def _two_keys(v):
    return reconcile.diff_count(v("sy_expected_report"), v("sy_report"), ["sale_date", "region"], ["sale_count", "total"])


@query("j06_diff_against_aggregate", f"SELECT {sql_diff('line_totals', 'target_order_totals', ['order_id'], ['net_amount'])} AS n")
def _aggregate_diff(v):
    grouped = rollups.sum_by(v("order_lines"), ["order_id"], "net_amount")
    return reconcile.diff_count(grouped, v("target_order_totals"), ["order_id"], ["net_amount"])


@query("j07_left_outer_requirements", PER_DATASET)
def _left(v):
    return history.freshness_counts(v("freshness_requirements"), v("freshness_observations"))


@query("j08_self_join_dependencies", """
    SELECT COUNT(*) AS n FROM cloud_activities a LEFT JOIN cloud_activities d ON a.dependency_id = d.activity_id AND a.run_id = d.run_id
    WHERE a.dependency_id IS NOT NULL AND (d.activity_id IS NULL OR d.execution_status IS DISTINCT FROM 'SUCCESS')""")
def _self_join(v):
    activities = v("cloud_activities")
    return reconcile.weighted_left_violations(
        activities.where(F.col("dependency_id").isNotNull()), activities, ["dependency_id", "run_id"], ["activity_id", "run_id"],
        F.lit(False), exprs.distinct_from("execution_status", F.lit("SUCCESS")),
    )


@query("j09_one_row_context", """
    SELECT batch_no, COUNT(*) AS visible FROM incremental_events WHERE arrived_at <= (SELECT as_of FROM lab_context) GROUP BY batch_no""")
def _context(v):
    rows = scope.attach(v("incremental_events"), v("lab_context").select("as_of")).where(F.col("arrived_at") <= F.col("as_of"))
    return rows.groupBy("batch_no").agg(F.count(F.lit(1)).alias("visible"))


@query("j10_interval_overlap_pairs", f"SELECT {OVERLAPS} AS overlap_pairs")
def _overlap(v):
    return versions.overlap_pairs(v.stored("target_customer_history"), name="overlap_pairs")


@query("j11_left_anti_guard", """
    SELECT i.order_id, i.version FROM db_incoming i WHERE NOT EXISTS (SELECT 1 FROM db_before b WHERE b.order_id = i.order_id)""")
def _anti(v):
    return v("db_incoming").join(v("db_before").select("order_id"), "order_id", "left_anti").select("order_id", "version")


@query("j12_left_semi_targeting", """
    SELECT order_id, net_amount, order_id IN (SELECT order_id FROM target_orders ORDER BY order_id NULLS LAST LIMIT 2) AS hit FROM target_orders""")
def _semi(v):
    target = v("target_orders")
    return hit_by(target, first_keys(target, "order_id", 2), "order_id").select("order_id", "net_amount", F.col("_hit").alias("hit"))


@query("j13_guarded_update", "SELECT order_id, version, amount, updated_at FROM db_expected_after")
def _guarded(v):
    return loads.publish_versions(v("db_before"), v("db_incoming")).select("order_id", "version", "amount", "updated_at")


@query("j14_scalar_subquery", """
    SELECT activity_id FROM cloud_activities WHERE rows_read = (SELECT COUNT(*) FROM cloud_latest)""")
def _scalar(v):
    visible = evidence.latest_visible({"cloud_context": v("cloud_context"), "cloud_source": v("cloud_source")})
    return v("cloud_activities").where(F.col("rows_read") == visible.agg(F.count(F.lit(1))).scalar()).select("activity_id")


# Aggregations


@query("a01_row_count", "SELECT COUNT(*) AS n FROM target_orders")
def _rows(v):
    return rollups.row_total(v("target_orders"))


@query("a02_summed_count", "SELECT CAST(COALESCE(SUM(order_count), 0) AS BIGINT) AS n FROM target_daily_sales")
def _summed(v):
    return rollups.row_total(v("target_daily_sales"), "order_count")


@query("a03_conditional_counts", """
    SELECT COUNT(*) FILTER (WHERE net_amount IS NULL) AS net_amount, COUNT(*) FILTER (WHERE customer_id IS NULL) AS customer_id,
           COUNT(*) FILTER (WHERE customer_id <= 0) AS non_positive FROM target_orders""")
def _conditional(v):
    return scope.count_where(
        v("target_orders"), net_amount=F.col("net_amount").isNull(), customer_id=F.col("customer_id").isNull(),
        non_positive=F.col("customer_id") <= 0,
    )


@query("a04_duplicate_groups", "SELECT order_id, COUNT(*) AS occurrences FROM target_orders GROUP BY order_id HAVING COUNT(*) > 1")
def _duplicates(v):
    return reconcile.duplicate_groups(v("target_orders"), ["order_id"])


@query("a05_surplus_rows", """
    SELECT COUNT(*) AS duplicate_groups, CAST(COALESCE(SUM(c - 1), 0) AS BIGINT) AS duplicate_rows
    FROM (SELECT l_orderkey, l_linenumber, COUNT(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1) d""")
def _surplus(v):
    return reconcile.duplicate_summary(v("lineitem"), ["l_orderkey", "l_linenumber"])


@query("a06_utc_daily_rollup", """
    SELECT CAST(ordered_at AS DATE) AS order_date, COUNT(*) AS order_count, CAST(SUM(gross_amount) AS DECIMAL(18,2)) AS gross_revenue,
           CAST(SUM(CAST(gross_amount - discount_amount - refund_amount AS DECIMAL(14,2))) AS DECIMAL(18,2)) AS net_revenue
    FROM source_orders GROUP BY CAST(ordered_at AS DATE)""")
def _daily_rollup(v):
    return rollups.utc_daily_sales(v("source_orders").withColumn("net_amount", exprs.net_amount()))


@query("a07_sum_by_key", "SELECT order_id, net_amount FROM line_totals")
def _sums(v):
    return rollups.sum_by(v("order_lines"), ["order_id"], "net_amount", decimal_type="decimal(18,2)")


@query("a08_two_key_report", "SELECT sale_date, region, sale_count, total FROM sy_expected_report")
def _report(v):
    fact = loads.publish_fact(v("sy_staging"), v("sy_dimension"))
    return loads.publish_report(fact, v("sy_dimension")).drop("run_id")


@query("a09_min_max_probes", """
    SELECT MIN(order_id) AS lowest_key, MAX(order_id) AS highest_key, (SELECT MIN(arrived_at) FROM incremental_events) AS earliest_arrival,
           (SELECT MAX(step_no) FROM etl_steps) AS last_step FROM target_orders""")
def _probes(v):
    arrivals = v("incremental_events").agg(F.min("arrived_at").alias("earliest_arrival"))
    steps = v("etl_steps").agg(F.max("step_no").alias("last_step"))
    keys = v("target_orders").agg(F.min("order_id").alias("lowest_key"), F.max("order_id").alias("highest_key"))
    return scope.attach(scope.attach(keys, arrivals), steps)


@query("a10_violation_total", f"""
    SELECT *, CAST(null_net_amount + non_positive_customer + daily_mismatch AS BIGINT) AS violation_count FROM (
    SELECT COUNT(*) FILTER (WHERE net_amount IS NULL) AS null_net_amount,
           COUNT(*) FILTER (WHERE customer_id <= 0) AS non_positive_customer, {DAILY} AS daily_mismatch FROM target_orders) c""")
def _total(v):
    rows = scope.count_where(
        v("target_orders"), null_net_amount=F.col("net_amount").isNull(), non_positive_customer=F.col("customer_id") <= 0)
    days = reconcile.diff_count(
        v("gold_daily_sales"), v("target_daily_sales"), ["order_date"], ["order_count", "net_revenue"], name="daily_mismatch")
    return scope.totals([rows, days])


@query("a11_completion_rollup", """
    SELECT user_id, event_type, COUNT(*) AS attempts, bool_or(value > 100) AS completed FROM events GROUP BY user_id, event_type""")
def _completion(v):
    attempts = v("events").withColumn("status", F.when(F.col("value") > 100, F.lit("PASS")).otherwise(F.lit("FAIL")))
    return rollups.completion_rollup(attempts, ["user_id", "event_type"])


@query("a12_multiplicity_profile", """
    SELECT l_orderkey, COUNT(*) AS occurrences FROM lineitem GROUP BY l_orderkey ORDER BY occurrences DESC, l_orderkey LIMIT 10""")
def _multiplicity(v):
    return rollups.multiplicity_profile(v("lineitem"), "l_orderkey")


@query("a12_populated_profile", """
    SELECT COUNT(*) AS total_rows, COUNT(net_amount) AS populated_rows, COUNT(*) FILTER (WHERE net_amount = 0) AS zero_rows,
           CAST(SUM(net_amount) AS DECIMAL(18,2)) AS total, CAST(SUM(DISTINCT net_amount) AS DECIMAL(18,2)) AS distinct_total
    FROM target_orders""")
def _populated(v):
    return rollups.populated_profile(v("target_orders"), "net_amount")


@query("a13_copy_metric_agreement", """
    SELECT activity_id, rows_read = (SELECT COUNT(*) FROM cloud_latest) AS read_agrees,
           rows_written = (SELECT COUNT(*) FROM cloud_target) AS written_agrees
    FROM cloud_activities WHERE target_dataset = 'target'""")
def _agreement(v):
    visible = evidence.latest_visible({"cloud_context": v("cloud_context"), "cloud_source": v("cloud_source")})
    counts = scope.attach(
        visible.agg(F.count(F.lit(1)).alias("visible_rows")), v("cloud_target").agg(F.count(F.lit(1)).alias("target_rows")))
    publishing = scope.attach(v("cloud_activities").where(F.col("target_dataset") == "target"), counts)
    return publishing.select(
        "activity_id", (F.col("rows_read") == F.col("visible_rows")).alias("read_agrees"),
        (F.col("rows_written") == F.col("target_rows")).alias("written_agrees"),
    )


# Windows


@query("w01_latest_version", "SELECT event_id, order_id, updated_at, net_amount FROM ranked_order_events WHERE rn = 1")
def _latest(v):
    return versions.latest_by(v("source_order_events"), ["order_id"], ["updated_at", "event_id"])


@query("w02_latest_per_instant", "SELECT event_id, customer_id, effective_at, tier FROM instant_changes WHERE rn = 1")
def _instant(v):
    return versions.latest_by(v("source_customer_changes"), ["customer_id", "effective_at"], ["event_id"])


@query("w03_next_start", "SELECT version_id, customer_id, tier, valid_from, valid_to, valid_to IS NULL AS is_current FROM clean_history")
def _next(v):
    return versions.type2_history(v("source_customer_changes"))


@query("w04_first_row_per_key", "SELECT order_id, customer_id, amount, updated_at, event_id, batch_no, run_id FROM cloud_latest")
def _first_row(v):
    return evidence.latest_visible({"cloud_context": v("cloud_context"), "cloud_source": v("cloud_source")})


@query("w05_latest_by_batch", "SELECT order_id, event_id, gross_text FROM replay_ranked WHERE rn = 1")
def _batch_latest(v):
    context = v("etl_context").select("batch_no")
    seen = scope.attach(v("replay_source"), context).where(F.col("arrived_batch") <= F.col("batch_no")).drop("batch_no")
    return versions.latest_by(seen, ["order_id"], ["event_id"]).select("order_id", "event_id", "gross_text")


# Bounded results


@query("t01_ordered_evidence", """
    SELECT kind, order_id FROM (
        SELECT 'MISSING_KEY' AS kind, order_id FROM (SELECT order_id FROM source_orders EXCEPT SELECT order_id FROM target_orders) m
        UNION ALL
        SELECT 'UNEXPECTED_KEY', order_id FROM (SELECT order_id FROM target_orders EXCEPT SELECT order_id FROM source_orders) u) d
    ORDER BY kind, order_id NULLS LAST LIMIT 20""")
def _evidence(v):
    listed = reconcile.key_difference(v("source_orders"), v("target_orders"), ["order_id"])
    return previews.first_rows(listed, ["kind", "order_id"], 20)


@query("t02_latest_success", """
    SELECT run_id, started_at FROM cloud_runs WHERE execution_status = 'SUCCESS' ORDER BY started_at DESC NULLS FIRST, run_id DESC LIMIT 1""")
def _last_run(v):
    return previews.latest_success(v("cloud_runs")).select("run_id", "started_at")


@query("t04_half_subset", """
    SELECT order_id FROM source_orders ORDER BY order_id LIMIT (SELECT GREATEST(1, COUNT(*) // 2) FROM source_orders)""")
def _half(v):
    return previews.half_subset(v("source_orders"), "order_id").select("order_id")


@query("t05_bounded_preview", """
    SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(net_amount AS VARCHAR) AS net_amount
    FROM (SELECT order_id, net_amount FROM target_orders ORDER BY order_id, net_amount NULLS LAST LIMIT 100) p""")
def _preview(v):
    ordered = previews.first_rows(v("target_orders").select("order_id", "net_amount"), ["order_id", "net_amount"], 101)
    shown = previews.preview(ordered)
    return v.spark.createDataFrame(list(shown.rows), "order_id string, net_amount string")


# Set operations


@query("u01_symmetric_key_difference", """
    SELECT 'MISSING_KEY' AS kind, order_id FROM (SELECT order_id FROM source_orders EXCEPT SELECT order_id FROM target_orders) m
    UNION ALL SELECT 'UNEXPECTED_KEY', order_id FROM (SELECT order_id FROM target_orders EXCEPT SELECT order_id FROM source_orders) u""")
def _key_difference(v):
    return reconcile.key_difference(v("source_orders"), v("target_orders"), ["order_id"])


@query("u02_layer_profiles", """
    SELECT 'bronze' AS layer, COUNT(*) AS n, CAST(SUM(amount) AS DECIMAL(18,2)) AS total FROM cloud_bronze
    UNION ALL SELECT 'silver', COUNT(*), CAST(SUM(amount) AS DECIMAL(18,2)) FROM cloud_silver
    UNION ALL SELECT 'target', COUNT(*), CAST(SUM(amount) AS DECIMAL(18,2)) FROM cloud_target""")
def _profiles(v):
    def profile(layer):
        return v(f"cloud_{layer}").agg(
            F.lit(layer).alias("layer"), F.count(F.lit(1)).alias("n"), F.sum("amount").cast("decimal(18,2)").alias("total"))

    return profile("bronze").unionByName(profile("silver")).unionByName(profile("target"))


# Loads and merges

STATE = "event_id, order_id, event_at, net_amount"
MERGED = """(SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY event_at DESC NULLS FIRST, event_id DESC NULLS FIRST) AS rn
    FROM incremental_events{0})"""


@query("m01_versioned_merge", f"SELECT {STATE} FROM {MERGED.format('')} r WHERE rn = 1")
def _merge(v):
    events = v("incremental_events")
    columns = ["event_id", "order_id", "event_at", "net_amount"]
    old, new = (events.where(c).select(*columns) for c in ("batch_no <= 2", "batch_no >= 2"))
    return versions.merge_versions(old, new, ["order_id"], ["event_at", "event_id"])


@query("m02_batch_advance", f"""
    SELECT 1 AS step_no, 1 AS batch_no, 'NEXT' AS operation, COUNT(*) AS selected_events, COUNT(DISTINCT order_id) AS target_rows
        FROM incremental_events WHERE batch_no = 1
    UNION ALL SELECT 2, 2, 'NEXT', COUNT(*) FILTER (WHERE batch_no = 2), COUNT(DISTINCT order_id) FROM incremental_events WHERE batch_no <= 2
    UNION ALL SELECT 3, 2, 'REPLAY', COUNT(*) FILTER (WHERE batch_no = 2), COUNT(DISTINCT order_id) FROM incremental_events WHERE batch_no <= 2
    UNION ALL SELECT 4, 3, 'NEXT', COUNT(*) FILTER (WHERE batch_no = 3), COUNT(DISTINCT order_id) FROM incremental_events WHERE batch_no <= 3""")
def _advance(v):
    load = incremental_load(v)
    return v.spark.createDataFrame(
        [(s["step_no"], s["batch_no"], s["operation"], s["selected_events"], s["target_rows"]) for s in load.steps],
        "step_no int, batch_no int, operation string, selected_events bigint, target_rows bigint")


def incremental_load(v):
    load = loads.IncrementalLoad(Store(v.spark, work_dir(v.spark, "incremental")), v.stored("incremental_events"))
    for action in ("NEXT", "NEXT", "REPLAY", "NEXT"):
        load.advance(action)
    return load


@query("m02_advanced_target", f"SELECT {STATE} FROM {MERGED.format('')} r WHERE rn = 1")
def _advanced(v):
    return incremental_load(v).target()


@query("m03_arrival_cutoff", """
    SELECT batch_no, COUNT(*) AS selected_events, MAX(arrived_at) AS cutoff,
           MAX(MAX(arrived_at)) OVER (ORDER BY batch_no) AS watermark FROM incremental_events GROUP BY batch_no""")
def _cutoff(v):
    return loads.running_watermark(v("incremental_events"))


@query("m03_late_events", """
    SELECT event_id FROM incremental_events e JOIN
        (SELECT batch_no, MAX(MAX(event_at)) OVER (ORDER BY batch_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
         FROM incremental_events GROUP BY batch_no) m ON e.batch_no = m.batch_no WHERE e.event_at < m.seen""")
def _late(v):
    return loads.late_events(v("incremental_events")).select("event_id")


@query("m04_append_policy", """
    SELECT order_id, COUNT(*) AS copies FROM (SELECT order_id FROM incremental_events UNION ALL
    SELECT order_id FROM incremental_events WHERE batch_no = 2) a GROUP BY order_id""")
def _append(v):
    target = loads.run_batches(v("incremental_events"), (1, 2, 2, 3), "inc_append")
    return target.groupBy("order_id").agg(F.count(F.lit(1)).alias("copies"))


@query("m04_first_version_policy", f"""
    SELECT {STATE} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id
        ORDER BY batch_no, event_at DESC NULLS FIRST, event_id DESC NULLS FIRST) AS rn FROM incremental_events) r WHERE rn = 1""")
def _stale(v):
    return loads.run_batches(v("incremental_events"), (1, 2, 2, 3), "inc_stale")


@query("m04_lost_event_policy", f"""
    SELECT {STATE} FROM {MERGED.format(" WHERE event_id <> (SELECT MIN(event_id) FROM incremental_events WHERE batch_no = 3)")} r
    WHERE rn = 1""")
def _lost(v):
    return loads.run_batches(v("incremental_events"), (1, 2, 2, 3), "inc_missing")


@query("m04_event_watermark_policy", f"""WITH kept_one AS (SELECT * FROM incremental_events WHERE batch_no = 1),
    kept_two AS (SELECT * FROM kept_one UNION ALL SELECT * FROM incremental_events
                 WHERE batch_no = 2 AND event_at > (SELECT MAX(event_at) FROM kept_one)),
    kept_all AS (SELECT * FROM kept_two UNION ALL SELECT * FROM incremental_events
                 WHERE batch_no = 3 AND event_at > (SELECT MAX(event_at) FROM kept_two))
    SELECT {STATE} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY event_at DESC, event_id DESC) AS rn FROM kept_all) r
    WHERE rn = 1""")
def _event_watermark(v):
    return loads.run_batches(v("incremental_events"), (1, 2, 2, 3), "inc_event_watermark")


@query("m05_guarded_upsert", """
    SELECT order_id, order_id AS customer_id, event_id,
           CAST(CAST(gross_text AS DECIMAL(18,2)) - CAST(discount_text AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS net_amount
    FROM replay_ranked WHERE rn = 1 AND order_id < (SELECT COUNT(*) FROM customer)""")
def _upsert(v):
    """Loading batch one and then both batches equals loading both at once."""
    source, customers = v("replay_source"), v("etl_customers")
    first, rejected = loads.load_text_orders(source, customers, 1)
    target, _ = loads.load_text_orders(source, customers, 2, existing=first, existing_rejects=rejected)
    return target


@query("m06_version_guarded_apply", "SELECT order_id, version, amount, updated_at FROM db_expected_after")
def _apply(v):
    """Applying the same incoming rows again changes nothing."""
    once = loads.publish_versions(v("db_before"), v("db_incoming"))
    return loads.publish_versions(once, v("db_incoming")).select("order_id", "version", "amount", "updated_at")


BAD_TEXT = "order_id % 97 = 0 OR order_id % 89 = 0"


@query("m07_quarantine_accepted", "SELECT order_id, customer_id, net_amount, event_id FROM etl_good_target")
def _accepted(v):
    return loads.load_text_orders(v("etl_source"), v("etl_customers"), 3)[0]


@query("m07_quarantine_rejects", f"SELECT order_id, 'INVALID_AMOUNT' AS reason FROM etl_source WHERE {BAD_TEXT}")
def _rejected(v):
    target, once = loads.load_text_orders(v("etl_source"), v("etl_customers"), 3)
    return loads.load_text_orders(v("etl_source"), v("etl_customers"), 3, existing=target, existing_rejects=once)[1]


@query("m07_unmapped_codes", """
    SELECT DISTINCT s.customer_code FROM etl_source s WHERE s.customer_code NOT IN
    (SELECT customer_code FROM etl_customers WHERE customer_id % 7 <> 0)""")
def _unmapped(v):
    return loads.unmapped_codes(v("etl_source"), v("etl_customers").where(F.col("customer_id") % 7 != 0))


@query("m07_unmapped_rejects", f"""
    SELECT order_id, 'INVALID_AMOUNT' AS reason FROM etl_source WHERE {BAD_TEXT}
    UNION SELECT order_id, 'UNMAPPED_CODE' FROM etl_source WHERE NOT ({BAD_TEXT}) AND customer_code NOT IN
    (SELECT customer_code FROM etl_customers WHERE customer_id % 7 <> 0)""")
def _unmapped_rejects(v):
    """No row is lost when codes have no mapping."""
    return loads.load_text_orders(v("etl_source"), v("etl_customers").where(F.col("customer_id") % 7 != 0), 3)[1]


@query("m02_reopened_target", f"SELECT {STATE} FROM {MERGED.format('')} r WHERE rn = 1")
def _reopened(v):
    """A second load object goes on where the first one stopped."""
    store, events = Store(v.spark, work_dir(v.spark, "incremental")), v.stored("incremental_events")
    loads.IncrementalLoad(store, events).advance("NEXT")
    for action in ("NEXT", "REPLAY", "NEXT"):
        loads.IncrementalLoad(store, events).advance(action)
    return loads.IncrementalLoad(store, events).target()


@query("m08_reopened_replay", "SELECT order_id, customer_id, net_amount, event_id FROM etl_good_target")
def _reopened_replay(v):
    """A second load object replays and goes on over the published snapshot."""
    store = Store(v.spark, work_dir(v.spark, "etl"))
    reopened = lambda: loads.TextOrderLoad(store, v("etl_source"), v("etl_customers"), 3)
    for action in ("RUN", "REPLAY", "NEXT", "RECOVER"):
        reopened().advance(action)
    return reopened().target()


@query("m08_checkpoint_log", f"""
    SELECT 1 AS step_no, 'RUN' AS operation, COUNT(*) FILTER (WHERE NOT ({BAD_TEXT})) AS target_rows,
           COUNT(*) FILTER (WHERE {BAD_TEXT}) AS rejected_rows, 3 AS checkpoint FROM etl_source
    UNION ALL SELECT 2, 'RECOVER', COUNT(*) FILTER (WHERE NOT ({BAD_TEXT})), COUNT(*) FILTER (WHERE {BAD_TEXT}), 3 FROM etl_source""")
def _checkpoints(v):
    load = loads.TextOrderLoad(Store(v.spark, work_dir(v.spark, "etl")), v("etl_source"), v("etl_customers"), 3)
    load.advance("RUN")
    load.advance("RECOVER")
    return v.spark.createDataFrame(
        [(s["step_no"], s["operation"], s["target_rows"], s["rejected_rows"], s["checkpoint"]) for s in load.steps],
        "step_no int, operation string, target_rows bigint, rejected_rows bigint, checkpoint int")


@query("m08_compacted_log", """
    SELECT e.batch_no AS step_no, COUNT(*) AS selected_events, (SELECT COUNT(*) FROM incremental_events) AS all_events, 3 AS newest
    FROM incremental_events e GROUP BY e.batch_no""")
def _compacted(v):
    """Steps folded into segments of two; a reader gets all of them from segments and files, and the newest from one file."""
    counts = v("incremental_events").groupBy("batch_no").agg(F.count(F.lit(1)).alias("n")).orderBy("batch_no")
    log = StepLog(v.spark, work_dir(v.spark, "log"), schemas.struct("incremental_steps"), every=2)
    for r in counts.collect():
        log.append({"step_no": r.batch_no, "batch_no": r.batch_no, "operation": "NEXT", "execution_status": "SUCCESS", "selected_events": r.n})
    total = F.sum("selected_events").over(Window.partitionBy("operation"))
    return log.frame().select("step_no", "selected_events", total.alias("all_events"), F.lit(log.last()[0]["step_no"]).alias("newest"))


CLOUD_FIELDS = "order_id, customer_id, amount, updated_at, event_id, batch_no, run_id"


@query("m09_layered_publish", f"SELECT {CLOUD_FIELDS} FROM cloud_latest")
def _layered(v):
    context = v("cloud_context")
    return loads.publish_layers(
        v("cloud_source"), context.select("batch_no").scalar(), context.select("as_of").scalar())["cloud_target"]


@query("m10_publish_with_lineage", """
    SELECT activity_id, 'run-new' AS run_id, 'SUCCESS' AS execution_status, (SELECT COUNT(*) FROM cloud_latest) AS rows_read,
           (SELECT COUNT(*) FROM cloud_latest) AS rows_written FROM cloud_activities""")
def _lineage(v):
    names = ("cloud_context", "cloud_source", "cloud_activities", "cloud_steps")
    tables = {**v.tables(*names), "cloud_runs": v("cloud_runs").withColumn("raw_evidence", F.lit("{}"))}
    published = loads.publish_with_lineage(tables, "run-new", "RECOVER", None)
    return published["cloud_activities"].select("activity_id", "run_id", "execution_status", "rows_read", "rows_written")


@query("m11_classification_publish", "SELECT record_id, classification, amount, 'run-1' AS run_id FROM db_contract")
def _publish_classes(v):
    return loads.publish_classification(v("db_source"))


@query("m12_fact_publish", "SELECT sale_id, customer_key, amount, sale_date, 'run-1' AS run_id FROM sy_expected_fact")
def _publish_fact(v):
    return loads.publish_fact(v("sy_staging"), v("sy_dimension"))


@query("m13_report_publish", """
    SELECT f.sale_date, d.region, COUNT(*) AS sale_count, CAST(SUM(f.amount) AS DECIMAL(14,2)) AS total, 'run-1' AS run_id
    FROM sy_expected_fact f JOIN sy_dimension d ON f.customer_key = d.customer_key GROUP BY f.sale_date, d.region""")
def _publish_report(v):
    return loads.publish_report(v("sy_expected_fact"), v("sy_dimension"))


@query("m15_step_summary", "SELECT step_no, operation, batch_no FROM cloud_steps ORDER BY step_no DESC LIMIT 3")
def _summary(v):
    return loads.step_summary(v("cloud_steps"), 3).select("step_no", "operation", "batch_no")
