"""Batch loads: incremental merges, quarantine and replay, layered and contract publications."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.exprs import amounts_ok, classification, text_amount
from plumbline.operators.ranges import RANGE_ROWS, with_ranges
from plumbline.operators.rollups import region_report
from plumbline.operators.versions import first_version_merge, guarded_apply, latest_by, merge_versions
from plumbline.sources.commits import StepLog
from plumbline.sources.store import Store

Tables = dict[str, DataFrame]

STATE = ["event_id", "order_id", "event_at", "net_amount"]
KEY, ORDER = ["order_id"], ["event_at", "event_id"]


class LoadError(ValueError):
    """A load that cannot go on; nothing was published."""


# Incremental loads

def apply_batch(current: DataFrame, events: DataFrame, batch_no: int, policy: str = "merge",
                watermark=None) -> DataFrame:
    """Target after one batch. Every policy but ``merge`` is a labelled defect."""
    incoming = events.where(F.col("batch_no") == batch_no)
    if policy == "inc_event_watermark" and watermark is not None:
        incoming = incoming.where(F.col("event_at") > watermark)
    if policy == "inc_missing" and batch_no == 3:
        lost = incoming.agg(F.min("event_id")).scalar()
        incoming = incoming.where(F.col("event_id") != lost)
    incoming = incoming.select(*STATE)
    if policy == "inc_append":
        return current.unionByName(incoming)
    if policy == "inc_stale":
        return first_version_merge(current, incoming, KEY, ORDER)
    return merge_versions(current, incoming, KEY, ORDER)


def run_batches(events: DataFrame, batches: Sequence[int], policy: str = "merge") -> DataFrame:
    """Target after the given batches in order; a repeated number is a replay."""
    target, mark = events.select(*STATE).limit(0), None
    for batch_no in batches:
        target = apply_batch(target, events, batch_no, policy, mark)
        if policy == "inc_event_watermark":
            mark = target.agg(F.max("event_at")).scalar()
    return target


class IncrementalLoad:
    """The merge over persisted batches: NEXT, REPLAY, RESET with a step log.

    A step writes only its batch's newest row per key, into the folder of that
    batch. Reading takes the greatest version over all folders, so a replay
    rewrites one folder with the same rows and the full target is never rewritten.
    All state is in the store: a new object goes on where the last one ended.
    """

    def __init__(self, store: Store, events: DataFrame, name: str = "incremental"):
        self.store, self.events, self.name = store, events, name

    def _generation(self) -> str | None:
        return self.store.current_snapshot(self.name)

    def _folder(self, generation: str) -> str:
        return f"{self.store.path(self.name)}/{generation}"

    def log(self, generation: str | None = None) -> StepLog | None:
        """The step log of the current generation; none before the first step."""
        generation = generation or self._generation()
        return self.store.steps(f"{self.name}.steps/{generation}", "incremental_steps") if generation else None

    def _last(self) -> dict | None:
        log = self.log()
        return next(iter(log.last()), None) if log else None

    @property
    def steps(self) -> list[dict]:
        """The newest steps, oldest first; ``log().frame()`` has all of them."""
        log = self.log()
        return log.last(log.KEEP) if log else []

    def target(self) -> DataFrame:
        last = self._last()
        return self._loaded(self._generation(), last["batch_no"] if last else 0)

    def _loaded(self, generation: str | None, upto: int) -> DataFrame:
        """The merge over the folders of the batches that steps have loaded: the numbers from 1 on."""
        if not upto:
            return self.events.select(*STATE).limit(0)
        schema = self.events.select(*STATE).schema.add("batch_no", T.IntegerType())
        folders = self.store.spark.read.schema(schema).parquet(self._folder(generation))
        return latest_by(folders.where(F.col("batch_no") <= upto).select(*STATE), KEY, ORDER)

    def advance(self, action: str) -> dict | None:
        """One step. Of two objects that take the same step one goes on; the other one gets a CommitConflict."""
        if action == "RESET":
            self.store.mark(self.name, uuid.uuid4().hex)
            return None
        if action not in ("NEXT", "REPLAY"):
            raise LoadError(f"unknown action: {action}")
        if self._generation() is None:
            self.store.mark(self.name, uuid.uuid4().hex)
        generation = self._generation()
        log = self.log(generation)
        before = next(iter(log.last()), {"step_no": 0, "batch_no": 0})
        last = before["batch_no"]
        batch_no = last + 1 if action == "NEXT" else last
        batch = self.events.where(F.col("batch_no") == batch_no)
        facts = batch.agg(F.count(F.lit(1)).alias("n"), F.max("arrived_at").alias("cutoff")).first()
        if batch_no < 1 or facts.n == 0:
            raise LoadError("no next batch, or no batch to replay")
        latest_by(batch.select(*STATE), KEY, ORDER).write.mode("overwrite").parquet(
            f"{self._folder(generation)}/batch_no={batch_no}")
        return log.append({
            "step_no": before["step_no"] + 1, "batch_no": batch_no, "operation": action, "execution_status": "SUCCESS",
            "selected_events": facts.n, "target_rows": self._loaded(generation, max(batch_no, last)).count(), "watermark": facts.cutoff,
        })

    @property
    def as_of(self):
        last = self._last()
        return last["watermark"] if last else None


# Text amounts: quarantine, mapping, guarded upsert

def split_amounts(source: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with two well-formed amounts, and the others; text without value is malformed."""
    flagged = source.withColumn("_ok", F.coalesce(amounts_ok(), F.lit(False)))
    return flagged.where("_ok").drop("_ok"), flagged.where(~F.col("_ok")).drop("_ok")


def rejects(bad: DataFrame, existing: DataFrame | None = None, unmapped: DataFrame | None = None) -> DataFrame:
    """One reject per order and reason, however often the row is loaded."""
    fresh = bad.select("order_id", F.lit("INVALID_AMOUNT").alias("reason"))
    if unmapped is not None:
        fresh = fresh.unionByName(unmapped.select("order_id", F.lit("UNMAPPED_CODE").alias("reason")))
    return (fresh if existing is None else existing.unionByName(fresh)).distinct()


def unmapped_codes(good: DataFrame, customers: DataFrame) -> DataFrame:
    return good.join(customers.select("customer_code"), "customer_code", "left_anti").select("customer_code").distinct()


def map_and_price(good: DataFrame, customers: DataFrame) -> DataFrame:
    """Customer ids from the mapping and exact net amounts; the id is null where the code has no mapping.

    A code that maps to several customers stops the job.
    """
    ids = customers.groupBy("customer_code").agg(F.min("customer_id").alias("customer_id"), F.max("customer_id").alias("other"))
    single = F.coalesce(F.col("customer_id") == F.col("other"), F.lit(True))
    mapping = ids.select("customer_code", F.when(single, F.col("customer_id")).otherwise(
        F.raise_error(F.concat(F.lit("several customers for code "), F.col("customer_code")))).alias("customer_id"))
    net = text_amount("gross_text") - text_amount("discount_text")
    return good.join(mapping, "customer_code", "left").select(
        "order_id", "customer_id", net.cast("decimal(18,2)").alias("net_amount"), "event_id"
    )


def load_text_orders(source: DataFrame, customers: DataFrame, batch_no: int, policy: str = "merge",
                     existing: DataFrame | None = None, existing_rejects: DataFrame | None = None, after: int = 0,
                     ) -> tuple[DataFrame, DataFrame]:
    """Target and rejects after loading the batches beyond ``after`` and up to ``batch_no``.

    The newest event per order wins, so loading a batch again changes nothing. Every row is in
    the target or rejected: malformed amounts and codes without mapping have reasons of their own.
    ``etl_append`` and ``etl_skip_late`` are labelled defects.
    """
    visible = source.where((F.col("arrived_batch") > after) & (F.col("arrived_batch") <= batch_no))
    good, bad = split_amounts(visible)
    if policy == "etl_skip_late":
        first = visible.agg(F.min_by("order_id", "event_id")).scalar()
        good = good.where(~((F.col("arrived_batch") > 1) & (F.col("order_id") == first)))
    priced = map_and_price(good, customers)
    mapped, unmapped = priced.where("customer_id IS NOT NULL"), priced.where("customer_id IS NULL")
    loaded = mapped if existing is None else existing.unionByName(mapped)
    target = loaded if policy == "etl_append" else latest_by(loaded, ["order_id"], ["event_id"])
    return target, rejects(bad, existing_rejects, unmapped)


class TextOrderLoad:
    """RUN, RECOVER, NEXT, REPLAY and RESET over published snapshots, with a step log.

    The checkpoint of a step is the batch it has loaded; a step reads only the batches beyond the last
    one's, a replay the last one. A code without mapping stops the step before anything is published, and so does
    another step that was published meanwhile.
    All state is in the store: a new object goes on where the last one ended.
    """

    def __init__(self, store: Store, source: DataFrame, customers: DataFrame, last_batch: int, name: str = "etl"):
        self.store, self.source, self.customers = store, source, customers
        self.last_batch, self.name = last_batch, name

    def target(self) -> DataFrame:
        return self.store.current_part(self.name, "target")

    def rejected(self) -> DataFrame:
        return self.store.current_part(self.name, "rejects")

    def log(self) -> StepLog | None:
        """The step log of the current generation; none before the first step."""
        generation = self.store.current_snapshot(f"{self.name}.generation")
        return self.store.steps(f"{self.name}.steps/{generation}", "etl_steps") if generation else None

    @property
    def steps(self) -> list[dict]:
        """The newest steps, oldest first; ``log().frame()`` has all of them."""
        log = self.log()
        return log.last(log.KEEP) if log else []

    def _last(self) -> dict | None:
        log = self.log()
        return next(iter(log.last()), None) if log else None

    @property
    def batch_no(self) -> int:
        last = self._last()
        return last["checkpoint"] if last else 0

    def advance(self, action: str) -> dict | None:
        if action == "RESET":
            self.store.mark(f"{self.name}.generation", uuid.uuid4().hex)
            return None
        last, parent = self._last(), self.store.version(self.name)
        done = last["checkpoint"] if last else 0
        if action == "NEXT":
            after, upto = done, min(done + 1, self.last_batch)
        elif action == "RECOVER":
            after, upto = done, self.last_batch
        elif action == "RUN":
            after, upto = 0, self.last_batch
        elif action == "REPLAY":
            after, upto = done - 1, done
        else:
            raise LoadError(f"unknown action: {action}")
        good, _ = split_amounts(self.source.where((F.col("arrived_batch") > after) & (F.col("arrived_batch") <= upto)))
        missing = [r[0] for r in unmapped_codes(good, self.customers).orderBy("customer_code").limit(20).collect()]
        if missing:
            raise LoadError(f"customer codes without mapping, first ones: {missing}")
        before = (self.target(), self.rejected()) if last and action != "RUN" else (None, None)
        target, bad = load_text_orders(self.source, self.customers, upto, existing=before[0],
                                       existing_rejects=before[1], after=after)
        if self.log() is None:
            self.store.mark(f"{self.name}.generation", uuid.uuid4().hex)
        self.store.publish_together(self.name, {"target": target, "rejects": bad}, uuid.uuid4().hex, parent)
        return self.log().append({
            "step_no": (last["step_no"] if last else 0) + 1, "operation": action, "execution_status": "SUCCESS",
            "target_rows": self.target().count(), "rejected_rows": self.rejected().count(), "checkpoint": upto,
        })

    def state(self, last: int = 20) -> dict:
        log = self.log()
        steps = log.last(last) if log else []
        return {"batch_no": steps[-1]["checkpoint"] if steps else 0, "steps": steps}


# Layered and contract publications

def visible_latest(source: DataFrame, batch_no, as_of, policy: str = "merge") -> DataFrame:
    """Latest event per order up to a batch and an inclusive clock; other policies are defects."""
    upto = F.col("updated_at") < as_of if policy == "cloud_boundary_skip" else F.col("updated_at") <= as_of
    seen = source.where((F.col("batch_no") <= batch_no) & upto)
    if policy == "cloud_skip_late":
        seen = seen.where(~((F.col("batch_no") > 1) & (F.col("updated_at") < as_of)))
    return latest_by(seen, ["order_id"], ["event_id"])


def publish_layers(source: DataFrame, batch_no, as_of, policy: str = "merge", run_id: str | None = None) -> Tables:
    """Bronze, silver and target from one visible state; the target may carry a new run id."""
    rows = visible_latest(source, batch_no, as_of, policy)
    target = rows
    if policy == "cloud_replay_duplicate":
        target = rows.unionByName(rows.orderBy("order_id").limit(1))
    if run_id is not None:
        target = target.withColumn("run_id", F.lit(run_id))
    return {"cloud_bronze": rows, "cloud_silver": rows, "cloud_target": target}


def publish_with_lineage(t: Tables, run_id: str, operation: str, as_of_now) -> Tables:
    """Publish again under a new run: rows, activities, run and step all name it."""
    context = t["cloud_context"]
    batch_no, as_of = context.select("batch_no").scalar(), context.select("as_of").scalar()
    layers = publish_layers(t["cloud_source"], batch_no, as_of, run_id=run_id)
    rows = layers["cloud_target"].agg(F.count(F.lit(1)).alias("n"))
    spark = context.sparkSession
    activities = t["cloud_activities"].withColumns({
        "run_id": F.lit(run_id), "execution_status": F.lit("SUCCESS"),
        "rows_read": rows.scalar(), "rows_written": rows.scalar(),
    })
    run = spark.createDataFrame(
        [(run_id, "SUCCESS", as_of_now, as_of_now, '{"operation": "%s", "provenance": "SIMULATED"}' % operation)],
        t["cloud_runs"].schema,
    )
    step_no = F.coalesce(t["cloud_steps"].agg(F.max("step_no")).scalar(), F.lit(0)) + 1
    step = context.select(
        step_no.cast("int").alias("step_no"), F.lit(operation).alias("operation"), F.lit(run_id).alias("run_id"),
        F.lit("SUCCESS").alias("execution_status"), "batch_no", rows.scalar().alias("target_rows"),
        F.col("as_of").alias("watermark"),
    )
    return {
        **t, **layers, "cloud_activities": activities, "cloud_runs": t["cloud_runs"].unionByName(run),
        "cloud_steps": t["cloud_steps"].unionByName(step),
    }


def publish_classification(source: DataFrame) -> DataFrame:
    return source.select("record_id", classification().alias("classification"), "amount", "run_id")


def publish_versions(after: DataFrame, incoming: DataFrame) -> DataFrame:
    return guarded_apply(after, incoming, ["order_id"], "version")


def publish_fact(staging: DataFrame, dimension: DataFrame) -> DataFrame:
    keys = dimension.select("customer_code", "customer_key")
    return staging.join(keys, "customer_code").select("sale_id", "customer_key", "amount", "sale_date", "run_id")


def publish_report(fact: DataFrame, dimension: DataFrame, run_id: str = "run-1") -> DataFrame:
    return region_report(fact, dimension).withColumn("run_id", F.lit(run_id))


def step_summary(steps: DataFrame, last: int = 20) -> DataFrame:
    """The last steps, oldest first."""
    return steps.orderBy(F.col("step_no").desc()).limit(last).orderBy("step_no")


def _until(per_batch: DataFrame, value: str, strictly: bool) -> DataFrame:
    """Per batch: the greatest ``value`` of the batches up to it, or before it; ranges of batches carry theirs on.

    One row stands for a batch. Batches are cut into ranges, each range is ordered by itself, and the greatest value of the
    ranges before is added from one row a range.
    """
    largest = per_batch.agg(F.count(F.lit(1))).first()[0]
    ranged = with_ranges(per_batch.withColumn("_all", F.lit(0)), ["_all"], "batch_no", largest)
    upto = Window.partitionBy("_range").orderBy("batch_no").rowsBetween(Window.unboundedPreceding, -1 if strictly else 0)
    inside = ranged.withColumn("_inside", F.max(value).over(upto))
    if largest <= RANGE_ROWS:
        return inside.withColumn("until", F.col("_inside")).drop("_all", "_range", "_inside")
    tops = ranged.groupBy("_range").agg(F.max(value).alias("_top"))
    earlier = tops.alias("t").join(tops.select(F.col("_range").alias("_r"), F.col("_top").alias("_b")), F.col("_r") < F.col("t._range"))
    carried = earlier.groupBy("_range").agg(F.max("_b").alias("_carried"))
    joined = inside.join(F.broadcast(carried), "_range", "left")
    return joined.withColumn("until", F.greatest("_inside", "_carried")).drop("_all", "_range", "_inside", "_carried")


def running_watermark(events: DataFrame) -> DataFrame:
    """Arrival cutoff after each batch: the greatest arrival so far."""
    cutoffs = events.groupBy("batch_no").agg(
        F.max("arrived_at").alias("cutoff"), F.count(F.lit(1)).alias("selected_events")
    )
    return _until(cutoffs, "cutoff", strictly=False).withColumnRenamed("until", "watermark")


def late_events(events: DataFrame) -> DataFrame:
    """Events older than the newest event time of the batches before theirs.

    They are why a high-watermark on event time loses data: every one of them
    would be skipped.
    """
    newest = events.groupBy("batch_no").agg(F.max("event_at").alias("newest"))
    marks = _until(newest, "newest", strictly=True).select("batch_no", F.col("until").alias("seen_until"))
    return events.join(marks, "batch_no").where(F.col("event_at") < F.col("seen_until")).drop("seen_until")
