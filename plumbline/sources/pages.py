"""Landed API pages: one row per request attempt, with the response body as JSON text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.exprs import json_key, json_type_ok
from plumbline.operators import ranges
from plumbline.operators.ranges import join_keys
from plumbline.session import work_dir

ATTEMPT_SCHEMA = T.StructType([
    T.StructField("page", T.LongType()),
    T.StructField("attempt", T.IntegerType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("headers", T.StringType()),
    T.StructField("elapsed_ms", T.LongType()),
    T.StructField("final", T.BooleanType()),
    T.StructField("body", T.StringType()),
])

# Statuses worth another try, and how often a page may be tried.
RETRY_STATUSES = (429, 503)
MAX_ATTEMPTS = 3


def read_attempts(spark: SparkSession, path: str, labels: T.StructType = T.StructType()) -> DataFrame:
    """Attempt traces landed as JSON lines; ``labels`` are columns that tell crawls apart."""
    return spark.read.schema(T.StructType([*labels.fields, *ATTEMPT_SCHEMA.fields])).json(path)


def write_attempts(attempts: DataFrame, path: str) -> None:
    attempts.write.mode("overwrite").json(path)


def chained_pages(pages: DataFrame, by: Sequence[str] = (), first_page: int = 1) -> DataFrame:
    """Pages that a crawl reaches from its first page through ``next_page``, each once: the crawl's own order.

    ``pages`` has ``page`` and ``next_page`` of the pages that were fetched. A page that isn't there, or was reached before, ends
    the crawl. Runs of pages that name their direct successor become one link each; the links are followed by pointer
    doubling, so a crawl of n links takes log2(n) joins, and a table whose crawls are single runs takes none. A run ends at
    the latest where a block of ``ranges.RANGE_ROWS`` page numbers does, so no task orders more pages than that.
    """
    known = _stored(pages.groupBy(*by, "page").agg(F.min("next_page").alias("next_page")))
    jumps = known.where("next_page <> page + 1").select(*by, F.col("next_page").alias("page")).distinct()
    entered = join_keys(known, jumps.withColumn("entered", F.lit(True)), [*by, "page"])
    inside = Window.partitionBy(*by, "_block").orderBy("page")
    follows = (F.lag("page").over(inside) == F.col("page") - 1) & (F.lag("next_page").over(inside) == F.col("page"))
    heads = entered.withColumn("_block", F.expr(f"page div {ranges.RANGE_ROWS}")).withColumn(
        "head", F.when(F.coalesce(F.col("entered"), F.lit(False)) | ~F.coalesce(follows, F.lit(False)), F.col("page")))
    runs = _stored(heads.withColumn("run", F.max("head").over(inside)).select(*by, "page", "next_page", "run"))
    links = runs.groupBy(*by, "run").agg(F.max_by("next_page", "page").alias("next_page"))
    starts = links.select(*by, F.col("run").alias("next_page"), F.col("run").alias("follower"))
    pointers = join_keys(links, starts, [*by, "next_page"], "inner").select(*by, "run", "follower")
    reached = links.where(F.col("run") == first_page).select(*by, "run")
    if not pointers.isEmpty():
        reached = _followed(reached, pointers, by)
    return join_keys(runs, reached, [*by, "run"], "inner").select(*by, "page")


def _followed(reached: DataFrame, pointers: DataFrame, by: Sequence[str]) -> DataFrame:
    """All runs on the way from the reached ones. Each round knows twice as many of them and points twice as far."""
    reached = _stored(reached)
    while True:
        pointers = _stored(pointers)
        further = join_keys(pointers, reached, [*by, "run"], "inner").select(*by, F.col("follower").alias("run"))
        grown = _stored(reached.unionByName(further).distinct())
        if grown.count() == reached.count():
            return grown
        reached = grown
        ahead = pointers.select(*by, F.col("run").alias("follower"), F.col("follower").alias("beyond"))
        pointers = join_keys(pointers, ahead, [*by, "follower"], "inner").select(*by, "run", F.col("beyond").alias("follower"))


def _stored(frame: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder, so that a round doesn't repeat the rounds before it."""
    path = work_dir(frame.sparkSession, "crawl")
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def page_records(attempts: DataFrame, by: Sequence[str] = (), first_page: int = 1) -> DataFrame:
    """Items of the pages that the crawl reaches: from its first page on, each page names the next one.

    A crawl ends at a page whose final attempt failed, that names no next page or one that didn't land, or that leads
    back to a page it has been to. Pages that no reached page names don't count.
    """
    final = attempts.where("final").where(F.col("status") == 200).select(*by, "page", F.try_parse_json("body").alias("document"))
    follows = F.try_variant_get("document", "$.next_page", "bigint")
    inside = join_keys(final, chained_pages(final.select(*by, "page", follows.alias("next_page")), by, first_page), [*by, "page"], "left_semi")
    items = F.posexplode(F.try_variant_get("document", "$.items", "array<variant>")).alias("pos", "item")
    rows = inside.select(*by, "page", items)
    return rows.withColumn("record_key", json_key(F.col("item"), "order_id"))


def typed_records(records: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Records whose ids are integers and whose amount is a decimal text, with SQL types."""
    item = F.col("item")
    well_typed = (
        json_type_ok(item, "order_id", "integer")
        & json_type_ok(item, "customer_id", "integer")
        & json_type_ok(item, "net_amount", "decimal")
    )
    return records.where(well_typed).select(
        *by, "page", "pos",
        F.try_variant_get(item, "$.order_id", "bigint").alias("order_id"),
        F.try_variant_get(item, "$.customer_id", "bigint").alias("customer_id"),
        F.trim(F.try_variant_get(item, "$.net_amount", "string")).try_cast("decimal(18,2)").alias("net_amount"),
    )


def request_summary(attempts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Requests made, retries among them, and whether the last attempt succeeded."""
    last = F.max(F.struct("page", "attempt", "status"))
    return attempts.groupBy(*by).agg(
        F.count(F.lit(1)).alias("request_count"),
        F.count_if(~F.col("final")).alias("retries"),
        F.when(last["status"] == 200, F.lit("SUCCESS")).otherwise(F.lit("FAILED")).alias("execution_status"),
    )


def finalize_attempts(attempts: DataFrame, by: Sequence[str] = (), max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Keep the attempts a retrying client would make and mark the final one per page.

    A client retries a timeout, 429 or 503 until ``max_attempts``; the first other
    status, or the last permitted attempt, is final.
    """
    keys = [*by, "page"]
    retried = F.col("status").isNull() | F.col("status").isin(*RETRY_STATUSES)
    ends = ~retried | (F.col("attempt") >= max_attempts)
    final_no = attempts.where(ends).groupBy(*keys).agg(F.min("attempt").alias("_final_no"))
    joined = attempts.drop("final").join(final_no, keys, "left")
    kept = joined.where(F.col("_final_no").isNull() | (F.col("attempt") <= F.col("_final_no")))
    marked = kept.withColumn("final", F.coalesce(F.col("attempt") == F.col("_final_no"), F.lit(False)))
    return marked.select(*attempts.columns)
