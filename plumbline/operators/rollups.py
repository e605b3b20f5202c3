"""Grouped summaries at a declared grain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.exprs import utc_day
from plumbline.operators.scope import By


def utc_daily(orders: DataFrame, at: str = "ordered_at", net: str = "net_amount", by: By = ()) -> DataFrame:
    """Orders and net revenue per UTC day."""
    days = orders.withColumn("order_date", utc_day(orders, at))
    return days.groupBy(*by, "order_date").agg(
        F.count(F.lit(1)).alias("order_count"), F.sum(net).cast("decimal(18,2)").alias("net_revenue")
    )


def utc_daily_sales(orders: DataFrame, by: By = ()) -> DataFrame:
    """Orders, gross and net revenue per UTC day."""
    days = orders.withColumn("order_date", utc_day(orders, "ordered_at"))
    return days.groupBy(*by, "order_date").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("gross_amount").cast("decimal(18,2)").alias("gross_revenue"),
        F.sum("net_amount").cast("decimal(18,2)").alias("net_revenue"),
    )


def local_daily(orders: DataFrame, zone: str, at: str = "ordered_at", net: str = "net_amount", by: By = ()) -> DataFrame:
    """Defective grain kept for fault variants: days of a local zone, not of UTC."""
    moment = F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col(at).cast("timestamp_ntz"))
    return orders.groupBy(*by, moment.cast("date").alias("order_date")).agg(
        F.count(F.lit(1)).alias("order_count"), F.sum(net).cast("decimal(18,2)").alias("net_revenue")
    )


def sum_by(df: DataFrame, keys, value: str, name: str | None = None, decimal_type: str | None = None) -> DataFrame:
    total = F.sum(value)
    if decimal_type:
        total = total.cast(decimal_type)
    return df.groupBy(*keys).agg(total.alias(name or value))


def region_report(fact: DataFrame, dimension: DataFrame, by: By = ()) -> DataFrame:
    """Sales per day and region; groups that sum to zero stay."""
    joined = fact.join(dimension.select(*by, "customer_key", "region"), [*by, "customer_key"])
    return joined.groupBy(*by, "sale_date", "region").agg(
        F.count(F.lit(1)).alias("sale_count"), F.sum("amount").cast("decimal(14,2)").alias("total")
    )


def row_total(df: DataFrame, count_column: str | None = None) -> DataFrame:
    """Rows of a table, or the summed counts of a table kept at a coarser grain."""
    value = F.count(F.lit(1)) if count_column is None else F.coalesce(F.sum(count_column), F.lit(0))
    return df.agg(value.cast("bigint").alias("n"))


def multiplicity_profile(df: DataFrame, key: str, top: int = 10) -> DataFrame:
    """The most repeated keys, most frequent first."""
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("occurrences"))
    return counted.orderBy(F.col("occurrences").desc(), F.col(key).asc_nulls_last()).limit(top)


def populated_profile(df: DataFrame, value: str, by: By = ()) -> DataFrame:
    """Rows, populated values, zeros, the sum, and the sum of distinct values.

    The last differs from the sum as soon as an amount repeats: a trap, not a fix
    for a join that repeats rows.
    """
    once = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("copies"))
    return once.groupBy(*by).agg(
        F.sum("copies").alias("total_rows"),
        F.coalesce(F.sum(F.when(F.col(value).isNotNull(), F.col("copies"))), F.lit(0)).alias("populated_rows"),
        F.coalesce(F.sum(F.when(F.col(value) == 0, F.col("copies"))), F.lit(0)).alias("zero_rows"),
        F.sum(F.col(value) * F.col("copies")).cast("decimal(18,2)").alias("total"),
        F.sum(value).cast("decimal(18,2)").alias("distinct_total"),
    )


def completion_rollup(attempts: DataFrame, keys, status: str = "status") -> DataFrame:
    """Attempts per key and whether any of them passed."""
    return attempts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("attempts"), F.bool_or(F.col(status) == "PASS").alias("completed")
    )


def stage_metrics(df: DataFrame, net: str = "net_amount") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum(net), F.lit(0)).cast("decimal(18,2)").alias("net_revenue"),
    )
