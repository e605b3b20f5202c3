"""Deterministic customers and orders, derived from ids by column expressions."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.exprs import net_amount

# The parameters of the source data.
COUNTRIES = ("VN", "US", "GB", "SG", "AU")
BASE_TIME = datetime(2026, 1, 1, tzinfo=timezone.utc)
WINDOW_MINUTES = 30 * 24 * 60
GROSS_BASE, GROSS_STEP, GROSS_SPAN = 5_000, 7_919, 500_000
DISCOUNT_STEP, DISCOUNT_SPAN = 37, 1_500
REFUND_EVERY, REFUND_RATE = 17, "0.10"
CUSTOMER_STEP, TIME_STEP, UPDATE_SPAN_HOURS = 73, 37, 48


def _cents(units) -> F.Column:
    return (units.cast("decimal(14,2)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(14,2)")


def customers_from_ids(ids: DataFrame, id_column: str = "customer_id") -> DataFrame:
    key = F.col(id_column)
    codes = F.array(*[F.lit(c) for c in COUNTRIES])
    position = F.pmod(key - 1, F.lit(len(COUNTRIES))).cast("int")
    return ids.select(key.cast("bigint").alias("customer_id"), F.get(codes, position).alias("country_code"))


def orders_from_ids(ids: DataFrame, customer_count: int, id_column: str = "order_id") -> DataFrame:
    """One order per id; every value is a function of the id alone."""
    key = F.col(id_column).cast("bigint")
    gross = _cents(F.lit(GROSS_BASE) + F.pmod(key * GROSS_STEP, F.lit(GROSS_SPAN)))
    discount = _cents(F.pmod(key * DISCOUNT_STEP, F.lit(DISCOUNT_SPAN)))
    tenth = F.round(gross * F.lit(REFUND_RATE).cast("decimal(3,2)"), 2).cast("decimal(14,2)")
    refund = F.when(F.pmod(key, F.lit(REFUND_EVERY)) == 0, tenth).otherwise(F.lit("0.00").cast("decimal(14,2)"))
    offset = F.make_dt_interval(mins=F.pmod(key * TIME_STEP, F.lit(WINDOW_MINUTES)).cast("int"))
    ordered_at = F.lit(BASE_TIME) + offset
    return ids.select(
        key.alias("order_id"),
        (F.pmod(key * CUSTOMER_STEP, F.lit(customer_count)) + 1).alias("customer_id"),
        ordered_at.alias("ordered_at"),
        gross.alias("gross_amount"), discount.alias("discount_amount"), refund.alias("refund_amount"),
        (ordered_at + F.make_dt_interval(hours=F.pmod(key, F.lit(UPDATE_SPAN_HOURS)).cast("int"))).alias("updated_at"),
    )


def generate_customers(spark: SparkSession, count: int = 1_000) -> DataFrame:
    if count <= 0:
        raise ValueError("customer count must be positive")
    return customers_from_ids(spark.range(1, count + 1).toDF("customer_id"))


def generate_orders(spark: SparkSession, count: int = 10_000, customer_count: int = 1_000) -> DataFrame:
    if count <= 0 or customer_count <= 0:
        raise ValueError("counts must be positive")
    return orders_from_ids(spark.range(1, count + 1).toDF("order_id"), customer_count)


def expected_net_revenue(orders: DataFrame) -> DataFrame:
    return orders.agg(F.sum(net_amount()).cast("decimal(18,2)").alias("net_revenue"))
