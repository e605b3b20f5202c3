"""Column expressions shared by the checks: money, UTC days, null-safe comparison."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The text forms and status words that inputs are judged by.
AMOUNT_PATTERN = "^[0-9]+([.][0-9]{1,2})?$"
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"
STATES = ("SUCCESS", "FAILED", "RUNNING", "CANCELLED", "UNKNOWN")
PROVIDER_STATES = {
    "Succeeded": "SUCCESS",
    "Completed": "SUCCESS",
    "Failed": "FAILED",
    "InProgress": "RUNNING",
    "Cancelled": "CANCELLED",
}

MICROS_PER_DAY = 86_400_000_000


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def net_amount(gross="gross_amount", discount="discount_amount", refund="refund_amount") -> Column:
    """Gross less discount less refund, exact to the cent."""
    return (as_col(gross) - as_col(discount) - as_col(refund)).cast("decimal(14,2)")


def distinct_from(left: Column | str, right: Column | str) -> Column:
    """True when the two differ, treating NULL as an ordinary value."""
    return ~as_col(left).eqNullSafe(as_col(right))


def row_differs(left: str, right: str, key: str, fields: Sequence[str]) -> Column:
    """Full-join predicate: one side is absent, or any field differs."""
    absent = F.col(f"{left}.{key}").isNull() | F.col(f"{right}.{key}").isNull()
    return absent | any_of(distinct_from(f"{left}.{f}", f"{right}.{f}") for f in fields)


def utc_day(df: DataFrame, name: str) -> Column:
    """UTC calendar day of a timestamp column, whatever the session time zone."""
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        return F.col(name).cast("date")
    micros = F.unix_micros(name)
    midnight = micros - F.pmod(micros, F.lit(MICROS_PER_DAY))
    return F.date_add(F.lit("1970-01-01").cast("date"), (midnight / F.lit(MICROS_PER_DAY)).cast("int"))


def epoch_micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970 UTC, independent of the session time zone."""
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        seconds = F.expr(
            f"cast(cast(({name} - timestamp_ntz'1970-01-01 00:00:00') as interval second) as decimal(20,6))"
        )
        return (seconds * 1_000_000).cast("bigint")
    return F.unix_micros(name)


def minutes(count: Column | str) -> Column:
    """An exact interval of ``count`` minutes."""
    return F.make_dt_interval(mins=as_col(count).cast("int"))


def amount_text_ok(name: Column | str) -> Column:
    return as_col(name).rlike(AMOUNT_PATTERN)


def amounts_ok(gross="gross_text", discount="discount_text") -> Column:
    return amount_text_ok(gross) & amount_text_ok(discount)


def text_amount(name: Column | str, decimal_type: str = "decimal(18,2)") -> Column:
    """Decimal value of a text amount; text that is no number stops the query."""
    value = as_col(name)
    bad = F.raise_error(F.concat(F.lit("not a number: "), value))
    return (
        F.when(value.isNull(), F.lit(None).cast(decimal_type))
        .when(value.rlike(NUMBER_PATTERN), value.try_cast(decimal_type))
        .otherwise(bad.cast(decimal_type))
    )


def classification(customer="customer_id", amount="amount") -> Column:
    return (
        F.when(as_col(customer) <= 0, F.lit("REJECTED"))
        .when(as_col(amount).isNull(), F.lit("QUARANTINED"))
        .otherwise(F.lit("ACCEPTED"))
    )


def normalized_state(status: Column | str) -> Column:
    """One of the five states; any other word, or none at all, is UNKNOWN."""
    value = as_col(status)
    branches = F.when(value.isin(*STATES), value)
    for word, state in PROVIDER_STATES.items():
        branches = branches.when(value == word, F.lit(state))
    return branches.otherwise(F.lit("UNKNOWN"))


def clipped(name: Column | str, chars: int) -> Column:
    return F.left(as_col(name).cast("string"), F.lit(chars))


def _variant_type(document: Column, field: str) -> Column:
    return F.schema_of_variant(F.variant_get(document, f"$.{field}", "variant"))


def json_has_value(document: Column, field: str) -> Column:
    """True when the object has the field and it is not JSON null."""
    return F.coalesce(_variant_type(document, field) != "VOID", F.lit(False))


def json_type_ok(document: Column, field: str, kind: str) -> Column:
    """True when the field holds a JSON value of the required kind.

    ``integer`` excludes booleans and text, ``decimal`` is a number written as
    text, ``string`` any text. A missing or null field is never of the kind.
    """
    found = _variant_type(document, field)
    if kind == "integer":
        ok = found == "BIGINT"
    elif kind == "string":
        ok = found == "STRING"
    elif kind == "decimal":
        text = F.try_variant_get(document, f"$.{field}", "string")
        ok = (found == "STRING") & text.rlike(NUMBER_PATTERN)
    else:
        raise ValueError(f"unknown JSON kind: {kind}")
    return F.coalesce(ok, F.lit(False))


def json_key(document: Column, field: str) -> Column:
    """Comparable text of a JSON value: 101 and "101" stay different, null is NULL."""
    value = F.variant_get(document, f"$.{field}", "variant")
    return F.when(json_has_value(document, field), F.to_json(value))


def run_problems(started: str, ended: str, rows: str) -> Column:
    """Codes of what no run record may state: a negative row count, an end without a start or before it."""
    begin, end = F.col(started), F.col(ended)
    return F.array_compact(F.array(
        F.when(F.col(rows) < 0, F.lit("negative_rows")), F.when(end.isNotNull() & begin.isNull(), F.lit("end_without_start")),
        F.when(end < begin, F.lit("end_before_start"))))
