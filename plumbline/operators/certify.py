"""Certify a check: run it over clean and defective variants and compare exact counts."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.contracts import QualityStatus
from plumbline.operators.previews import Shown, preview
from plumbline.session import work_dir

Tables = dict[str, DataFrame]
LABEL = "variant_id"


class ResultContract(ValueError):
    """The result of a check isn't one whole count from 0 on, named violation_count."""


def violation_count(result: DataFrame) -> int:
    """The count of a check result. Spark judges type and value: what has no exact BIGINT from 0 on is no count."""
    kinds = {f.name: f.dataType for f in result.schema}
    if list(kinds) != ["violation_count"] or not isinstance(kinds["violation_count"], T.NumericType):
        raise ResultContract(f"expected one numeric column violation_count, found {result.schema.simpleString()}")
    value = F.col("violation_count")
    whole = value.try_cast("bigint")
    found = result.select(F.when((whole >= 0) & (whole.cast("decimal(38,6)") == value.try_cast("decimal(38,6)")), whole)).take(2)
    if len(found) != 1 or found[0][0] is None:
        raise ResultContract("expected one row with a whole count from 0 on")
    return found[0][0]


def sql_check(text: str, tables: Tables) -> DataFrame:
    """An ad-hoc SELECT over named tables; blank text is a ValueError.

    The text, up to a last semicolon, runs as a subquery, so anything but a query is refused by the parser.
    """
    body = re.sub(r"\s*;?\s*$", "", text)
    if "\0" in text or body.strip() == "":
        raise ValueError("no query in the text")
    spark = next(iter(tables.values())).sparkSession
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    try:
        return spark.sql(f"SELECT * FROM (\n{body}\n) AS bounded")
    finally:
        for name in tables:
            spark.catalog.dropTempView(name)


def run_check_text(text: str, tables: Tables, **bounds: int) -> Shown:
    """The first rows of an ad-hoc check; a query that fails gives the error SQL_ERROR."""
    try:
        return preview(sql_check(text, tables), **bounds)
    except (PySparkException, Py4JJavaError):  # details of the data stay out of the result
        return Shown(error="SQL_ERROR")


def stack_variants(variants: Mapping[str, Tables], names: list[str]) -> tuple[Tables, DataFrame]:
    """All variants of each table in one DataFrame, labelled, plus the list of labels."""
    stacked: Tables = {}
    for name in names:
        for variant, tables in variants.items():
            piece = tables[name].withColumn(LABEL, F.lit(variant))
            stacked[name] = piece if name not in stacked else stacked[name].unionByName(piece)
    spark = stacked[names[0]].sparkSession
    labels = spark.createDataFrame([(v,) for v in variants], f"{LABEL} string")
    return stacked, labels


def count_variants(check: Callable, variants: Mapping[str, Tables], names: list[str]) -> DataFrame:
    """The check's count for every variant, from one grouped job."""
    stacked, labels = stack_variants(variants, names)
    return check(stacked, by=(LABEL,), labels=labels)


def near_keys(clean: Tables, domains: Mapping[str, str], more: Mapping[str, list[DataFrame]], each: int = 4) -> dict[str, DataFrame]:
    """Per key column: the lowest and highest ``each`` keys of its tables, and ``more`` keys that edits address."""
    found: dict[str, DataFrame] = {}
    for key in dict.fromkeys(domains.values()):
        ends = []
        for table in (t for t, k in domains.items() if k == key):
            keys = clean[table].select(key).where(F.col(key).isNotNull()).distinct()
            ends += [keys.orderBy(F.col(key)).limit(each), keys.orderBy(F.col(key).desc()).limit(each)]
        found[key] = reduce(DataFrame.unionByName, [*ends, *more.get(key, [])]).distinct()
    return found


def count_by_difference(check: Callable, clean: Tables, domains: Mapping[str, str], more: Mapping[str, list[DataFrame]],
                        variants: Callable[[Tables], Mapping[str, Tables]], labels: list[str]) -> DataFrame:
    """The check's count for every variant, where the check is a sum over keys and every edit touches few of them.

    The clean tables are counted once. Variants are made of the rows of the keys near the edits only (``domains`` tells the key
    of each table; other tables stay whole), and a variant's count is the clean one, less that of the clean rows near by,
    plus that of the edited rows near by. The cost of a variant is that of the touched keys, whatever the size of the tables.
    """
    spark = next(iter(clean.values())).sparkSession
    folder = work_dir(spark, "near")
    near = dict(clean)
    for key, keys in near_keys(clean, domains, more).items():
        listed = spark.createDataFrame(keys.collect(), keys.schema)
        for table in (t for t, k in domains.items() if k == key):
            clean[table].join(F.broadcast(listed), key, "left_semi").select(*clean[table].columns).write.parquet(f"{folder}/{table}")
            near[table] = spark.read.schema(clean[table].schema).parquet(f"{folder}/{table}")
    before = "the clean rows"
    names = list(domains) + [t for t in clean if t not in domains]
    found = count_variants(check, {before: near, **variants(near)}, names)
    whole = check(clean).select(F.col("violation_count").alias("whole"))
    rest = found.where(F.col(LABEL) == before).select("violation_count").scalar()
    return found.where(F.col(LABEL) != before).select(
        LABEL, (whole.select("whole").scalar() - rest + F.col("violation_count")).alias("violation_count"))


@dataclass(frozen=True)
class Case:
    variant: str
    status: QualityStatus
    count: int | None
    expected: int


def overall(cases: list[Case]) -> QualityStatus:
    found = {c.status for c in cases}
    for status in (QualityStatus.ERROR, QualityStatus.FAIL):
        if status in found:
            return status
    return QualityStatus.PASS


def certify(check: Callable, variants: Mapping[str, Tables], names: list[str], expected: Mapping[str, int]) -> list[Case]:
    """Exact comparison per variant. If the grouped job fails, the variants run one by one."""
    try:
        counts: dict = {r[LABEL]: r.violation_count for r in count_variants(check, variants, names).collect()}
    except Exception:  # noqa: BLE001 - isolate the variant that cannot be evaluated
        counts = {}
        for variant, tables in variants.items():
            try:
                counts[variant] = check(tables).first().violation_count
            except Exception:  # noqa: BLE001
                counts[variant] = None
    return [_case(v, counts.get(v), expected[v]) for v in variants]


def certify_text(text: str, variants: Mapping[str, Tables], expected: Mapping[str, int]) -> list[Case]:
    """Certify an ad-hoc SQL check, one variant after another."""
    cases = []
    for variant, tables in variants.items():
        try:
            cases.append(_case(variant, violation_count(sql_check(text, tables)), expected[variant]))
        except ResultContract:
            cases.append(Case(variant, QualityStatus.FAIL, None, expected[variant]))
        except Exception:  # noqa: BLE001
            cases.append(Case(variant, QualityStatus.ERROR, None, expected[variant]))
    return cases


def _case(variant: str, count: int | None, expected: int) -> Case:
    if count is None:
        return Case(variant, QualityStatus.ERROR, None, expected)
    status = QualityStatus.PASS if count == expected else QualityStatus.FAIL
    return Case(variant, status, count, expected)


def judged(counts: DataFrame, expected: DataFrame) -> DataFrame:
    """Counts beside the independently stated ones, with a status per variant."""
    joined = expected.join(counts.select(LABEL, "violation_count"), LABEL, "left")
    status = (
        F.when(F.col("violation_count").isNull(), F.lit("ERROR"))
        .when(F.col("violation_count") == F.col("expected_count"), F.lit("PASS"))
        .otherwise(F.lit("FAIL"))
    )
    return joined.withColumn("status", status)


def cases_frame(spark: SparkSession, cases: list[Case]) -> DataFrame:
    rows = [(c.variant, str(c.status), c.count, c.expected) for c in cases]
    return spark.createDataFrame(rows, "variant_id string, status string, violation_count bigint, expected_count bigint")
