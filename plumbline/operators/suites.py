"""Suites of rules judged as tables: any number of suites in one job."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.contracts import EVIDENCE_BOUND

# How ids and columns may be spelled, the kinds that compare two datasets, and those that name columns.
PLAIN = "^[a-z_][a-z0-9_]*$"
PAIRED = ("KEY_RECONCILIATION", "FIELD_RECONCILIATION")
WITH_COLUMNS = ("UNIQUENESS", "NOT_NULL", "SCHEMA", *PAIRED)


def catalog_problems(catalog: DataFrame) -> DataFrame:
    """``dataset_id`` and ``problem`` of ids that aren't plain names or stand for several tables."""
    tables = catalog.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("n"))
    problems = F.array_compact(F.array(
        F.when(F.col("n") > 1, F.lit("dataset id used again")), F.when(~_plain("dataset_id"), F.lit("dataset id is not a plain name"))))
    return tables.select("dataset_id", F.explode(problems).alias("problem"))


def _plain(column: str) -> Column:
    return F.coalesce(F.col(column).rlike(PLAIN), F.lit(False))


def suite_problems(rules: DataFrame, datasets: DataFrame, columns: DataFrame, catalog: DataFrame) -> DataFrame:
    """``suite_id``, ``place`` and ``problem`` of everything that makes a suite unfit to run; none for a sound one.

    ``rules`` has suite_id, place (of the rule in its suite), rule_id, kind and evidence; ``datasets`` and ``columns`` have one row per
    dataset and column that a rule names, by suite_id and place. A problem of the suite itself has no place. Repeated
    ids are told from counts, so a suite of any size is judged without bringing its rules together.
    """
    on = ["suite_id", "place"]
    found = [rules.where(~_plain("suite_id")).select("suite_id").distinct().select(
        "suite_id", F.lit(None).cast("bigint").alias("place"), F.lit("suite id is not a plain name").alias("problem"))]

    paired, wants_columns = F.col("kind").isin(*PAIRED), F.col("kind").isin(*WITH_COLUMNS)
    blank = F.coalesce(F.trim("rule_id") == "", F.lit(True))
    in_bounds = F.coalesce(F.col("evidence").between(1, EVIDENCE_BOUND), F.lit(False))
    own = F.array_compact(F.array(
        F.when(blank, F.lit("blank rule id")), F.when(paired & ~in_bounds, F.lit(f"evidence is not between 1 and {EVIDENCE_BOUND}"))))
    found.append(rules.select(*on, F.explode(own).alias("problem")))

    ids = rules.where(~blank).groupBy("suite_id", "rule_id").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = rules.join(ids, ["suite_id", "rule_id"]).where(F.col("place") > F.col("first"))
    found.append(later.select(*on, F.lit("rule id used again").alias("problem")))

    absent = datasets.join(catalog.select("dataset_id").distinct(), "dataset_id", "left_anti")
    found.append(absent.select(*on, F.concat(F.lit("no such dataset: "), "dataset_id").alias("problem")))
    named = datasets.groupBy(*on).agg(F.count(F.lit(1)).alias("n"))
    sides = rules.join(named, on, "left").where(F.coalesce("n", F.lit(0)) != F.when(paired, 2).otherwise(1))
    found.append(sides.select(*on, F.lit("wrong number of datasets").alias("problem")))

    per_column = columns.groupBy(*on, "column_name").agg(F.count(F.lit(1)).alias("n"))
    per_rule = per_column.groupBy(*on).agg(F.max("n").alias("most"), F.bool_and(_plain("column_name")).alias("plain"))
    judged = rules.where(wants_columns).join(per_rule, on, "left")
    problems = F.array_compact(F.array(
        F.when(F.col("most").isNull(), F.lit("no columns")), F.when(F.col("most") > 1, F.lit("column used again")),
        F.when(~F.col("plain"), F.lit("column is not a plain name"))))
    found.append(judged.select(*on, F.explode(problems).alias("problem")))
    return reduce(DataFrame.unionByName, found)
