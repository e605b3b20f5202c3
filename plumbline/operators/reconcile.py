"""Reconciliation of two row sets by key.

Joined row pairs are counted, never produced. Both sides are stacked, equal rows
are collapsed by a partial aggregation before the shuffle, and the number of
joined pairs that agree or differ follows from the per-key row counts:

    differing pairs = expected rows x actual rows - sum(equal copies on both sides)

A key that holds a large share of the rows is therefore spread over the tasks by
the first shuffle (it includes the compared fields) and reaches the second one as
one partial row per task. The result equals that of the corresponding full outer
or inner join, duplicates and NULL keys included.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.exprs import any_of
from plumbline.operators.scope import By, sum_of


def _tagged(df: DataFrame, columns: Sequence[str], expected: int, actual: int) -> DataFrame:
    return df.select(*columns, F.lit(expected).alias("n_expected"), F.lit(actual).alias("n_actual"))


def stack_sides(expected: DataFrame, actual: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Both sides collapsed to distinct rows with their multiplicity on each side."""
    both = _tagged(expected, columns, 1, 0).unionByName(_tagged(actual, columns, 0, 1))
    return both.groupBy(*columns).agg(
        F.sum("n_expected").cast("bigint").alias("n_expected"),
        F.sum("n_actual").cast("bigint").alias("n_actual"),
    )


def key_counts(
    expected: DataFrame, actual: DataFrame, keys: Sequence[str], fields: Sequence[str] = (), by: By = (),
    absent: str | None = None,
) -> DataFrame:
    """Per key: rows on each side and joined pairs whose fields all agree.

    ``absent`` names a compared field whose NULLs on the actual side are counted
    along as ``n_absent``.
    """
    grouping = [*by, *keys]
    rows = stack_sides(expected, actual, [*grouping, *fields])
    extra = []
    if absent:
        extra = [F.coalesce(F.sum(F.when(F.col(absent).isNull(), F.col("n_actual"))), F.lit(0)).alias("n_absent")]
    if not fields:
        return rows.withColumn("n_equal", F.col("n_expected") * F.col("n_actual"))
    return rows.groupBy(*grouping).agg(
        F.sum("n_expected").alias("n_expected"),
        F.sum("n_actual").alias("n_actual"),
        F.sum(F.col("n_expected") * F.col("n_actual")).alias("n_equal"),
        *extra,
    )


def _null_key(keys: Sequence[str]) -> Column:
    return any_of(F.col(k).isNull() for k in keys)


# Values of one key, from its counts. Sums over keys give the reports below.

def differing_pairs(keys: Sequence[str]) -> Column:
    """Joined pairs with a difference; NULL keys never join."""
    pairs = F.col("n_expected") * F.col("n_actual") - F.col("n_equal")
    return F.when(_null_key(keys), F.lit(0)).otherwise(pairs)


def unmatched_rows(keys: Sequence[str]) -> Column:
    """Rows without a partner on the other side."""
    alone = _null_key(keys) | (F.col("n_expected") == 0) | (F.col("n_actual") == 0)
    return F.when(alone, F.col("n_expected") + F.col("n_actual")).otherwise(F.lit(0))


def difference(keys: Sequence[str]) -> Column:
    """Rows a full outer join flags: absent on one side, or any field distinct."""
    return unmatched_rows(keys) + differing_pairs(keys)


def missing_key() -> Column:
    return (F.col("n_actual") == 0).cast("bigint")


def unexpected_key() -> Column:
    return (F.col("n_expected") == 0).cast("bigint")


def duplicate_key() -> Column:
    """The key occurs more than once on the actual side; NULL keys form one group."""
    return (F.col("n_actual") > 1).cast("bigint")


def diff_by_key(expected, actual, keys, fields=(), by: By = ()) -> DataFrame:
    """Per key: unmatched rows and differing pairs, as a full outer join would report."""
    return key_counts(expected, actual, keys, fields, by).select(
        *by, *keys,
        unmatched_rows(keys).alias("unmatched"),
        differing_pairs(keys).alias("differing"),
    )


def diff_count(expected, actual, keys, fields=(), by: By = (), name: str = "n") -> DataFrame:
    """Rows a full outer join would flag."""
    return sum_of(key_counts(expected, actual, keys, fields, by), by, **{name: difference(keys)})


def diff_and_duplicates(expected, actual, keys, fields, diff: str, duplicates: str, by: By = ()) -> DataFrame:
    """Full-join differences and duplicated actual keys, from the same per-key counts."""
    per_key = key_counts(expected, actual, keys, fields, by)
    return sum_of(per_key, by, **{diff: difference(keys), duplicates: duplicate_key()})


def inner_mismatch_count(expected, actual, keys, fields, by: By = (), name: str = "n") -> DataFrame:
    """Rows an inner join would flag: both sides present and any field distinct."""
    return sum_of(key_counts(expected, actual, keys, fields, by), by, **{name: differing_pairs(keys)})


def key_presence(source: DataFrame, target: DataFrame, keys: Sequence[str], by: By = ()) -> DataFrame:
    """Distinct keys with the side(s) they occur on; NULL keys compare equal."""
    columns = [*by, *keys]
    tagged = source.select(*columns, F.lit(True).alias("s"), F.lit(False).alias("t")).unionByName(
        target.select(*columns, F.lit(False).alias("s"), F.lit(True).alias("t"))
    )
    return tagged.groupBy(*columns).agg(F.bool_or("s").alias("in_source"), F.bool_or("t").alias("in_target"))


def key_difference(source, target, keys, by: By = ()) -> DataFrame:
    """Keys on one side only, each once, with the kind of difference."""
    one_sided = key_presence(source, target, keys, by).where(F.col("in_source") != F.col("in_target"))
    kind = F.when(F.col("in_source"), F.lit("MISSING_KEY")).otherwise(F.lit("UNEXPECTED_KEY"))
    return one_sided.select(*by, kind.alias("kind"), *keys)


def duplicate_groups(df: DataFrame, keys: Sequence[str], by: By = ()) -> DataFrame:
    """Keys that occur more than once; NULL keys form one group."""
    return df.groupBy(*by, *keys).agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")


def duplicate_count(df: DataFrame, keys: Sequence[str], by: By = (), name: str = "n") -> DataFrame:
    """Number of duplicated keys."""
    return duplicate_groups(df, keys, by).groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def duplicate_summary(df: DataFrame, keys: Sequence[str], by: By = ()) -> DataFrame:
    """Duplicated keys and the rows beyond the first of each."""
    return duplicate_groups(df, keys, by).groupBy(*by).agg(
        F.count(F.lit(1)).alias("duplicate_groups"),
        F.coalesce(F.sum(F.col("occurrences") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def field_rows(source: DataFrame, target: DataFrame, keys: Sequence[str], mappings: Sequence[tuple[str, str]]):
    """Stacked distinct rows with the compared columns renamed ``f0..fN``."""
    names = [f"f{i}" for i in range(len(mappings))]
    left = source.select(*keys, *[F.col(s).alias(n) for (s, _), n in zip(mappings, names)])
    right = target.select(*keys, *[F.col(t).alias(n) for (_, t), n in zip(mappings, names)])
    return stack_sides(left, right, [*keys, *names]), names


def _key_profile(rows: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Per key: rows and distinct rows per side, and the values of one row per side."""
    def side(count: str, name: str) -> Column:
        return F.max(F.when(F.col(count) > 0, F.col(name)))

    return rows.groupBy(*keys).agg(
        F.sum("n_expected").alias("n_expected"),
        F.sum("n_actual").alias("n_actual"),
        F.count_if(F.col("n_expected") > 0).alias("d_expected"),
        F.count_if(F.col("n_actual") > 0).alias("d_actual"),
        *[side("n_expected", n).alias(f"e_{n}") for n in names],
        *[side("n_actual", n).alias(f"a_{n}") for n in names],
    )


def _settled() -> Column:
    return (F.col("d_expected") <= 1) & (F.col("d_actual") <= 1)


def _simple_mismatch(keys: Sequence[str], name: str) -> Column:
    """Differing joined cells of a key with at most one distinct row per side."""
    differs = ~F.col(f"e_{name}").eqNullSafe(F.col(f"a_{name}"))
    pairs = F.col("n_expected") * F.col("n_actual")
    return F.when(_settled() & differs & ~_null_key(keys), pairs).otherwise(F.lit(0))


def _disagreeing_values(rows: DataFrame, profile: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Per key whose copies disagree with each other, field and value: its rows on each side.

    ``cell`` is a struct in which the field's own slot is filled.
    """
    unsettled = profile.where(~_settled() & (F.col("n_expected") * F.col("n_actual") > 0) & ~_null_key(keys))
    remaining = rows.join(unsettled.select(*keys), list(keys), "left_semi")
    cells = F.array(*[
        F.struct(F.lit(i).alias("field"), _slot(rows, names, i, n).alias("cell")) for i, n in enumerate(names)])
    spread = remaining.select(*keys, "n_expected", "n_actual", F.explode(cells).alias("of"))
    return spread.select(*keys, "n_expected", "n_actual", "of.*").groupBy(*keys, "field", "cell").agg(
        F.sum("n_expected").alias("n_expected"), F.sum("n_actual").alias("n_actual"))


def _slot(rows: DataFrame, names: Sequence[str], place: int, column: str) -> Column:
    """A struct of all compared fields in which only one is filled, from ``column``."""
    return F.struct(*[
        (F.col(column) if j == place else F.lit(None).cast(rows.schema[n].dataType)).alias(n) for j, n in enumerate(names)])


def pair_report(source: DataFrame, target: DataFrame, keys: Sequence[str], mappings: Sequence[tuple[str, str]],
                evidence: int = 0) -> DataFrame:
    """One row of counts for a pair of datasets and, where asked for, the first differing cells of each field.

    Both come from one stacked pass over both sides. ``missing_count`` and ``unexpected_count`` compare distinct keys
    null-safely; ``m0..mN`` count differing joined cells per field; the duplicate counts are those of each side by the
    same key. With ``evidence``, further rows (whose counts are NULL) have ``field``, ``key``, ``expected`` and ``actual`` of the
    first so many cells of each field; see :func:`_first_cells`.
    """
    rows, names = field_rows(source, target, keys, mappings)
    profile = _key_profile(rows, keys, names)
    counts = {
        "missing_count": missing_key(), "unexpected_count": unexpected_key(),
        "source_groups": (F.col("n_expected") > 1).cast("bigint"),
        "source_rows": F.greatest(F.col("n_expected") - 1, F.lit(0)),
        "target_groups": duplicate_key(), "target_rows": F.greatest(F.col("n_actual") - 1, F.lit(0)),
    }
    settled = sum_of(profile, **counts, **{f"m{i}": _simple_mismatch(keys, n) for i, n in enumerate(names)})
    if not names:
        return settled
    values = _disagreeing_values(rows, profile, keys, names)
    valued = values.groupBy(*keys, "field").agg(
        (F.sum("n_expected") * F.sum("n_actual") - F.sum(F.col("n_expected") * F.col("n_actual"))).alias("m"))
    rest = sum_of(valued, **{f"m{i}": F.when(F.col("field") == i, F.col("m")) for i in range(len(names))})
    stacked = settled.unionByName(rest, allowMissingColumns=True)
    report = stacked.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in settled.columns])
    if not evidence:
        return report
    return report.unionByName(_first_cells(rows, profile, values, keys, names, evidence), allowMissingColumns=True)


def _first_cells(rows: DataFrame, profile: DataFrame, values: DataFrame, keys: Sequence[str], names: Sequence[str], most: int) -> DataFrame:
    """The first ``most`` differing cells of every field, by key, then by expected and actual value, copies one by one.

    A key whose rows agree on each side has one value a side. Of the others ``most + 1`` values a side are enough to yield every
    cell asked for. Limits are on row numbers, which Spark applies in each task before its shuffle: whatever the number of
    differing keys or of a key's values, a task sends no more than the limit on.
    """
    def one(i: int, count: str, side: str) -> Column:
        return F.array(F.struct(_slot(rows, names, i, f"{side}_{names[i]}").alias("cell"), F.col(count).alias("n")))

    single = F.array_compact(F.array(*[
        F.when(_simple_mismatch(keys, name) > 0, F.struct(
            F.lit(i).alias("field"), one(i, "n_expected", "e").alias("e"), one(i, "n_actual", "a").alias("a")))
        for i, name in enumerate(names)]))
    simple = profile.select(*keys, F.explode(single).alias("of")).select(*keys, "of.*")

    sides = values.select(*keys, "field", "cell", F.explode(F.array(
        F.struct(F.lit("e").alias("side"), F.col("n_expected").alias("n")), F.struct(F.lit("a").alias("side"), F.col("n_actual").alias("n")),
    )).alias("of")).select(*keys, "field", "cell", "of.*").where("n > 0")
    nth = F.row_number().over(Window.partitionBy(*keys, "field", "side").orderBy("cell"))
    few = sides.withColumn("nth", nth).where(F.col("nth") <= most + 1)
    held = F.struct("cell", "n")
    several = few.groupBy(*keys, "field").agg(*[
        F.sort_array(F.collect_list(F.when(F.col("side") == s, held))).alias(s) for s in ("e", "a")])
    alike = (F.size("e") == 1) & (F.size("a") == 1) & F.col("e")[0]["cell"].eqNullSafe(F.col("a")[0]["cell"])
    differing = simple.unionByName(several.where(~alike))

    order = [F.col(k).asc_nulls_last() for k in keys]
    by_key = F.row_number().over(Window.partitionBy("field").orderBy(*order))
    first = differing.withColumn("place", by_key).where(F.col("place") <= most)
    crossed = first.select(*keys, "field", F.explode("e").alias("x"), "a").select(*keys, "field", "x", F.explode("a").alias("y")).where(
        ~F.col("x.cell").eqNullSafe(F.col("y.cell")))
    copies = F.sequence(F.lit(1).cast("bigint"), F.least(F.col("x.n") * F.col("y.n"), F.lit(most).cast("bigint")))
    cells = crossed.select(
        *keys, "field", F.col("x.cell").alias("expected"), F.col("y.cell").alias("actual"), F.explode(copies).alias("copy"))
    turn = F.row_number().over(Window.partitionBy("field").orderBy(*order, "expected", "actual"))
    return cells.withColumn("turn", turn).where(F.col("turn") <= most).select(
        "field", "turn", F.struct(*keys).alias("key"), "expected", "actual")


def weighted_left_violations(left, right, left_keys, right_keys, left_bad, right_bad, by: By = (),
                             name: str = "n") -> DataFrame:
    """Rows of ``left LEFT JOIN right`` that are bad on either side or unmatched.

    Both sides are first reduced to counts per join key, so the join carries one
    row per key whatever the number of copies.
    """
    names = [f"k{i}" for i in range(len(left_keys))]
    lhs = left.select(
        *by, *[F.col(c).alias(n) for c, n in zip(left_keys, names)], F.coalesce(left_bad, F.lit(False)).alias("bad")
    ).groupBy(*by, *names).agg(F.count_if("bad").alias("l_bad"), F.count_if(~F.col("bad")).alias("l_good"))
    rhs = right.select(
        *by, *[F.col(c).alias(n) for c, n in zip(right_keys, names)], F.coalesce(right_bad, F.lit(False)).alias("bad")
    ).groupBy(*by, *names).agg(F.count(F.lit(1)).alias("r_rows"), F.count_if("bad").alias("r_bad"))
    joined = lhs.join(rhs, [*by, *names], "left")
    n = (
        F.when(F.col("r_rows").isNull(), F.col("l_bad") + F.col("l_good"))
        .otherwise(F.col("l_bad") * F.col("r_rows") + F.col("l_good") * F.col("r_bad"))
    )
    return sum_of(joined, by, **{name: n})
