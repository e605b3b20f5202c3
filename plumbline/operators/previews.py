"""Ordered, bounded results: evidence rows, previews, subsets."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.exprs import clipped


def first_rows(df: DataFrame, order: Sequence[str], limit: int) -> DataFrame:
    """The first rows by ``order``, NULLs last; each task keeps at most ``limit``."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(limit)


def latest_success(runs: DataFrame) -> DataFrame:
    """The most recently started run that succeeded."""
    done = runs.where(F.col("execution_status") == "SUCCESS")
    return done.orderBy(F.col("started_at").desc_nulls_first(), F.col("run_id").desc()).limit(1)


def kth_smallest(df: DataFrame, key: str, k: int, ranges: int = 4096) -> int:
    """The k-th smallest value of an integer column, duplicates counted.

    The value range is split into equal parts, each part's rows are counted in a
    distributed aggregation, and the part holding the k-th row is split again. A
    step returns at most ``ranges`` counts; six steps cover every 64-bit range.
    """
    bounds = df.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    lo, hi = bounds.lo, bounds.hi
    if lo is None:
        raise ValueError(f"{key} has no values")
    while lo < hi:
        width = -(-(hi - lo + 1) // ranges)
        part = F.expr(f"(cast({key} as decimal(20,0)) - {lo}BD) div {width}BD")
        inside = df.where(F.col(key).between(lo, hi)).groupBy(part.alias("part"))
        for row in inside.agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect():
            if k <= row.n:
                lo, hi = lo + row.part * width, min(hi, lo + (row.part + 1) * width - 1)
                break
            k -= row.n
        else:
            raise ValueError("fewer rows than asked for")
    return lo


def half_subset(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among the lower half of the rows, at least one row."""
    rows = df.where(F.col(key).isNotNull()).count()
    return df.where(F.col(key) <= F.lit(kth_smallest(df, key, max(1, rows // 2))))


# What a preview shows unless its caller says otherwise.
ROWS, COLUMNS, CHARS, SIZE = 100, 20, 2_048, 65_536


@dataclass(frozen=True)
class Shown:
    """What a preview shows: text cells, and whether anything is cut. A preview with an error shows nothing."""

    columns: tuple[str, ...] = ()
    rows: tuple[tuple[str | None, ...], ...] = ()
    truncated: bool = False
    error: str | None = None


def preview_frame(df: DataFrame, rows: int = ROWS, chars: int = CHARS) -> DataFrame:
    """Text cells, one character and one row more than is shown, so that cuts are noticed."""
    return df.select(*[clipped(f"`{c}`", chars + 1).alias(c) for c in df.columns]).limit(rows + 1)


def preview(df: DataFrame, rows: int = ROWS, columns: int = COLUMNS, chars: int = CHARS, size: int = SIZE) -> Shown:
    """The first rows as text, up to ``rows`` of them and ``size`` bytes of JSON; any cut is flagged."""
    if min(rows, columns, chars, size) < 1:
        raise ValueError("a preview shows one row, column, character and byte at least")
    if len(df.columns) > columns:
        return Shown(error="COLUMN_LIMIT")
    found = preview_frame(df, rows, chars).collect()
    cut = [tuple(v if v is None else v[:chars] for v in row) for row in found]
    filled = accumulate(len(json.dumps(row, ensure_ascii=False).encode()) + 2 for row in cut)
    room = size - len(json.dumps(df.columns, ensure_ascii=False).encode())
    kept = tuple(row for row, upto in zip(cut[:rows], filled, strict=False) if upto <= room)
    return Shown(tuple(df.columns), kept, len(kept) < len(found) or any(tuple(r) != c for r, c in zip(found, kept, strict=False)))
