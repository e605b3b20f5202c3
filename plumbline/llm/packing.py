"""Length buckets with the least padding, and batches under a token budget."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.sharding import PART_ROWS, part_bits
from plumbline.llm.storage import ranked, written

LENGTHS = 1 << 22  # distinct lengths at most; their texts would have 8.8 * 10 ** 12 tokens


def byte_tokens(text: str) -> Column:
    """Tokens of a byte-level vocabulary: the UTF-8 bytes and one end."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def optimal_bounds(lengths: np.ndarray, rows: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` runs of the ascending ``lengths`` that pad the ``rows`` least.

    Dynamic programming: the cheapest cover of the first j lengths by b buckets extends one of the
    first i by b - 1; a bucket costs its rows times its greatest length (the real tokens are the same in any cover).
    Seen from the greatest length x, the cover of the first i is the line cost[i] - x * upto[i]: lines fall steeper with i
    and x rises with j, so the lower hull gives every best i in turn, and a bucket more costs one pass. Integers, so exact.
    """
    tops, n = [int(x) for x in lengths], len(lengths)
    upto = [0, *(int(x) for x in np.cumsum(rows))]
    cost: list[int | None] = [0] + [None] * n
    came = []
    for _ in range(min(buckets, n)):
        best, at, hull, first = [0] + [None] * n, np.zeros(n + 1, np.int32), [], 0
        for j in range(1, n + 1):
            i, x = j - 1, tops[j - 1]
            if cost[i] is not None:
                while len(hull) - first > 1 and (cost[i] - cost[hull[-2]]) * (upto[hull[-1]] - upto[hull[-2]]) <= (
                        cost[hull[-1]] - cost[hull[-2]]) * (upto[i] - upto[hull[-2]]):
                    hull.pop()
                hull.append(i)
            while len(hull) - first > 1 and cost[hull[first + 1]] - x * upto[hull[first + 1]] < cost[hull[first]] - x * upto[hull[first]]:
                first += 1
            at[j] = start = hull[first]
            best[j] = cost[start] + x * (upto[j] - upto[start])
        came.append(at)
        cost = best
    out, j = [], n
    for at in reversed(came):
        if j:
            out.append(tops[j - 1])
            j = int(at[j])
    return out[::-1]


def length_bounds(lengths: DataFrame, column: str, buckets: int) -> list[int]:
    """Bucket bounds with the least padding, from the rows of every distinct length, however long the longest text is.

    One row per distinct length comes to the driver. A table with more than ``LENGTHS`` of them stops the job: as distinct lengths add
    up to no more than all tokens, that takes more than LENGTHS ** 2 / 2 tokens.
    """
    counts = written(lengths.groupBy(F.col(column).alias("top")).agg(F.count(F.lit(1)).alias("rows")), "length-counts")
    if counts.count() > LENGTHS:
        raise ValueError(f"more than {LENGTHS} distinct lengths")
    found = counts.select(F.col("top").cast("long"), "rows").sort("top").toArrow()
    return optimal_bounds(found["top"].to_numpy(), found["rows"].to_numpy(), buckets)


def packed(
    docs: DataFrame, budget: int = 65_536, buckets: int = 8, seed: int = 7, key: str = "doc_id", text: str = "text",
    length: Column | None = None, part_rows: int = PART_ROWS,
) -> DataFrame:
    """Every row's length bucket, batch and slot.

    ``bucket`` (from 0) pads to ``padded`` tokens, the greatest length in it. Its rows, shuffled by a seeded hash, fill
    batches of ``budget div padded`` rows (one at least: a longer text is a batch of its own, never cut). ``batch`` counts
    within the bucket, ``slot`` within the batch. ``length`` defaults to UTF-8 bytes and one end; a null or empty text has
    one token. Null keys and repeated rows are rows like others; an empty table gives no rows. Other columns are not
    read. No task ranks more than one part of a bucket.
    """
    rows = docs.select(F.col(key).alias("doc_id"), (byte_tokens(text) if length is None else length).alias("n_tokens"))
    bounds = length_bounds(rows, "n_tokens", buckets)
    ends = F.array(*[F.lit(b).cast("long") for b in bounds or [0]])
    rows = rows.withColumn("bucket", F.size(F.filter(ends, lambda b: b < F.col("n_tokens")))).withColumn(
        "padded", F.element_at(ends, F.col("bucket") + 1)).withColumn("turn", F.xxhash64(F.lit(seed), "doc_id"))
    bits = part_bits(docs.count(), part_rows)
    order = [F.col(c) for c in ("turn", "doc_id", "n_tokens")]
    placed = ranked(rows, ["bucket"], F.shiftrightunsigned("turn", 64 - bits).cast("int"), order, "place", "bucket_rows")
    each = F.expr(f"greatest(1L, {budget} div padded)")
    return placed.withColumn("each", each).select(
        F.col("doc_id").alias(key), "n_tokens", "bucket", "padded", F.expr("place div each").alias("batch"),
        F.expr("cast(place % each as int)").alias("slot"), (F.col("padded") - F.col("n_tokens")).alias("padding"), "bucket_rows")
