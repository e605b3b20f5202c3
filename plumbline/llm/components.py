"""Connected components of an edge list: contracted inside tasks first, then by alternating star contractions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.storage import written

TASK_EDGES = 1 << 19  # that one task contracts together


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node of the edges but the smallest of its component, with that smallest one.

    Each round hooks the larger of two different roots to the smaller one, and shortens all paths to their ends.
    """
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = place[:len(a)], place[len(a):]
    root = np.arange(len(nodes))
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            break
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            further = root[root]
            if np.array_equal(further, root):
                break
            root = further
    own = root != np.arange(len(nodes))
    return nodes[own], nodes[root[own]]


def _contracted(batches):
    """The edges of a task as stars, contracted whenever ``TASK_EDGES`` have come together; what is still as large goes out."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    count = 0

    def out(a, b):
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    def merged():
        return stars(*(np.concatenate(side) for side in zip(*held, strict=True)))

    for batch in batches:
        held.append(tuple(batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("a", "b")))
        count += batch.num_rows
        if count >= TASK_EDGES:
            held = [merged()]
            count = len(held[0][0])
            if 2 * count >= TASK_EDGES:
                yield out(*held[0])
                held, count = [], 0
    if held:
        yield out(*merged())


def contracted(edges: DataFrame) -> DataFrame:
    """The same components with the edges of each task as stars."""
    return edges.mapInArrow(_contracted, "a long, b long")


def components(edges: DataFrame, purpose: str, max_rounds: int = 60) -> DataFrame:
    """(node, root) for the ends of ``edges`` (a long, b long); the root is the smallest node reachable.

    Edges are written, so that the functions that find them are done, and contracted where they lie before anything is shuffled; null
    ends and loops are dropped. While more than ``TASK_EDGES`` are left, each round links every
    larger neighbour of a node, then every smaller one, to the smallest (Kiveris et al., 2014), and contracts what a task gets.
    Work per round is a group-by and a join on the node. No more edges than that meet in one task, in the last one neither.
    Ends when a round changes nothing.
    """
    def sign(frame: DataFrame) -> tuple:
        return tuple(frame.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    now = written(contracted(written(edges.where("a <> b").select("a", "b"), purpose)), purpose)
    mark = sign(now)
    for _ in range(max_rounds):
        if mark[0] <= TASK_EDGES:
            now = written(contracted(now.coalesce(1)), purpose)
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, F.col("a") == F.col("k")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a > b").distinct()
        smallest = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), "m")
        small = large.join(smallest, F.col("a") == F.col("k"))
        step = small.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").unionByName(
            smallest.select(F.col("k").alias("a"), F.col("m").alias("b")))
        now = written(contracted(written(step.distinct(), purpose)), purpose)
        before, mark = mark, sign(now)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root")))
