"""Hard negatives by exact inner products: residues multiplied in float32, put together by Chinese remaindering."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.storage import bounded_batches, written

DEPTH = 64  # components whose residue products are added before they are reduced again
# Primes below 2**10. A residue is at most 510 in size, so DEPTH products stay below 2**24 and float32 holds them exactly.
PRIMES = (1021, 1019, 1013, 1009, 997, 991)
ANCHOR_BLOCK = 1 << 10  # anchors in one block
ROW_BLOCK = 1 << 12  # rows in one block
TILE = 1 << 11  # rows of a block that are scored at a time
SCORES = 1 << 28  # that one task computes, about, where there are more
LEAST = 1 << 22  # scores that are worth a task of their own


class Residues:
    """Exact products of integer matrices whose results are at most ``bound`` in size."""

    def __init__(self, bound: int):
        self.primes, product = [], 1
        for prime in PRIMES:
            if product > 2 * bound:
                break
            self.primes.append(prime)
            product *= prime
        if product <= 2 * bound:
            raise ValueError(f"scores up to {bound} don't fit: the primes tell apart {product} values")
        self.product = product

    def split(self, whole: np.ndarray) -> list[np.ndarray]:
        """One float32 matrix a prime: residues in -p/2 .. p/2."""
        return [((whole + p // 2) % p - p // 2).astype(np.float32) for p in self.primes]

    def multiply(self, left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
        """The signed 64-bit inner products of all rows of ``left`` with all rows of ``right``."""
        total, scale = None, 1
        for p, a, b in zip(self.primes, left, right, strict=True):
            rest = np.zeros((len(a), len(b)), np.int64)
            for at in range(0, a.shape[1], DEPTH):
                rest += (a[:, at:at + DEPTH] @ b[:, at:at + DEPTH].T).astype(np.int64)
            if total is None:
                total = rest % p
            else:  # the digit of this prime in the mixed-radix number
                rest -= total
                rest *= pow(scale, -1, p)
                rest %= p
                rest *= scale
                total += rest
            scale *= p
        total[total > self.product // 2] -= self.product
        return total


def components(table: DataFrame, key: str, vector: str, label: str, scale: int = 256) -> DataFrame:
    """``row_no``, ``vec_id``, ``label`` and ``whole`` (array of long: floor of ``scale`` times each component) of rows that take part.

    Rows with a null label, a null vector, or a null or non-finite component take no part.
    """
    x = F.col(vector)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) != float("inf")))
    usable = table.where(F.col(label).isNotNull() & x.isNotNull()).where(finite)
    return usable.select(
        F.monotonically_increasing_id().alias("row_no"), F.col(key).alias("vec_id"), F.col(label).cast("long").alias("label"),
        F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double"))).alias("whole"))


def _blocks(size: int, width: int, extra: tuple[str, ...]):
    """Rows packed into blocks: each column's numbers as bytes, vectors as 32-bit integers, zeros behind shorter ones."""
    def packed(table: pa.Table) -> list:
        lists = table.column("whole").combine_chunks()
        lengths = np.array([len(v) for v in lists], np.int64)
        matrix = np.zeros((len(lists), width), np.int32)
        matrix[np.repeat(np.arange(len(lists)), lengths), np.concatenate([np.arange(n) for n in lengths])] = lists.flatten().to_numpy()
        names = ("row_no", "vec_id", "label", *extra)
        # null ids and scores come as the largest number: they order last and are told from others when read back
        numbers = [table.column(n).fill_null(np.iinfo(np.int64).max).to_numpy().astype(np.int64) for n in names]
        return [len(matrix), *[n.tobytes() for n in numbers], matrix.tobytes()]

    def run(batches):
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, size - rows)
                held.append(part)
                rows += part.num_rows
                batch = batch.slice(part.num_rows)
                if rows == size:
                    yield record(held)
                    held, rows = [], 0
        if held:
            yield record(held)

    def record(held):
        values = packed(pa.Table.from_batches(held))
        kinds = [pa.int64(), *[pa.binary()] * (len(values) - 1)]
        names = ["n", "row_nos", "vec_ids", "labels", *extra, "matrix"]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

    return run


def _packed(rows: DataFrame, size: int, width: int, extra: tuple[str, ...] = ()) -> DataFrame:
    fields = "".join(f"{n} binary, " for n in ("row_nos", "vec_ids", "labels", *extra))
    packed = rows.select("row_no", "vec_id", "label", *extra, "whole").mapInArrow(_blocks(size, width, extra), f"n long, {fields}matrix binary")
    return packed.withColumn("block", F.monotonically_increasing_id())


def _grid(anchors: int, rows: int, tasks: int) -> tuple[int, int]:
    """Cells of rows and groups of anchors: one task for each pair, sized by its scores, and so that neither side is repeated more than it has to be."""
    scores = max(1, anchors * rows)
    wanted = max(-(-scores // SCORES), min(tasks, -(-scores // LEAST)))
    cells = max(1, min(round((wanted * rows / max(1, anchors)) ** 0.5), -(-rows // ROW_BLOCK), wanted))
    return cells, max(1, min(-(-wanted // cells), -(-anchors // ANCHOR_BLOCK)))


def _meetings(anchors: DataFrame, rows: DataFrame, cells: int, groups: int) -> DataFrame:
    """Every anchor block with every block of rows: blocks of rows go to their cell once for each group of anchors, and the
    other way round. Tasks are dealt out by number, since few bytes make much work."""
    def dealt(block: str, parts: int):
        return F.pmod(F.xxhash64(block), F.lit(parts))

    def all_of(parts: int):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))

    right = rows.select(*[F.col(c).alias(f"r_{c}") for c in rows.columns]).withColumn("_group", all_of(groups)).withColumn(
        "cell", dealt("r_block", cells) * groups + F.col("_group")).drop("_group")
    left = anchors.withColumn("_cell", all_of(cells)).withColumn("cell", F.col("_cell") * groups + dealt("block", groups)).drop("_cell")
    parts = cells * groups
    return left.repartition(parts, "cell").join(right.repartition(parts, "cell"), "cell").drop("cell")


def _whole(value, kind=np.int64) -> np.ndarray:
    return np.frombuffer(value, kind)


class _Side:
    """One block read back, its rows by id, then by row number."""

    def __init__(self, row: dict, prefix: str, residues: Residues, width: int):
        numbers = {n: _whole(row[prefix + n]) for n in ("row_nos", "vec_ids", "labels")}
        order = np.lexsort((numbers["row_nos"], numbers["vec_ids"])) if prefix else slice(None)
        self.row_nos, self.vec_ids, self.labels = (numbers[n][order] for n in ("row_nos", "vec_ids", "labels"))
        matrix = _whole(row[prefix + "matrix"], np.int32).reshape(len(self.row_nos), width)[order]
        # an anchor stands in its block once for each of its positives, and is multiplied once
        _, first, self.back = np.unique(self.row_nos, return_index=True, return_inverse=True) if not prefix else (None, slice(None), None)
        self.residues = residues.split(matrix[first].astype(np.int64))

    def tile(self, at: int) -> list[np.ndarray]:
        return [r[at:at + TILE] for r in self.residues]


class _Best:
    """The first ``count`` rows for each seeker: higher scores first, then smaller ids, then smaller row numbers."""

    def __init__(self, count: int):
        self.count = count
        self.seeker = np.empty(0, np.int64)
        self.score, self.vec_id, self.row_no = (np.empty(0, np.int64) for _ in range(3))

    def offer(self, scores: np.ndarray, wanted: np.ndarray, vec_ids: np.ndarray, row_nos: np.ndarray) -> None:
        """Scores of seekers (rows) with candidates (columns in order of id); only ``wanted`` places count."""
        kept = min(self.count, scores.shape[1])
        lowest = np.iinfo(np.int64).min
        shown = np.where(wanted, scores, lowest)
        seekers, places = [], []
        for _ in range(kept):
            place = shown.argmax(axis=1)  # the first of equal scores has the smallest id
            lines = np.flatnonzero(shown[np.arange(len(shown)), place] != lowest)
            if not len(lines):
                break
            seekers.append(lines)
            places.append(place[lines])
            shown[lines, place[lines]] = lowest
        if not seekers:
            return
        seeker, place = np.concatenate(seekers), np.concatenate(places)
        self.seeker = np.concatenate([self.seeker, seeker])
        self.score = np.concatenate([self.score, scores[seeker, place]])
        self.vec_id = np.concatenate([self.vec_id, vec_ids[place]])
        self.row_no = np.concatenate([self.row_no, row_nos[place]])
        order = np.lexsort((self.row_no, self.vec_id, -self.score, self.seeker))
        first = np.searchsorted(self.seeker[order], self.seeker[order])
        order = order[np.arange(len(order)) - first < self.count]
        self.seeker, self.score, self.vec_id, self.row_no = (x[order] for x in (self.seeker, self.score, self.vec_id, self.row_no))


def _id(values: np.ndarray) -> pa.Array:
    return pa.array(values, pa.int64(), mask=values == np.iinfo(np.int64).max)


def _candidates(bound: int, width: int, count: int, bands: tuple[int, int, int] | None):
    """For blocks that meet: the first rows of an anchor's label, or with ``bands`` those of other labels in an anchor-positive's band.

    What one anchor block finds is put together over the blocks of rows that follow each other, and given out when
    the anchor block changes. The windowed selection afterwards doesn't depend on how much was put together here.
    """
    def run(batches):
        residues = Residues(bound)
        current, anchors, best = None, None, None

        def found():
            out = {"anchor_row": anchors.row_nos[best.seeker], "anchor_id": _id(anchors.vec_ids[best.seeker])}
            if bands:
                out |= {"positive_row": low[0][best.seeker], "positive_id": _id(low[1][best.seeker]), "positive_score": low[2][best.seeker]}
            out |= {"row_no": best.row_no, "vec_id": _id(best.vec_id), "score": best.score}
            return pa.RecordBatch.from_arrays([pa.array(v) for v in out.values()], list(out))

        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_buffer() if pa.types.is_binary(batch.column(name).type) else batch.column(name)[i].as_py()
                       for name in batch.schema.names}
                if row["block"] != current:
                    if current is not None:
                        yield found()
                    current, anchors = row["block"], _Side(row, "", residues, width)
                    best = _Best(count)
                    low = [_whole(row[n]) for n in ("positive_row", "positive_id", "positive_score")] if bands else None
                side = _Side(row, "r_", residues, width)
                for at in range(0, len(side.row_nos), TILE):
                    scores = residues.multiply(anchors.residues, side.tile(at))[anchors.back]
                    labels, ids, nos = (x[at:at + TILE] for x in (side.labels, side.vec_ids, side.row_nos))
                    if bands:
                        least, most, of = bands
                        wanted = (labels[None, :] != anchors.labels[:, None]) & (
                            least * low[2][:, None] <= of * scores) & (of * scores <= most * low[2][:, None])
                    else:
                        wanted = (labels[None, :] == anchors.labels[:, None]) & (nos[None, :] != anchors.row_nos[:, None])
                    best.offer(scores, wanted, ids, nos)
        if current is not None:
            yield found()

    return run


def _first(frame: DataFrame, by: list[str], count: int) -> DataFrame:
    window = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row_no")
    return frame.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= count)


def hard_negatives(
    rows: DataFrame, is_anchor, positives: int = 5, negatives: int = 3, band: tuple[int, int, int] = (50, 95, 100),
) -> DataFrame:
    """For each anchor and each of its positives, the first rows of other labels whose score lies in a band of the positive's.

    ``rows`` has ``row_no``, ``vec_id``, ``label`` and ``whole`` (see :func:`components`); ``is_anchor`` tells the anchors. Scores are
    exact integer inner products. An anchor's positives are its first ``positives`` other rows of its label, in order of
    falling score and rising id; of the rows of other labels with ``band[0]*positive <= band[2]*score <= band[1]*positive`` the
    first ``negatives`` are returned, numbered from 1. Repeated rows are rows of their own, an anchor's copy is another row; null ids
    order last. Shorter vectors count as filled up with zeros. Anchors without positives and pairs without negatives give no
    rows. A table without rows gives none. A component beyond 32 bits, or one that makes scores of more than 56 bits possible, stops the job.

    Anchors are a stated query set: they meet all rows in blocks, dealt over a grid of cells of rows and groups of anchors. A task holds
    one block of each kind, a tile of scores and what its current anchor block has found.
    """
    spark = rows.sparkSession
    bounded_batches(spark)
    base = written(rows, "vectors")
    size = base.agg(
        F.max(F.size("whole")).alias("width"), F.count(F.lit(1)).alias("n"), F.count_if(is_anchor).alias("anchors"),
        F.max(F.aggregate("whole", F.lit(0.0), lambda s, c: s + c.cast("double") * c)).alias("square"),
        F.max(F.array_max(F.transform("whole", lambda c: F.abs(c.cast("double"))))).alias("largest")).first()
    width = max(size["width"] or 0, 1)
    if (size["largest"] or 0) >= 1 << 31:
        raise ValueError("a component doesn't fit 32 bits")
    bound = int((size["square"] or 0) * 1.001) + 1  # no inner product exceeds the largest square of a length
    if bound * max(band) >= 1 << 63:
        raise ValueError(f"scores up to {bound} are too large to compare")
    cells, groups = _grid(size["anchors"], size["n"], int(spark.conf.get("spark.sql.shuffle.partitions")))

    blocks = written(_packed(base, ROW_BLOCK, width), "vector-blocks")
    anchors = base.where(is_anchor)
    meetings = _meetings(_packed(anchors, ANCHOR_BLOCK, width), blocks, cells, groups)
    near = meetings.mapInArrow(
        _candidates(bound, width, positives, None), "anchor_row long, anchor_id long, row_no long, vec_id long, score long")
    chosen = _first(near, ["anchor_row"], positives).select(
        F.col("anchor_row").alias("row_no"), F.col("row_no").alias("positive_row"), F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"))
    pairs = anchors.join(written(chosen, "positives"), "row_no")

    extra = ("positive_row", "positive_id", "positive_score")
    longs = ", ".join(f"{n} long" for n in ("anchor_row", "anchor_id", *extra, "row_no", "vec_id", "score"))
    hard = _meetings(_packed(pairs, ANCHOR_BLOCK, width, extra), blocks, cells, groups).mapInArrow(_candidates(bound, width, negatives, band), longs)
    return _first(hard, ["anchor_row", "positive_row"], negatives).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
