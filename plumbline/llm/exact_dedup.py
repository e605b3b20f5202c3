"""Exact duplicates by counting quotient filters.

A filter holds fingerprints as (quotient, remainder, count): the high bits name a run, the low bits are kept
sorted in it, and a fingerprint seen again only raises its count. Filters built per partition merge run by run,
by sorted remainders and without loss. Fingerprints counted more than once send their rows to a comparison of the texts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.storage import buckets_for, clear_of, written

BLANK = b" \t\n\x0b\x0c\r"
RUN_BITS = 20  # quotients are the high bits; each block holds a range of them


def stripped(text: str | None) -> bytes:
    """UTF-8 of the text without the characters of ``[\\x20\\x09-\\x0D]``; null is empty."""
    return (text or "").encode().translate(None, BLANK)


def _fingerprinted(batches):
    """Row keys with the digest of the stripped text, its fingerprint and the text's code points."""
    for batch in batches:
        digests, sizes = [], []
        for value in batch.column("text"):
            text = value.as_py()
            digests.append(hashlib.sha256(stripped(text)).digest())
            sizes.append(len(text or ""))
        prints = np.frombuffer(b"".join(digests), ">i8")[::4].astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(digests, pa.binary()), pa.array(prints), pa.array(sizes, pa.int64())],
            ["id", "digest", "print", "points"])


def _partition_filter(blocks: int):
    """One partition's filter, as a row per block: quotients of its runs, their ends, remainders and counts."""
    schema = pa.schema([("block", pa.int32()), ("quotients", pa.binary()), ("ends", pa.binary()), ("remainders", pa.binary()), ("counts", pa.binary())])

    def run(batches):
        for batch in batches:
            prints = batch.column(0).to_numpy().astype(np.uint64)
            if not len(prints):
                continue
            prints, counts = np.unique(prints, return_counts=True)
            quotient = prints >> np.uint64(64 - RUN_BITS)
            block = (quotient * np.uint64(blocks) >> np.uint64(RUN_BITS)).astype(np.int64)
            cuts = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True])
            rows = [(int(block[a]), *packed_runs(prints[a:b], counts[a:b])) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
    return run


def packed_runs(prints: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes, bytes, bytes]:
    """Runs of ascending fingerprints: quotients, ends of the runs, 44-bit remainders and counts."""
    quotient = (prints >> np.uint64(64 - RUN_BITS)).astype(np.uint32)
    remainder = prints & np.uint64((1 << (64 - RUN_BITS)) - 1)
    ends = np.flatnonzero(np.r_[quotient[1:] != quotient[:-1], True])
    low = remainder.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    return quotient[ends].tobytes(), (ends + 1).astype(np.uint32).tobytes(), low.tobytes(), counts.astype(np.uint32).tobytes()


def unpacked_runs(quotients: bytes, ends: bytes, remainders: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The inverse of :func:`packed_runs`."""
    runs = np.diff(np.frombuffer(ends, np.uint32).astype(np.int64), prepend=0)
    high = np.repeat(np.frombuffer(quotients, np.uint32).astype(np.uint64), runs) << np.uint64(64 - RUN_BITS)
    low = np.zeros((len(remainders) // 6, 8), np.uint8)
    low[:, :6] = np.frombuffer(remainders, np.uint8).reshape(-1, 6)
    return high | low.view("<u8").ravel(), np.frombuffer(counts, np.uint32).astype(np.int64)


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted fingerprints of several filters with their counts added."""
    prints, counts = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    order = np.argsort(prints, kind="stable")
    prints, counts = prints[order], counts[order]
    starts = np.flatnonzero(np.r_[True, prints[1:] != prints[:-1]])
    return prints[starts], np.add.reduceat(counts, starts)


def _repeated(key, table):
    """Fingerprints of a merged block that were counted more than once."""
    parts = [unpacked_runs(*row) for row in zip(*(table[c].to_pylist() for c in ("quotients", "ends", "remainders", "counts")), strict=True)]
    prints, counts = merged(parts)
    many = counts > 1
    return pa.table({"print": pa.array(prints[many].astype(np.int64)), "n": pa.array(counts[many])})


def _texts(batches):
    """Fingerprint, digest and stripped text of every row."""
    for batch in batches:
        texts = [stripped(value.as_py()) for value in batch.column("text")]
        digests = [hashlib.sha256(t).digest() for t in texts]
        prints = np.frombuffer(b"".join(digests), ">i8")[::4].astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(prints), pa.array(digests, pa.binary()), pa.array(texts, pa.binary())], ["print", "digest", "bytes"])


def duplicate_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with the one that stays of its group of equal texts.

    Texts are equal when identical without the characters ``[\\x20\\x09-\\x0D]``; null is empty. The row with the most code points in the
    original text stays, then the smallest key, null last, then any one of rows equal in both. Returns ``key``, ``keep_id``,
    ``group_size``, ``kept`` (one row of a group), ``text_sha256`` (lower-case hex) and ``row_no``. Other columns are not
    read; an empty table gives no rows. Rows whose fingerprint counts once are done after the merge; of the others the
    stripped texts are compared byte by byte (grouped by them, collapsed per partition first), and a digest that
    stands for two texts stops the job. Rows of a large group are spread by the joins' skew handling.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    kind = plain.schema["id"].dataType.simpleString()
    rows = plain.mapInArrow(_fingerprinted, f"id {kind}, digest binary, print long, points long")
    rows = written(rows.withColumn("row_no", F.monotonically_increasing_id()), "dedup-rows")
    blocks = buckets_for(rows.count(), 500_000, spark)
    filters = rows.select("print").mapInArrow(_partition_filter(blocks), "block int, quotients binary, ends binary, remainders binary, counts binary")
    many = written(filters.groupBy("block").applyInArrow(_repeated, "print long, n long"), "dedup-filter").select("print")

    sought = plain.select("text").mapInArrow(_texts, "print long, digest binary, bytes binary").join(many, "print")
    verified = sought.groupBy("digest", "bytes").agg(F.count(F.lit(1)).alias("n")).groupBy("digest").agg(
        F.count(F.lit(1)).alias("texts"), F.sum("n").alias("n"))
    stays = F.max(F.struct("points", F.when(F.col("id").isNotNull(), F.lit(1)).otherwise(0).alias("named"), (-F.col("id")).alias("low"), (-F.col("row_no")).alias("row"))).alias("stays")
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"{key} must be an integer column, not {kind}")
    groups = rows.join(many, "print", "left_semi").groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), stays)
    checked = groups.join(verified, "digest").withColumn(
        "agrees", F.assert_true((F.col("texts") == 1) & (F.col("n") == F.col("group_size")), "one digest stands for two texts"))
    groups = checked.where("agrees IS NULL").select(
        F.col("digest").alias("of"), "group_size", (-F.col("stays.low")).alias("keep_id"), (-F.col("stays.row")).alias("keep_row"))
    found = rows.join(groups, F.col("digest") == F.col("of"), "left")
    alone = F.col("of").isNull()
    return found.select(
        F.col("id").alias(key), F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), (alone | (F.col("keep_row") == F.col("row_no"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "row_no")


def without_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that stay.

    Rows are found again by key and digest; of rows equal in both, one stays (any of the longest).
    """
    found = duplicate_groups(docs, key, text)
    k, d, n, t, e = clear_of(docs, "key_", "digest_", "points_", "turn_", "of_")
    blank = F.translate(F.coalesce(F.col(text), F.lit("")), BLANK.decode(), "")
    kept = found.where("kept").select(F.col(key).alias(k), F.col("text_sha256").alias(d))
    lone = found.groupBy(key).agg(F.count(F.lit(1)).alias(n)).where(F.col(n) > 1).limit(1).count() == 0
    if lone:
        return docs.join(kept.select(k), docs[key].eqNullSafe(F.col(k)), "inner").select(*docs.columns)
    keyed = docs.withColumn(d, F.sha2(blank.cast("binary"), 256)).withColumn(n, F.char_length(F.coalesce(F.col(text), F.lit(""))))
    first = F.row_number().over(Window.partitionBy(F.col(key), F.col(d)).orderBy(F.desc(n)))
    kept = kept.select(k, F.col(d).alias(e))
    joined = keyed.withColumn(t, first).where(F.col(t) == 1)
    return joined.join(kept, joined[key].eqNullSafe(F.col(k)) & (joined[d] == F.col(e)), "inner").select(*docs.columns)
