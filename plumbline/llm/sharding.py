"""Proportional stratified interleaving into shards, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.storage import ranked

PART_ROWS = 50_000


def part_bits(rows: int, part_rows: int = PART_ROWS) -> int:
    """Bits of a hash so that a part of all rows has about ``part_rows``, and there are 64 parts at least."""
    return max(6, (max(1, rows) // part_rows).bit_length())


def stratified_shards(
    docs: DataFrame, shards: int = 24, seed: int = 7, key: str = "doc_id", text: str = "text", source: str = "source",
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Every row's shard and slot, each shard with the mixture of sources that the table has.

    Rows of a source are shuffled by a seeded hash of the key and ranked; the row of rank r of n stands at (r + f) / n
    of the whole, with a seeded f from 0 to 1 for each source, so that sources of few rows spread over all shards. All rows in that order are cut into ``shards`` runs, so counts differ by one at most, and a source's count in
    a shard differs from its share by at most a row or two. ``slot`` runs from 0 without gaps. Returns ``key``, ``size``
    (UTF-8 bytes of the text and 8; null: 8), ``text_crc32`` (null: of nothing, 0), ``law``, ``shard``, ``slot`` and
    ``grown_shard`` (null under this law). A null source is a source of its own; null keys and repeated rows are rows like
    others, ordered by checksum and size, and equal rows are interchangeable. Empty table: no rows. Texts don't leave the
    scan, and no task ranks more than one part of the hash range, so a source with most rows is no burden.
    """
    rows = docs.select(
        F.col(key).alias("doc_id"), F.col(source).alias("source"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"))
    rows = rows.withColumn("turn", F.xxhash64(F.lit(seed), "doc_id"))
    bits = part_bits(docs.count(), part_rows)
    order = [F.col(c) for c in ("turn", "doc_id", "text_crc32", "size")]
    inside = ranked(rows, ["source"], F.shiftrightunsigned("turn", 64 - bits).cast("int"), order, "rank", "of")
    inside = inside.withColumn("lot", F.xxhash64(F.lit(seed), "source"))
    inside = inside.withColumn("place", (F.col("rank") + F.shiftrightunsigned("lot", 11) * 2.0**-53) / F.col("of"))
    order = [F.col(c) for c in ("place", "lot", "source", "turn", "doc_id", "text_crc32", "size")]
    placed = ranked(inside, [], F.floor(F.col("place") * (1 << bits)).cast("int"), order, "position", "all_rows")
    shard = F.expr(f"position * {shards} div all_rows")
    first = F.expr(f"(shard * all_rows + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard).select(
        F.col("doc_id").alias(key), "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("position") - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
