"""The training-data queries over the given tables, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import (
    byte_bpe, chat, decontaminate, exact_dedup, hard_negatives, jaccard_join, language, line_dedup, packing, pitman_yor, sharding, token_alignment,
    token_counts,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query
def op1_chat_prefix_targets(spark: SparkSession, folder: str) -> DataFrame:
    turns = _read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat.digests(chat.prefix_targets(turns.unionByName(probe)))


def _escaped(column: str) -> str:
    angle = chat._ANGLE.replace("'", "''")
    square = chat._SQUARE
    return (rf"regexp_replace(regexp_replace({column}, '<(\\*)({angle})', '<\\\1\2', 'g'), "
            rf"'\[(\\*)({square})', '[\\\1\2', 'g')")


ORACLES["op1_chat_prefix_targets"] = f"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
placed AS (
    SELECT *, row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS n,
        length({_escaped('role')}) + length({_escaped('text')}) + {len(chat.START + chat.SEP + chat.END)} AS piece
    FROM said WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
summed AS (SELECT *, sum(piece) OVER (PARTITION BY conv_id ORDER BY place) AS upto FROM placed)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(upto) FILTER (role = 'assistant' OR place = n) AS BIGINT) AS formatted_chars
FROM summed GROUP BY conv_id"""


@_query
def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return token_counts.token_counts(_read(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@_query
def op3_site_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.without_boilerplate(_read(spark, folder, "pages"))


ORACLES["op3_site_line_dedup"] = line_dedup.oracle()


@_query
def op4_pitman_yor_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1
    return pitman_yor.scored(docs, held)


@_query
def op5_benchmark_index(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(decontaminate.benchmark_matches(
        _read(spark, folder, "documents"), _read(spark, folder, "benchmark"), slack=2))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated", "n_near")


@_query
def op6_stratified_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.stratified_shards(_read(spark, folder, "documents"))


@_query
def op7_quotient_filter_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.duplicate_groups(_read(spark, folder, "documents")).drop("row_no")


ORACLES["op7_quotient_filter_dedup"] = r"""
WITH stripped AS (SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare FROM documents),
ranked AS (SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY bare) AS group_size, row_number() OVER w AS place
    FROM stripped WINDOW w AS (PARTITION BY bare ORDER BY points DESC, doc_id))
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, place = 1 AS kept, sha256(bare) AS text_sha256 FROM ranked"""


@_query
def op8_signature_tree_join(spark: SparkSession, folder: str) -> DataFrame:
    found = jaccard_join.similarity_classes(_read(spark, folder, "documents"), words=4, num=85, den=100)
    return found.select("doc_id", "n_shingles", "component_id")


@_query
def op9_length_bucket_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(_read(spark, folder, "documents"))


@_query
def op10_language_fusion(spark: SparkSession, folder: str) -> DataFrame:
    docs, pages = _read(spark, folder, "documents"), _read(spark, folder, "pages")
    languages, model = language.text_model(docs, "doc_id", "text", "lang")
    both = language.evidence_of_documents(docs).withColumn("kind", F.lit("document")).unionByName(
        language.evidence_of_pages(pages).withColumn("kind", F.lit("page")))
    found = language.fused(both, languages, model)
    is_document = F.col("kind") == "document"
    return found.select(
        "kind", F.when(is_document, F.col("id")).alias("doc_id"), F.when(~is_document, F.col("id")).alias("page_id"),
        F.col("lang_found").alias("lang"), "confidence", "accepted")


@_query
def op11_segment_tree_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    found = byte_bpe.encoded(_read(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(byte_bpe.id_bytes(F.col("ids")), 256).alias("ids_sha256"),
        F.sha2(byte_bpe.decoded(F.col("ids"), ranks), 256).alias("decoded_sha256"))


@_query
def op12_residue_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    table = _read(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.components(table.withColumn("label", label), "vec_id", "embedding", "label")
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0)


ORACLES["op12_residue_hard_negatives"] = """
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS whole
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, a.label AS anchor_label, r.vec_id, r.label,
        CAST(list_sum([z[1] * z[2] FOR z IN list_zip(a.whole, r.whole)]) AS BIGINT) AS score
    FROM usable a JOIN usable r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE label = anchor_label
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND s.label <> s.anchor_label
    AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 3"""


@_query
def op13_pointer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return token_alignment.alignment_scores(token_alignment.stored(token_alignment.aligned(_read(spark, folder, "documents"), *paths, packed=True)))


@_query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)
