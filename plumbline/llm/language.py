"""Language of texts by Bayesian fusion of the text with declared language, address suffix and host."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.storage import written
from plumbline.llm.words import LOWER, slabs, text_bytes

FEATURES = 1 << 16
BLOCK = 1 << 12  # trigrams whose counts are added up together
HELD = 64  # languages whose counts a task holds
UNKNOWN = "und"
_LETTER = np.zeros(256, bool)
_LETTER[ord("a"):ord("z") + 1] = True
_LETTER[128:] = True
_SHOWN = np.where(_LETTER, np.arange(256), 0x20).astype(np.uint32)  # what is no letter looks like a blank


def trigrams(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the byte trigram that starts at each byte, and whether it holds two letters at least."""
    low = LOWER[data]
    letter, shown = _LETTER[low], _SHOWN[low]
    if len(data) < 3:
        return np.empty(0, np.int64), np.empty(0, bool)
    code = (shown[:-2] << 16) | (shown[1:-1] << 8) | shown[2:]
    number = ((code * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64)
    return number, letter[:-2].astype(np.int8) + letter[1:-1] + letter[2:] >= 2


def _rows_trigrams(offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First and one past the last of each text's own places among ``n`` trigrams: none across two texts."""
    return np.minimum(offsets[:-1], n), np.minimum(np.maximum(offsets[1:] - 2, offsets[:-1]), n)


def _counts(batches):
    """Trigram counts by label and block of trigrams; a label has its first block whatever its texts."""
    def blocks(held):
        for label, counts in held.items():
            own = [b for b in range(FEATURES // BLOCK) if not b or counts[b * BLOCK:(b + 1) * BLOCK].any()]
            yield pa.RecordBatch.from_arrays([
                pa.array([label] * len(own), pa.string()), pa.array(own, pa.int32()),
                pa.array([counts[b * BLOCK:(b + 1) * BLOCK].tobytes() for b in own], pa.binary())], ["label", "block", "counts"])

    held = {}
    for batch in batches:
        for _, part in slabs(batch, "text"):
            data, offsets = text_bytes(part.column("text"))
            number, counted = trigrams(data)
            first, last = _rows_trigrams(offsets, len(number))
            code = part.column("label").dictionary_encode()
            row = np.repeat(np.arange(part.num_rows), np.diff(offsets))[:len(number)]
            own = np.flatnonzero(counted & (np.arange(len(number)) < last[row]))
            labels = code.indices.to_numpy()[row[own]]
            order = np.argsort(labels, kind="stable")
            cuts = np.searchsorted(labels[order], np.arange(len(code.dictionary) + 1))
            for label, a, b in zip(code.dictionary.to_pylist(), cuts[:-1], cuts[1:], strict=True):
                if label not in held and len(held) == HELD:
                    yield from blocks(held)
                    held = {}
                held[label] = held.get(label, 0) + np.bincount(number[own[order[a:b]]], minlength=FEATURES)
    yield from blocks(held)


def _added(key, table):
    sums = np.zeros(BLOCK, np.int64)
    for part in table["counts"].to_pylist():
        sums += np.frombuffer(part, np.int64)
    return pa.table({"label": pa.array([key[0].as_py()], pa.string()), "block": pa.array([key[1].as_py()], pa.int32()), "counts": pa.array([sums.tobytes()], pa.binary())})


def text_model(labelled: DataFrame, key: str, text: str, label: str) -> tuple[list[str], np.ndarray]:
    """Languages and the log probabilities of trigrams in each, with a last row for texts in none (all trigrams alike).

    Fitted on all labelled rows, so every label met is a language, however rare. Counts are added up in the tasks before the
    shuffle; the sums of each language come to the driver. ``key`` plays no part: repeated rows and null keys are rows like others.
    """
    known = labelled.where(F.col(label).isNotNull()).select(F.col(text).alias("text"), F.col(label).alias("label"))
    kind = "label string, block int, counts binary"
    rows = known.mapInArrow(_counts, kind).groupBy("label", "block").applyInArrow(_added, kind).collect()
    names = sorted({r["label"] for r in rows})
    counts = {n: np.zeros(FEATURES, np.int64) for n in names}
    for r in rows:
        counts[r["label"]][r["block"] * BLOCK:(r["block"] + 1) * BLOCK] = np.frombuffer(r["counts"], np.int64)
    logs = [np.log((counts[n] + 0.1) / (counts[n].sum() + 0.1 * FEATURES)) for n in names]
    return names, np.array([*logs, np.full(FEATURES, -np.log(FEATURES))], np.float32)


def _score(shared, text: str):
    def run(batches):
        model = shared.value
        for batch in batches:
            scores, counted_all = [], []
            for _, part in slabs(batch, text):
                data, offsets = text_bytes(part.column(text))
                number, counted = trigrams(data)
                first, last = _rows_trigrams(offsets, len(number))
                upto = np.concatenate([[0], np.cumsum(counted)])
                counted_all.append(upto[last] - upto[first])
                own = np.empty((len(first), len(model)))
                for j, logs in enumerate(model):
                    sums = np.concatenate([[0.0], np.cumsum(np.where(counted, logs[number], 0), dtype=np.float64)])
                    own[:, j] = sums[last] - sums[first]
                scores.append(own)
            own = np.concatenate(scores) if scores else np.empty((0, len(model)))
            n = np.concatenate(counted_all) if counted_all else np.empty(0, np.int64)
            kept = batch.drop_columns([text])
            logs = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1) * len(model), pa.int32()), pa.array(own.ravel()))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(n, pa.int64()), logs], [*kept.schema.names, "n_trigrams", "logs"])
    return run


def fused(
    rows: DataFrame, languages: list[str], model: np.ndarray, weight: float = 1 / 3, smoothing: float = 4.0, accept: float = 0.5,
) -> DataFrame:
    """Adds ``lang``, ``confidence`` and ``accepted`` to rows of (id, text, declared, suffix, host).

    log P(language | all) = weight * log P(trigrams | language) + log P(declared | language) + log P(suffix | language) + log P(language | host).
    Overlapping trigrams repeat what the ones before said, hence the weight. P(declared | language), P(suffix | language) and the host
    priors come from grouped sums of text posteriors over all rows: a host's prior is smoothed towards its suffix's, that towards all rows'.
    A host counts without the row at hand. Evidence that is null or empty adds nothing. ``und`` stands for no language: a
    text more like random bytes. A text without letters has a language only by its other evidence, and is not accepted.
    ``accepted``: a language with a confidence of ``accept`` or more. Sums are combined before the shuffle.
    """
    names = [*languages, UNKNOWN]
    shared = rows.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in rows.columns if c != "text"]
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept)
    scored = rows.select(*kept, "text").mapInArrow(_score(shared, "text"), f"{schema}, n_trigrams long, logs array<double>")

    def softmax(logs: Column) -> Column:
        shares = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
        return F.transform(shares, lambda x: x / F.aggregate(shares, F.lit(0.0), lambda a, y: a + y))

    scored = scored.withColumn("logs", F.transform("logs", lambda x: x * weight))
    scored = written(scored.withColumn("soft", softmax(F.col("logs"))).where("logs IS NOT NULL"), "language-scores")
    each = [F.sum(F.col("soft")[j]).alias(f"s{j}") for j in range(len(names))]
    packed = F.array(*[F.col(f"s{j}") for j in range(len(names))])

    def sums(column: str | None, name: str) -> DataFrame:
        part = scored if column is None else scored.where(F.coalesce(F.col(column), F.lit("")) != "")
        grouped = part.groupBy(F.col(column).alias(f"{name}_key")) if column else part.groupBy()
        return grouped.agg(*each).select(*([f"{name}_key"] if column else []), packed.alias(name))

    top = sums(None, "top").first()["top"]
    whole = sum(x or 0 for x in top) or 1.0
    root = F.array(*[F.lit(((x or 0) + 0.5) / (whole + 0.5 * len(names))) for x in top])
    totals = F.array(*[F.lit(float(x or 0) + 0.5) for x in top])

    def smooth(own: Column, parent: Column) -> Column:
        size = F.aggregate(own, F.lit(0.0), lambda a, y: a + y)
        return F.zip_with(own, parent, lambda a, b: (a + smoothing * b) / (size + smoothing))

    out = scored
    for column in ("declared", "suffix", "host"):
        counts = sums(column, f"by_{column}")
        out = out.join(counts, F.col(column) == F.col(f"by_{column}_key"), "left").drop(f"by_{column}_key")
    nothing = F.array(*[F.lit(0.0) for _ in names])
    has = lambda c: F.coalesce(F.col(f"by_{c}"), nothing)
    share = lambda c: F.zip_with(has(c), totals, lambda a, t: F.log((a + 0.5) / (t + 1.0)))
    own = F.when(F.coalesce(F.col("host"), F.lit("")) != "", F.col("soft")).otherwise(nothing)
    others = F.zip_with(has("host"), own, lambda a, b: F.greatest(F.lit(0.0), a - b))
    prior = smooth(others, smooth(has("suffix"), root))
    fused_logs = F.zip_with("logs", prior, lambda a, p: a + F.log(p))
    for column in ("declared", "suffix"):
        fused_logs = F.when(F.col(f"by_{column}").isNotNull(), F.zip_with(fused_logs, share(column), lambda a, b: a + b)).otherwise(fused_logs)
    out = out.withColumn("posterior", softmax(fused_logs))
    best = F.array_max("posterior")
    lang = F.element_at(F.array(*[F.lit(n) for n in names]), F.array_position("posterior", best).cast("int"))
    return out.select(*kept, lang.alias("lang_found"), best.alias("confidence"), (
        (lang != UNKNOWN) & (best >= accept) & (F.col("n_trigrams") > 0)).alias("accepted"))


def evidence_of_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text, declared, suffix, host) of documents: the ``lang`` column is what they declare, ``source`` the host."""
    return docs.select(
        F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.col("lang").alias("declared"),
        F.lit(None).cast("string").alias("suffix"), F.col("source").alias("host"))


def evidence_of_pages(pages: DataFrame) -> DataFrame:
    """The same of web pages: the markup's ``lang`` attribute, the last label of the host, and the host."""
    from plumbline.llm.line_dedup import host_of, lines_of

    host = host_of(F.col("url"))
    declared = F.lower(F.regexp_extract(F.coalesce(F.col("html"), F.lit("")), r"(?i)<html[^>]*[ \t\r\n]lang=[\"']?([A-Za-z]+)", 1))
    return pages.select(
        F.col("page_id").alias("id"), F.array_join(lines_of(F.col("html")), "\n").alias("text"), declared.alias("declared"),
        F.regexp_extract(host, r"\.([^.]+)$", 1).alias("suffix"), host.alias("host"))


def in_known_language(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose language is accepted.

    Rows are told apart by key, text (its SHA-256), declared language and host, which decide, so each row's own decision
    takes effect, whatever rows share its key; repeated rows stay repeated.
    """
    from plumbline.llm.storage import clear_of

    languages, model = text_model(docs, key, text, "lang")
    names = clear_of(docs, "key_", "digest_", "declared_", "host_")
    digest = lambda column: F.unhex(F.sha2(F.coalesce(F.col(column), F.lit("")).cast("binary"), 256))
    found = fused(evidence_of_documents(docs, key, text).withColumn("digest", digest("text")), languages, model)
    own = [F.col(c).alias(n) for c, n in zip(("id", "digest", "declared", "host"), names, strict=True)]
    good = found.where("accepted").select(*own).distinct()
    k, d, lang, host = (F.col(n) for n in names)
    same = docs[key].eqNullSafe(k) & (digest(text) == d) & docs["lang"].eqNullSafe(lang) & docs["source"].eqNullSafe(host)
    return docs.join(good, same, "left_semi")
