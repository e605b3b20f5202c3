"""Benchmark passages in documents, by a distributed positional inverted index.

The index is a table of segments, one per few megabytes of text: for every term that a benchmark may hold, the ascending
positions at which the segment's documents have it. Benchmark windows are looked up segment by segment: the rarest term's
list, shifted by its offset in the window, gives the starts that may match; the other terms' shifted lists, rarest first,
thin them out. What is left are exact phrases or, within a slack, proximity matches.
"""

from __future__ import annotations

from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.storage import clear_of, written
from plumbline.llm.words import ALPHANUMERIC, hash_words, slabs, text_bytes

WINDOW = 13
SEGMENT_BYTES = 4 << 20
MAP_BITS = 27  # the term map is a bitmap of at most 16 MB, whatever the benchmark's size
SLICE_WORDS = 1_000_000  # benchmark words looked up in one pass over the index
STARTS = 1_000_000  # candidate starts thinned at a time


def _term_maps(bits: int):
    """Bitmap of the terms of each batch of benchmark texts."""
    def run(batches):
        for batch in batches:
            terms, _ = hash_words(*text_bytes(batch.column(0)), ALPHANUMERIC)
            held = np.zeros(1 << bits, bool)
            held[(terms >> np.uint64(64 - bits)).astype(np.int64)] = True
            yield pa.RecordBatch.from_arrays([pa.array([np.packbits(held).tobytes()], pa.binary())], ["held"])
    return run


def term_map(items: DataFrame, text: str) -> tuple[int, bytes]:
    """Bits of the map, and the map. A full map only means that more terms are indexed than are asked for."""
    words = items.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0] // 2
    bits = min(MAP_BITS, max(16, int(16 * words).bit_length()))
    held = np.zeros((1 << bits) // 8, np.uint8)
    for row in items.select(text).mapInArrow(_term_maps(bits), "held binary").toLocalIterator():
        held |= np.frombuffer(row["held"], np.uint8)
    return bits, held.tobytes()


def _segments(shared, key: str, text: str):
    """Index segments: keys and word counts of documents, terms, ends of their lists, and the lists of positions."""
    def run(batches):
        bits, packed = shared.value
        held = np.unpackbits(np.frombuffer(packed, np.uint8)).astype(bool)
        for batch in batches:
            for _, part in slabs(batch, text, SEGMENT_BYTES):
                words, counts = hash_words(*text_bytes(part.column(text)), ALPHANUMERIC)
                at = np.flatnonzero(held[(words >> np.uint64(64 - bits)).astype(np.int64)])
                order = np.argsort(words[at], kind="stable")
                at = at[order]
                terms = words[at]
                ends = np.flatnonzero(np.r_[terms[1:] != terms[:-1], True]) if len(terms) else np.empty(0, np.int64)
                ids = part.column(key)
                ids = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
                binary = [pa.array([a.tobytes()], pa.binary()) for a in (
                    counts.astype(np.uint32), terms[ends], (ends + 1).astype(np.uint32), at.astype(np.uint32))]
                yield pa.RecordBatch.from_arrays([ids, *binary], ["ids", "counts", "terms", "ends", "positions"])
    return run


def positional_index(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_text: str = "text") -> DataFrame:
    """The stored index over all of ``docs`` for the terms of ``items``; ``segment`` numbers its rows."""
    (k,) = clear_of(docs.select(text), "key_")
    plain = docs.select(F.col(key).alias(k), text)
    kind = plain.schema[k].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(term_map(items, item_text))
    rows = plain.mapInArrow(
        _segments(shared, k, text), f"ids array<{kind}>, counts binary, terms binary, ends binary, positions binary")
    return written(rows.withColumn("segment", F.monotonically_increasing_id()), "positional-index")


class Windows:
    """All windows of some benchmark items, by width: term numbers and item numbers."""

    def __init__(self, ids: list, words: list[np.ndarray], window: int = WINDOW):
        self.ids = ids
        self.terms, numbers = np.unique(np.concatenate(words) if words else np.empty(0, np.uint64), return_inverse=True)
        by_width: dict[int, tuple[list, list]] = {}
        at = 0
        for item, found in enumerate(words):
            own = numbers[at:at + len(found)]
            at += len(found)
            if len(found):
                width = min(window, len(found))
                rows, items = by_width.setdefault(width, ([], []))
                rows.append(np.lib.stride_tricks.sliding_window_view(own, width))
                items.append(np.full(len(found) - width + 1, item))
        self.by_width = {w: (np.concatenate(r), np.concatenate(i)) for w, (r, i) in by_width.items()}


class Segment:
    """One index row, ready for lookups of the windows' terms."""

    def __init__(self, windows: Windows, counts: bytes, terms: bytes, ends: bytes, positions: bytes):
        self.starts = np.concatenate([[0], np.cumsum(np.frombuffer(counts, np.uint32).astype(np.int64))])
        terms, ends = np.frombuffer(terms, np.uint64), np.frombuffer(ends, np.uint32).astype(np.int64)
        firsts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        place = np.searchsorted(terms, windows.terms)
        place[place == len(terms)] = 0
        has = terms[place] == windows.terms if len(terms) else np.zeros(len(windows.terms), bool)
        self.first = np.where(has, firsts[place] if len(terms) else 0, 0)
        self.rows = np.where(has, ends[place] - firsts[place] if len(terms) else 0, 0)
        self.positions = np.frombuffer(positions, np.uint32).astype(np.int64)
        lists = np.repeat(np.arange(len(terms)), np.diff(ends, prepend=0))
        self.keys = (lists << 32) | self.positions
        self.list_of = place

    def matches(self, rows: np.ndarray, slack: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(window number, start, end, is exact) of the matches of windows of one width."""
        there = np.flatnonzero((self.rows[rows] > 0).all(axis=1))
        rows = rows[there]
        rarity = np.argsort(self.rows[rows], axis=1, kind="stable")
        amount = self.rows[rows[np.arange(len(rows)), rarity[:, 0]]] if len(rows) else np.empty(0, np.int64)
        turns = np.cumsum(amount) // STARTS
        for turn in np.unique(turns):
            pick = np.flatnonzero(turns == turn)
            yield from self.thin(there[pick], rows[pick], rarity[pick], amount[pick], slack)

    def thin(self, number, rows, rarity, amount, slack):
        width = rows.shape[1]
        row = np.repeat(np.arange(len(rows)), amount)
        rank = np.arange(len(row)) - np.repeat(np.cumsum(amount) - amount, amount)
        offset = rarity[row, 0]
        start = self.positions[self.first[rows[row, offset]] + rank] - offset
        low, high, exact = start + offset, start + offset, np.ones(len(row), bool)
        for j in range(1, width):
            offset = rarity[row, j]
            base = self.list_of[rows[row, offset]]
            want = start + offset
            key = (base << 32) | np.maximum(want, 0)
            at = np.searchsorted(self.keys, key)
            found = np.full(len(row), -1 - slack)
            gap = np.full(len(row), slack + 1)
            for side in (at, at - 1):
                inside = (side >= 0) & (side < len(self.keys))
                side = np.where(inside, side, 0)
                near = inside & (self.keys[side] >> 32 == base)
                far = np.where(near, np.abs(self.positions[side] - want), slack + 1)
                better = far < gap
                gap, found = np.where(better, far, gap), np.where(better, self.positions[side], found)
            keep = gap <= slack
            row, start, exact = row[keep], start[keep], exact[keep] & (gap[keep] == 0)
            low, high = np.minimum(low[keep], found[keep]), np.maximum(high[keep], found[keep])
            if not len(row):
                return
        same = np.searchsorted(self.starts, low, "right") == np.searchsorted(self.starts, high, "right")
        yield number[row[same]], low[same], high[same] + 1, exact[same]


def _lookup(shared, slack: int, item_type: pa.DataType):
    span = pa.list_(pa.struct([("item", item_type), ("start", pa.int32()), ("end", pa.int32()), ("exact", pa.bool_())]))

    def run(batches):
        windows = SimpleNamespace(**shared.value)
        for batch in batches:
            for ids, number, *row in zip(*(batch.column(c).to_pylist() for c in ("ids", "segment", "counts", "terms", "ends", "positions")), strict=True):
                segment = Segment(windows, *row)
                spans: list[list] = [[] for _ in ids]
                for rows, items in windows.by_width.values():
                    for which, low, high, exact in segment.matches(rows, slack):
                        doc = np.searchsorted(segment.starts, low, "right") - 1
                        origin = segment.starts[doc]
                        for d, i, a, b, e in zip(doc.tolist(), items[which].tolist(), (low - origin).tolist(), (high - origin).tolist(), exact.tolist(), strict=True):
                            own = spans[d]
                            if own and own[-1][0] == i and own[-1][3] == e and own[-1][1] <= a <= own[-1][2] <= b:
                                own[-1][2] = b  # the next window of the same passage
                            else:
                                own.append([i, a, b, e])
                named = [[{"item": windows.ids[i], "start": a, "end": b, "exact": e} for i, a, b, e in own] for own in spans]
                counts = np.diff(segment.starts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * len(ids), pa.int64()), pa.array(range(len(ids)), pa.int32()), pa.array(ids), pa.array(counts, pa.int64()), pa.array(named, span)],
                    ["segment", "ordinal", "id", "n_words", "spans"])
    return run


def _slices(items: DataFrame, item: str, text: str, window: int) -> Iterator[Windows]:
    """Windows of as many items at a time as have ``SLICE_WORDS`` words; the driver never holds more."""
    def run(batches):
        for batch in batches:
            for _, part in slabs(batch, text):
                words, counts = hash_words(*text_bytes(part.column(text)), ALPHANUMERIC)
                ends = np.cumsum(counts)
                found = [words[e - c:e].tobytes() for c, e in zip(counts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(item), pa.array(found, pa.binary())], ["item", "words"])

    kind = items.schema[item].dataType.simpleString()
    ids, words, held = [], [], 0
    for row in items.select(item, text).mapInArrow(run, f"item {kind}, words binary").toLocalIterator():
        ids.append(row["item"])
        words.append(np.frombuffer(row["words"], np.uint64))
        held += len(words[-1])
        if held >= SLICE_WORDS:
            yield Windows(ids, words, window)
            ids, words, held = [], [], 0
    yield Windows(ids, words, window)


def benchmark_matches(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, slack: int = 0, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Every document with the benchmark passages in it.

    Words are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased. A window is ``window`` consecutive words of
    an item; an item of fewer words, but not none, is one window. ``spans`` lists matches as (item, start, end, exact), in words
    of the document: exact phrases, and with ``slack`` also windows whose words all stand within ``slack`` places of
    where the phrase has them. Returns ``segment``, ``ordinal`` (name a row), ``key``, ``n_words`` and ``spans``. Null texts
    have no words; a null key or item id stays null; repeated rows come out repeated; other columns are not read. An
    empty benchmark matches nothing. The index is stored once; a benchmark beyond ``SLICE_WORDS`` words is looked up in slices.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    index = positional_index(docs, items, key, text, item_text)
    kind = docs.schema[key].dataType.simpleString()
    item_kind = items.schema[item].dataType.simpleString()
    item_type = to_arrow_type(items.schema[item].dataType)
    schema = f"segment long, ordinal int, id {kind}, n_words long, spans array<struct<item:{item_kind},start:int,end:int,exact:boolean>>"
    found, passes = None, 0
    for windows in _slices(items, item, item_text, window):
        shared = docs.sparkSession.sparkContext.broadcast(vars(windows))
        part = index.mapInArrow(_lookup(shared, slack, item_type), schema)
        found, passes = part if found is None else found.unionByName(part), passes + 1
    if passes > 1:
        found = found.groupBy("segment", "ordinal").agg(
            F.first("id").alias("id"), F.first("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"))
    return found.select("segment", "ordinal", F.col("id").alias(key), "n_words", "spans")


def contamination(matches: DataFrame, key: str = "doc_id", share: int = 20) -> DataFrame:
    """Per row of :func:`benchmark_matches`: words hit by exact phrases, their items, and whether a ``share``-th or more is hit."""
    sure = F.filter("spans", lambda s: s["exact"])
    runs = F.array_sort(F.transform(sure, lambda s: F.struct(s["start"], s["end"])))
    none = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("hit"))
    covered = F.aggregate(runs, none, lambda a, s: F.struct(
        F.greatest(a["end"], s["end"]).alias("end"),
        (a["hit"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["end"], s["start"]))).alias("hit")))["hit"]
    items = F.array_sort(F.array_distinct(F.transform(sure, lambda s: s["item"].cast("string"))))
    near = F.array_except(F.array_distinct(F.transform("spans", lambda s: s["item"].cast("string"))), items)
    out = matches.select("segment", "ordinal", key, "n_words", covered.alias("n_hit"), items.alias("items"), F.size(near).cast("long").alias("n_near"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))


def decontaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that aren't contaminated.

    Each row is judged by its own text. Rows that share the key of a contaminated one (repeated and null keys) are looked at once more
    under numbers of their own; where no such key has other rows, the keys are enough.
    """
    found = contamination(benchmark_matches(docs, items, key=key, text=text), key)
    k, number = clear_of(docs, "key_", "row_")
    bad = written(found.where("contaminated").groupBy(F.col(key).alias(k)).agg(F.count(F.lit(1)).alias("n")), "contaminated-keys")
    same = docs[key].eqNullSafe(F.col(k))
    clean = docs.join(bad.select(k), same, "left_anti")
    contaminated = bad.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shared = docs.join(bad.select(k), same, "left_semi")
    if shared.count() == contaminated:
        return clean
    numbered = written(shared.withColumn(number, F.monotonically_increasing_id()), "contaminated-suspects")
    again = contamination(benchmark_matches(numbered, items, key=number, text=text), number).where("contaminated")
    return clean.unionByName(numbered.join(again.select(number), number, "left_anti").select(*docs.columns))
