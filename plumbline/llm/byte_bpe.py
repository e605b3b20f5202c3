"""Byte-level BPE encoding with a segment tree over byte positions, and decoding, in Arrow functions."""

from __future__ import annotations

import base64
import re
from collections import ChainMap

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.storage import bounded_batches, clear_of
from plumbline.llm.words import slabs

STRETCH = 1 << 20  # characters of a long text looked at together
KNOWN_BYTES = 64 << 20  # of remembered units, their ids and what Python adds to them
KNOWN_UNIT = 256  # characters of the longest remembered unit
TOGETHER = 64  # bytes of the longest unit that is merged together with others
FOREST = 1 << 13  # units merged together
SPELLED = 1 << 16  # ids decoded together
NONE = 1 << 62

# Letters and numbers that the regex module knows and the library's older Unicode tables don't.
LATER_LETTERS = """
0558 058B-058C 088F 0C5C 0CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959
10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DF1 16EA0-16EB8 16EBB-16ED3 16FF2-16FF3 187F8-187FF 18CD6-18CDA
18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96
1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD
323B0-33479 3D000-3FC3F"""
LATER_NUMBERS = "11DE0-11DE9 1246F 12475-1247F 12550-12686 16FF4-16FF6"


def _members(ranges: str) -> str:
    """The inside of a character set."""
    return "".join("-".join(chr(int(code, 16)) for code in span.split("-")) for span in ranges.split())


class Units:
    """Matches of a pattern in the library's reading of letters and numbers; long texts come in stretches.

    A stretch ends before a white-space run that follows another character. For patterns that never put white
    space after another character into one match, and look ahead no further than white space, no match spans such a place.
    """

    def __init__(self, pattern: str):
        import regex

        self.plain = regex.compile(pattern)
        letters, numbers = (rf"[\p{{{kind}}}--[{_members(later)}]]" for kind, later in (("L", LATER_LETTERS), ("N", LATER_NUMBERS)))
        self.older = regex.compile(pattern.replace(r"\p{L}", letters).replace(r"\p{N}", numbers), regex.V1)
        self.later = re.compile(f"[{_members(LATER_LETTERS)}{_members(LATER_NUMBERS)}]")
        self.cut = regex.compile(r"(?<=\S)(?=\s)")

    def _has_later(self, part: str) -> bool:
        if part.isascii():
            return False
        try:
            part.encode("latin-1")
            return False
        except UnicodeEncodeError:
            return bool(self.later.search(part))

    def of(self, text: str):
        """The matches in order, a list for each stretch."""
        at = 0
        while at < len(text):
            end = at + STRETCH
            step = self.cut.search(text, end) if end < len(text) else None
            part = text[at:step.start() if step else len(text)]
            yield (self.older if self._has_later(part) else self.plain).findall(part)
            at += len(part)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merged(unit: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one unit: always the pair of the lowest rank, the leftmost of equal ones, becomes one token.

    Leaf i of the segment tree holds (rank, i) of the pair that begins at byte i, as one number; each inner node
    holds the least of its two, so the root is the next merge. A merge changes three leaves: the pair's own, that of the
    token it swallowed, and that of the live neighbour before it.
    """
    if unit in ranks:
        return [ranks[unit]]
    n = len(unit)
    leaves = 1 << (n - 1).bit_length()
    shift = leaves.bit_length()
    place = (1 << shift) - 1
    rank = ranks.get
    tree = [NONE] * (2 * leaves)
    for i in range(n - 1):
        found = rank(unit[i:i + 2])
        if found is not None:
            tree[leaves + i] = found << shift | i
    for node in range(leaves - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left < right else right
    after = list(range(1, n + 2))  # where the token that begins at i ends
    before = list(range(-1, n))  # where the token before it begins

    while tree[1] != NONE:
        i = tree[1] & place
        gone = after[i]
        end = after[i] = after[gone]
        if end < n:
            before[end] = i
            found = rank(unit[i:after[end]])
            own = NONE if found is None else found << shift | i
        else:
            own = NONE
        changes = [(gone, NONE), (i, own)]
        p = before[i]
        if p >= 0:
            found = rank(unit[p:end])
            changes.append((p, NONE if found is None else found << shift | p))
        for leaf, value in changes:
            node = leaves + leaf
            tree[node] = value
            while node > 1:
                other = tree[node ^ 1]
                if other < value:
                    value = other
                node >>= 1
                if tree[node] == value:
                    break
                tree[node] = value
    out, i = [], 0
    while i < n:
        out.append(ranks[unit[i:after[i]]])
        i = after[i]
    return out


class Pairs:
    """Rank of the token that two tokens make, as a hash table over whole arrays of pairs."""

    ABSENT = np.int32(2**31 - 1)

    def __init__(self, ranks: dict[bytes, int]):
        keys, values = [], []
        find = ranks.get
        self.stop = max(ranks.values()) + 1  # stands where no token is
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left = find(token[:cut])
                if left is not None:
                    right = find(token[cut:])
                    if right is not None:
                        keys.append(left * (self.stop + 1) + right)
                        values.append(rank)
        self.bits = max(4, (2 * len(keys)).bit_length())
        self.keys = np.full((1 << self.bits) + 1, -1, np.int64)
        self.values = np.full((1 << self.bits) + 1, self.ABSENT, np.int32)
        left, found = np.array(keys, np.int64), np.array(values, np.int32)
        slot = self._slot(left)
        while len(left):  # every key goes on to the next slot until it has one of its own
            free = np.flatnonzero(self.keys[slot] == -1)
            _, first = np.unique(slot[free], return_index=True)
            took = free[first]
            self.keys[slot[took]], self.values[slot[took]] = left[took], found[took]
            rest = np.ones(len(left), bool)
            rest[took] = False
            left, found, slot = left[rest], found[rest], (slot[rest] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left.astype(np.int64) * (self.stop + 1) + right
        slot = self._slot(wanted)
        seen = self.keys[slot]
        out = np.where(seen == wanted, self.values[slot], self.ABSENT)
        open_ = np.flatnonzero((seen != wanted) & (seen != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            seen = self.keys[slot[open_]]
            hit = seen == wanted[open_]
            out[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (seen != -1)]
        return out


def merged_together(units: list[bytes], width: int, pairs: Pairs, single: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all units in order, and how many each has: :func:`merged` for units of up to ``width`` bytes side by side.

    Each unit has a segment tree of ``width`` leaves, one row of a matrix; a round takes the root of every tree that still has
    a pair, and updates the three leaves of each merge and the nodes above them for all trees at once.
    """
    count, absent = len(units), Pairs.ABSENT
    lengths = np.fromiter(map(len, units), np.int64, count)
    ids = np.full((count, width + 2), pairs.stop, np.int32)  # the last two columns: behind the end, and before the begin
    inside = np.arange(width) < lengths[:, None]
    ids[:, :width][inside] = single[np.frombuffer(b"".join(units), np.uint8)]
    alive = inside.copy()
    after = np.tile(np.minimum(np.arange(1, width + 3), width), (count, 1))
    before = np.tile(np.concatenate([[width + 1], np.arange(width + 1)]), (count, 1))
    shift = width.bit_length()
    place = (1 << shift) - 1

    def key(rank: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.where(rank == absent, absent, rank << shift | at).astype(np.int32)

    tree = np.full((count, 2 * width), absent, np.int32)
    leaf = np.arange(width)
    tree[:, width:] = key(pairs.rank(ids[:, :width].ravel(), ids[:, 1:width + 1].ravel()), np.tile(leaf, count)).reshape(count, width)
    node = width
    while node > 1:
        tree[:, node // 2:node] = np.minimum(tree[:, node:2 * node:2], tree[:, node + 1:2 * node:2])
        node //= 2

    flat_ids, flat_after, flat_before, flat_alive, flat_tree = (m.reshape(-1) for m in (ids, after, before, alive, tree))
    rows = np.flatnonzero(tree[:, 1] != absent)
    while len(rows):
        best = tree[rows, 1]
        at, wide, narrow, top = best & place, rows * (width + 2), rows * width, rows * 2 * width
        gone = flat_after[wide + at]
        end = flat_after[wide + gone]
        merged_id = best >> shift
        flat_ids[wide + at] = merged_id
        flat_after[wide + at] = end
        flat_before[wide + end] = at
        flat_alive[narrow + gone] = False
        previous = flat_before[wide + at]
        first = previous == width + 1
        left = key(pairs.rank(flat_ids[wide + previous], merged_id), previous)
        own = key(pairs.rank(merged_id, flat_ids[wide + end]), at)
        flat_tree[top + width + gone] = absent
        flat_tree[top + width + at] = own
        kept = np.flatnonzero(~first)
        flat_tree[(top + width + previous)[kept]] = left[kept]
        base = np.concatenate([top, top, top[kept]])
        node = np.concatenate([gone, at, previous[kept]]) + width
        while True:
            node >>= 1
            if not node[0]:
                break
            spot = base + 2 * node
            flat_tree[base + node] = np.minimum(flat_tree[spot], flat_tree[spot + 1])
        rows = rows[tree[rows, 1] != absent]
    return ids[:, :width][alive], alive.sum(axis=1)


class Encoder:
    """Ids of texts as little-endian 32-bit numbers; short units are remembered up to a number of bytes."""

    def __init__(self, path: str, pattern: str):
        self.ranks, self.units = read_ranks(path), Units(pattern)
        self.pairs = Pairs(self.ranks)
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.known: dict[str, bytes] = {}
        self.held = 0

    def encode(self, units) -> dict[str, bytes]:
        """Ids of different units: those that are tokens, short ones together by width, long ones one by one."""
        out: dict[str, bytes] = {}
        by_width: dict[int, list[tuple[str, bytes]]] = {}
        for unit in units:
            spelled = unit.encode()
            if spelled in self.ranks:
                out[unit] = self.ranks[spelled].to_bytes(4, "little")
            elif len(spelled) <= TOGETHER:
                by_width.setdefault(1 << (len(spelled) - 1).bit_length(), []).append((unit, spelled))
            else:
                out[unit] = np.array(merged(spelled, self.ranks), "<i4").tobytes()
        for width, several in by_width.items():
            for at in range(0, len(several), FOREST):
                part = several[at:at + FOREST]
                ids, counts = merged_together([spelled for _, spelled in part], width, self.pairs, self.single)
                data, ends = ids.astype("<i4").tobytes(), (4 * np.cumsum(counts)).tolist()
                start = 0
                for (unit, _), end in zip(part, ends, strict=True):
                    out[unit] = data[start:end]
                    start = end
        return out

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        if self.held > KNOWN_BYTES:
            self.known.clear()
            self.held = 0
        cut = [list(self.units.of(text)) for text in texts]
        fresh = {u for parts in cut for units in parts for u in units}.difference(self.known)
        found = self.encode(fresh)
        short = found if max(map(len, fresh), default=0) <= KNOWN_UNIT else {u: ids for u, ids in found.items() if len(u) <= KNOWN_UNIT}
        self.known.update(short)
        self.held += sum(4 * len(u) + len(ids) + 200 for u, ids in short.items())
        known = self.known if len(short) == len(found) else ChainMap(self.known, found)
        return [b"".join([known[u] for units in parts for u in units]) for parts in cut]


def _encoded(path: str, pattern: str, text: str):
    def run(batches):
        encoder = Encoder(path, pattern)
        for batch in batches:
            for _, part in slabs(batch, text, 1 << 20):
                found = encoder.ids([t or "" for t in part.column(text).to_pylist()])
                ends = np.zeros(len(found) + 1, np.int32)
                np.cumsum([len(ids) // 4 for ids in found], out=ends[1:])
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), "<i4"), pa.int32()))
                kept = part.drop_columns([text])
                yield pa.RecordBatch.from_arrays([*kept.columns, ids], [*kept.schema.names, "ids"])
    return run


def encoded(docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``ids`` (array of int) of every row's whole text.

    ``ranks`` is the path of a rank file (a token in base64 and its rank a line) that every executor can read and that has
    every single byte; ``pattern`` cuts a text into units, each encoded by itself, without special tokens. Null and empty texts
    have no ids. Null and repeated keys come out row by row; other columns aren't read. Nothing is shuffled. A task
    holds the ids of about 1 MB of text (one row at least); a unit of n bytes takes O(n log n) steps, whatever its bytes.
    """
    bounded_batches(docs.sparkSession)
    k, ids = clear_of(docs.select(text), "key", "ids")
    plain = docs.select(F.col(key).alias(k), F.col(text))
    kind = plain.schema[k].dataType.simpleString()
    found = plain.mapInArrow(_encoded(ranks, pattern, text), f"{k} {kind}, ids array<int>")
    return found.select(F.col(k).alias(key), "ids")


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows in order, and the offsets of the rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    counts = pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    offsets = np.zeros(len(column) + 1, np.int64)
    np.cumsum(counts, out=offsets[1:])
    return column.flatten().to_numpy(zero_copy_only=False), offsets


def _binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Rows of bytes from all bytes and the rows' offsets."""
    wide = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])
    return wide.cast(pa.binary())


def decoded(ids: Column, ranks: str) -> Column:
    """The bytes that an array of ids stands for; null and empty arrays have none. An id that isn't in the file stops the job."""
    tables: list[tuple[np.ndarray, np.ndarray]] = []

    @F.arrow_udf("binary")
    def spelled(column: pa.Array) -> pa.Array:
        if not tables:
            tokens = sorted(read_ranks(ranks).items(), key=lambda item: item[1])
            if [rank for _, rank in tokens] != list(range(len(tokens))):
                raise ValueError("ranks aren't 0, 1, 2 ...")
            starts = np.zeros(len(tokens) + 1, np.int64)
            np.cumsum([len(token) for token, _ in tokens], out=starts[1:])
            tables.append((np.frombuffer(b"".join(token for token, _ in tokens), np.uint8), starts))
        data, starts = tables[0]
        flat, offsets = _flat(column)
        if len(flat) and not 0 <= flat.min() <= flat.max() < len(starts) - 1:
            raise ValueError("an id isn't in the rank file")
        ends = np.zeros(len(flat) + 1, np.int64)
        np.cumsum(starts[flat + 1] - starts[flat], out=ends[1:])
        out = np.empty(ends[-1], np.uint8)
        for at in range(0, len(flat), SPELLED):
            some = flat[at:at + SPELLED]
            own = ends[at:at + SPELLED + 1]
            place = np.arange(own[0], own[-1]) + np.repeat(starts[some] - own[:-1], np.diff(own))
            np.take(data, place, out=out[own[0]:own[-1]])
        return _binary(out, ends[offsets])

    return spelled(ids)


def id_bytes(ids: Column) -> Column:
    """An array of ids as little-endian unsigned 32-bit integers."""
    @F.arrow_udf("binary")
    def packed(column: pa.Array) -> pa.Array:
        flat, offsets = _flat(column)
        return _binary(flat.astype("<u4").view(np.uint8), offsets * 4)

    return packed(ids)
