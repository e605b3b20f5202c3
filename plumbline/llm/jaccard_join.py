"""Similarity self-join of texts on word n-gram sets by signature trees.

1. Every text becomes its set of n-gram hashes; texts with equal sets form a class.
2. Routing, without loss: in one order of all members, rarest first, linked sets share at least one of their first
   ``size - ceil(t * size) + 1`` members, and as many more as their sizes and some members beyond (``prefix_size``) let prove
   (``least_shared``). These, sent to hash buckets as packed arrays, are counted for each pair of classes; pairs that share enough
   join classes into clusters outside which no link can be. Members of more than ``PAIRED`` sets join all of their sets,
   uncounted. The order comes from two tables of bounded size over all texts: counts of the most frequent members, and of words
   by cells of the hash range, for what a member's words let expect. What the tables blur only makes clusters larger.
3. Signature trees: within a cluster, nodes hold the OR of their sets' bitmaps and a size range. A dual
   traversal drops node pairs whose largest possible overlap is too small, and pairs already in one component.
   Large clusters are cut into blocks that share the cluster's first class; block pairs are compared only for
   classes that this has not joined.
4. Links (a spanning set of them) give components.

Set members are 64-bit hashes. Within two compared texts an accidental equality has a chance below 1e-7.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from plumbline.llm.components import components
from plumbline.llm.storage import bounded_batches, buckets_for, clear_of, written
from plumbline.llm.words import leveled_sets, mix, shingle_sets, word_cells

FREQUENT = 2_000_000  # members at most whose counts are shared
CELLS = 1 << 16  # of words, counted together
MIN_COUNT = 4  # below it, members count as equally rare
TOGETHER = 4_000_000  # members of texts looked at together
SALT_SETS = 50_000  # sets of one member in one bucket
PAIRED = 64  # sets of one member at most whose pairs are counted
PAIRS_TOGETHER = 4_000_000  # pairs counted together
BEYOND = 64  # a set of so many members routes one more than a link needs
LEAF, FAN = 16, 4
FILTER_BITS = 1 << 28  # of the filter of wanted keys, at most
BLOCK_CLASSES, BLOCK_MEMBERS = 2048, 16_000_000  # of one task: 128 MB of members


def set_key(members: np.ndarray) -> tuple[int, int]:
    """128-bit key of a set, as two signed longs."""
    a, b = members.sum(dtype=np.uint64), ((members ^ (members >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def prefix_size(size, num: int, den: int):
    """Members that a set of ``size`` is routed by: enough for a link, and one in ``BEYOND`` more."""
    return np.minimum(size, size - -(-num * size // den) + 1 + size // BEYOND)


def least_shared(a, b, num: int, den: int):
    """First members that linked sets of sizes ``a`` and ``b`` have in common at least.

    Of the members in common, all up to the end of the prefix that ends first are in both; the set of that prefix has
    ``size - prefix_size`` members beyond it.
    """
    common = -(-num * (a + b) // (num + den))
    return common - np.maximum(a - prefix_size(a, num, den), b - prefix_size(b, num, den))


class Order:
    """All members in one order: by their shared count, then by how common their words are, then by hash."""

    def __init__(self, members: np.ndarray, counts: np.ndarray):
        at = np.argsort(members)
        self.members, self.counts = members[at], counts[at]

    def count(self, members: np.ndarray) -> np.ndarray:
        if not len(self.members):
            return np.zeros(len(members), np.int64)
        at = np.searchsorted(self.members, members)
        at[at == len(self.members)] = 0
        return np.where(self.members[at] == members, self.counts[at], 0)

    def prefix(self, members: np.ndarray, levels: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
        """The first members of an ascending set, ``prefix_size`` of them, and their counts."""
        wanted = prefix_size(len(members), num, den)
        order = np.argsort(levels, kind="stable")
        members, levels = members[order], levels[order]
        for looked_at in (2 * wanted, len(members)):
            counts = self.count(members[:looked_at])
            rare = np.flatnonzero(counts == 0)
            if len(rare) >= wanted:
                return members[rare[:wanted]], np.zeros(wanted, np.int64)
        first = np.argsort(counts, kind="stable")[:wanted]
        return members[first], counts[first]


def word_levels(cells: np.ndarray) -> np.ndarray:
    """Binary logarithm, in eighths, of the words counted in each cell."""
    return np.minimum(255, 8 * np.log2(1 + cells)).astype(np.uint8)


def _distinct_sets(batches, text: str, n: int, levels: np.ndarray) -> Iterator[list[tuple[int, np.ndarray, np.ndarray]]]:
    """Groups of (first half of the key, members, levels) of the non-empty sets; copies within a group are left out."""
    group, seen, held = [], set(), 0
    for batch in batches:
        for members, level in leveled_sets(batch, text, n, levels):
            key = set_key(members)
            if len(members) and key not in seen:
                seen.add(key)
                group.append((key[0], members, level))
                held += len(members)
                if held >= TOGETHER:
                    yield group
                    group, seen, held = [], set(), 0
    if group:
        yield group


def _by_bucket(buckets: int, to: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """(bucket, bytes of each column) of the rows of every bucket."""
    order = np.argsort(to, kind="stable")
    to, columns = to[order], [c[order] for c in columns]
    cuts = np.flatnonzero(np.r_[True, to[1:] != to[:-1], True]) if len(to) else [0]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield int(to[a]), *(c[a:b].tobytes() for c in columns)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_COUNTED = pa.schema([("bucket", pa.int32()), ("members", pa.binary()), ("counts", pa.binary())])


def _repeated_members(text: str, n: int, buckets: int):
    """Members that several sets of a group have, with their counts, by bucket."""
    def run(batches):
        for group in _distinct_sets(batches, text, n, np.zeros(2, np.uint8)):
            members, counts = np.unique(np.concatenate([g[1] for g in group]), return_counts=True)
            members, counts = members[counts > 1], counts[counts > 1]
            yield _batch(list(_by_bucket(buckets, (members % np.uint64(buckets)).astype(np.int32), members, counts)), _COUNTED)
    return run


def _frequent_members(key, table):
    """A bucket's members with their counts added up, from ``MIN_COUNT`` on, by power of two of the count."""
    members = np.concatenate([np.frombuffer(x, np.uint64) for x in table["members"].to_pylist()])
    counts = np.concatenate([np.frombuffer(x, np.int64) for x in table["counts"].to_pylist()])
    members, place = np.unique(members, return_inverse=True)
    counts = np.bincount(place, counts).astype(np.int64)
    members, counts = members[counts >= MIN_COUNT], counts[counts >= MIN_COUNT]
    level = np.log2(counts).astype(np.int32)
    rows = list(_by_bucket(64, level, members, counts))
    return pa.table({"level": pa.array([r[0] for r in rows], pa.int32()), "members": pa.array([r[1] for r in rows], pa.binary()), "counts": pa.array([r[2] for r in rows], pa.binary())})


def member_order(texts: DataFrame, n: int, buckets: int) -> Order:
    """The order of members by their counts over all texts. Only the ``FREQUENT`` most frequent, at most, come to the driver."""
    found = texts.mapInArrow(_repeated_members("text", n, buckets), "bucket int, members binary, counts binary")
    found = written(found.groupBy("bucket").applyInArrow(_frequent_members, "level int, members binary, counts binary"), "jaccard-frequent")
    levels = found.groupBy("level").agg(F.sum(F.octet_length("members")).alias("bytes")).collect()
    least, held = 64, 0
    for level, size in sorted(levels, reverse=True):
        held += size // 8
        if held > FREQUENT:
            break
        least = level
    rows = [(r["members"], r["counts"]) for r in found.where(F.col("level") >= least).toLocalIterator()]
    return Order(*(np.concatenate([np.frombuffer(r[i], kind) for r in rows]) if rows else np.empty(0, kind) for i, kind in ((0, np.uint64), (1, np.int64))))


def _sets_of(n: int, id_type: pa.DataType):
    """Set keys and sizes of the texts, and after each batch a row with the cells of its words."""
    schema = pa.schema([("id", id_type), ("h1", pa.int64()), ("h2", pa.int64()), ("n_shingles", pa.int64()), ("cells", pa.binary())])

    def run(batches):
        cells = np.zeros(CELLS, np.int64)
        for batch in batches:
            keys, sizes = [], []
            for members in shingle_sets(batch, "text", n):
                keys.append(set_key(members))
                sizes.append(len(members))
            cells += word_cells(batch, "text", CELLS)
            a, b = (pa.array([k[i] for k in keys], pa.int64()) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([batch.column("id"), a, b, pa.array(sizes, pa.int64()), pa.nulls(len(keys), pa.binary())], schema=schema)
        yield _batch([(None, None, None, None, cells.tobytes())], schema)
    return run


def _added_cells(key, table):
    out = np.zeros(CELLS, np.int64)
    for part in table["cells"].to_pylist():
        out += np.frombuffer(part, np.int64)
    return pa.table({"cells": pa.array([out.tobytes()], pa.binary())})


def counted_cells(counted: DataFrame) -> np.ndarray:
    """Words in each cell over all texts; partial sums are added in groups before the driver adds those."""
    out = np.zeros(CELLS, np.int64)
    groups = counted.withColumn("lot", F.pmod(F.monotonically_increasing_id(), F.lit(64)))
    for row in groups.groupBy("lot").applyInArrow(_added_cells, "cells binary").toLocalIterator():
        out += np.frombuffer(row["cells"], np.int64)
    return out


def _with_set_keys(text: str, n: int, a: str, b: str):
    def run(batches):
        for batch in batches:
            keys = [set_key(members) for members in shingle_sets(batch, text, n)]
            found = [pa.array([k[i] for k in keys], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], [*batch.schema.names, a, b])
    return run


_PREFIXES = pa.schema([("bucket", pa.int32()), ("salted", pa.bool_()), ("members", pa.binary()), ("owners", pa.binary()), ("sizes", pa.binary())])


def _prefixes(shared, text: str, n: int, num: int, den: int, buckets: int):
    """First members of every set with the set's key and size, by bucket; sets of a very frequent one are spread."""
    def run(batches):
        *frequent, levels = shared.value
        order = Order(*frequent)
        for group in _distinct_sets(batches, text, n, levels):
            found = [order.prefix(members, level, num, den) for _, members, level in group]
            sizes = [len(f[0]) for f in found]
            member, count = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
            owner = np.repeat(np.array([g[0] for g in group], np.int64), sizes)
            size = np.repeat(np.array([len(g[1]) for g in group], np.uint32), sizes)
            spread = (1 + count // SALT_SETS).astype(np.uint64)
            salt = mix(owner.astype(np.uint64), 17) % spread
            to = (mix(member + salt * np.uint64(0x9E3779B97F4A7C15), 19) % np.uint64(buckets)).astype(np.int32)
            rows = []
            for salted in (False, True):
                own = (spread > 1) == salted
                rows += [(r[0], salted, *r[1:]) for r in _by_bucket(buckets, to[own], member[own], owner[own], size[own])]
            yield _batch(rows, _PREFIXES)
    return run


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest reachable) of the edges' ends, for nodes that aren't their own smallest."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = np.arange(len(nodes))
    x, y = ends[:len(a)], ends[len(a):]
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _added(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values with their counts added up."""
    values, place = np.unique(np.concatenate([p[0] for p in pairs]), return_inverse=True)
    return values, np.bincount(place, np.concatenate([p[1] for p in pairs]), len(values)).astype(np.int64)


def _pairs_of_lists(owner: np.ndarray, size: np.ndarray, ends: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of owners (small integers) in one list whose sizes allow a link, each as ``smaller << 32 | larger``, with the number of lists.

    Lists follow each other, ``ends`` has the end of the own list at each place, and sizes ascend in a list.
    """
    found, held = [], 0
    places = np.arange(len(owner))
    step = 1
    while len(places):
        places = places[places + step < ends[places]]
        other = places + step
        near = den * size[places] >= num * size[other]
        places, other = places[near], other[near]  # further ones are larger still
        found.append((owner[places] << 32 | owner[other], np.ones(len(places), np.int64)))
        held += len(places)
        if held >= PAIRS_TOGETHER:
            found = [_added(found)]
            held = 0
        step += 1
    return _added(found) if found else (np.empty(0, np.int64), np.empty(0, np.int64))


def _shared(num: int, den: int):
    """Pairs of classes that share members of a bucket, with how many and how many a link needs in all buckets.

    Members of more than ``PAIRED`` sets, and those dealt over several buckets, need none: each of their classes comes with the smallest it
    is joined to by them. Sizes that differ too much for a link end a member's list.
    """
    def run(key, table):
        member, owner, size = (np.concatenate([np.frombuffer(x, kind) for x in table[c].to_pylist()])
                               for c, kind in (("members", np.uint64), ("owners", np.int64), ("sizes", np.uint32)))
        salted = np.repeat(table["salted"].to_numpy(), [len(x) // 8 for x in table["members"].to_pylist()])
        order = np.argsort(member)
        step = member[order][1:] == member[order][:-1]
        order = order[(np.r_[step, False] | np.r_[False, step] | salted[order]) if len(order) else []]
        order = order[np.lexsort((owner[order], size[order], member[order]))]
        member, owner, size, salted = member[order], owner[order], size[order].astype(np.int64), salted[order]
        new = np.r_[True, (member[1:] != member[:-1]) | (owner[1:] != owner[:-1])][:len(member)]  # groups repeat sets
        member, owner, size, salted = member[new], owner[new], size[new], salted[new]
        # sizes ascend: where a step is too large for a link, no link crosses it
        cut = np.flatnonzero(np.r_[True, (member[1:] != member[:-1]) | (den * size[:-1] < num * size[1:]), True]) if len(member) else np.zeros(1, np.int64)
        ends = np.repeat(cut[1:], np.diff(cut))
        many = salted | (np.repeat(np.diff(cut), np.diff(cut)) > PAIRED)
        same = many[1:] & (ends[1:] == ends[:-1])
        a, b = owner[1:][same], owner[:-1][same]
        if salted.any():  # the buckets of one member meet in a node that stands for it
            a, b = np.r_[a, owner[salted]], np.r_[b, mix(member[salted], 23).astype(np.int64)]
        a, b = _forest(a, b) if len(a) else (a, b)

        few = ~many
        names, place = np.unique(owner[few], return_inverse=True)
        sizes = np.zeros(len(names), np.int64)
        sizes[place] = size[few]
        left = np.cumsum(few) if len(few) else np.zeros(0, np.int64)
        pairs, counts = _pairs_of_lists(place.astype(np.int64), size[few], left[ends[few] - 1], num, den)
        x, y = pairs >> 32, pairs & 0xFFFFFFFF
        need = least_shared(sizes[x], sizes[y], num, den)
        columns = (np.r_[a, names[x]], np.r_[b, names[y]], np.r_[np.zeros(len(a), np.int64), counts], np.r_[np.zeros(len(a), np.int64), need])
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("a", "b", "shared", "need"), columns, strict=True)})
    return run


class Tree:
    """Dual traversal of the signature tree over some sets, with components as it goes."""

    def __init__(self, sets: list[np.ndarray], num: int, den: int, labels: list[int]):
        self.num, self.den = num, den
        order = sorted(range(len(sets)), key=lambda i: (labels[i], len(sets[i]), int(sets[i][0])))
        self.order, self.sets = order, [sets[i] for i in order]
        self.label = np.unique(np.array([labels[i] for i in order]), return_inverse=True)[1]
        self.size = np.array([len(s) for s in self.sets])
        width = 1 << max(9, int(4 * self.size.max() - 1).bit_length())
        self.bits = np.zeros((len(sets), min(width, 1 << 17) // 64), np.uint64)
        for row, s in zip(self.bits, self.sets, strict=True):
            at = mix(s, 5) % np.uint64(64 * len(row))
            np.bitwise_or.at(row, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        self.excess = self.size - np.bitwise_count(self.bits).sum(axis=1).astype(np.int64)
        self.links: list[tuple[int, int]] = []
        self.nodes: dict[tuple[int, int], tuple] = {}

    def node(self, x: tuple[int, int]) -> tuple:
        """OR of the bitmaps, least and greatest size, most members beyond one a bit."""
        if x not in self.nodes:
            part = slice(*x)
            self.nodes[x] = (np.bitwise_or.reduce(self.bits[part], axis=0), self.size[part].min(), self.size[part].max(), self.excess[part].max())
        return self.nodes[x]

    def possible(self, x: tuple[int, int], y: tuple[int, int]) -> bool:
        """No two sets of the nodes can have more in common than the shared bits and the members beyond one a bit."""
        a, b = self.node(x), self.node(y)
        if self.den * min(a[2], b[2]) < self.num * max(a[1], b[1]):
            return False
        most = min(int(np.bitwise_count(a[0] & b[0]).sum()) + min(a[3], b[3]), a[2], b[2])
        return most * (self.num + self.den) >= self.num * (a[1] + b[1])

    def settled(self, x: tuple[int, int], y: tuple[int, int]) -> bool:
        first = self.label[x[0]]
        return bool((self.label[slice(*x)] == first).all() and (self.label[slice(*y)] == first).all())

    def split(self, x: tuple[int, int]) -> list[tuple[int, int]]:
        step = LEAF
        while step * FAN < x[1] - x[0]:
            step *= FAN
        return [(a, min(a + step, x[1])) for a in range(x[0], x[1], step)]

    def pairs(self, x: tuple[int, int], y: tuple[int, int], across) -> None:
        """Exact comparison of the sets of two leaves."""
        for i in range(*x):
            js = np.arange(max(y[0], i + 1) if x == y else y[0], y[1])
            js = js[self.label[js] != self.label[i]]
            if across is not None and len(js):
                js = js[across[js] | across[i]]
            if not len(js):
                continue
            common = np.bitwise_count(self.bits[js] & self.bits[i]).sum(axis=1) + np.minimum(self.excess[js], self.excess[i])
            most = np.minimum(common, np.minimum(self.size[js], self.size[i]))
            for j in js[most * (self.num + self.den) >= self.num * (self.size[js] + self.size[i])].tolist():
                if self.label[i] == self.label[j]:
                    continue
                overlap = len(np.intersect1d(self.sets[i], self.sets[j], assume_unique=True))
                if self.den * overlap >= self.num * int(self.size[i] + self.size[j] - overlap):
                    self.links.append((self.order[i], self.order[j]))
                    self.label[self.label == self.label[j]] = self.label[i]

    def join(self, across: list[bool] | None = None) -> list[tuple[int, int]]:
        """Links that connect whatever the full set of links connects; with ``across``, of pairs with a marked set only."""
        marked = None if across is None else np.array([across[i] for i in self.order])
        todo = [((0, len(self.sets)), (0, len(self.sets)))]
        while todo:
            x, y = todo.pop()
            if self.settled(x, y) or (x != y and not self.possible(x, y)):
                continue
            if marked is not None and not (marked[slice(*x)].any() or marked[slice(*y)].any()):
                continue
            if x[1] - x[0] <= LEAF and y[1] - y[0] <= LEAF:
                self.pairs(x, y, marked)
            elif x == y:
                parts = self.split(x)
                todo += [(a, b) for i, a in enumerate(parts) for b in parts[i + 1:]][::-1]
                todo += [(a, a) for a in parts][::-1]
            elif x[1] - x[0] >= y[1] - y[0]:
                todo += [(a, y) for a in self.split(x)][::-1]
            else:
                todo += [(x, b) for b in self.split(y)][::-1]
        return self.links


def _tree_links(n: int, num: int, den: int):
    def run(key, table):
        rows = list(zip(*(table[c].to_pylist() for c in ("cluster", "class_id", "h1", "h2", "label", "marked")), strict=True))
        units: dict[int, dict] = {}
        place = 0
        for batch in table.select(["text"]).combine_chunks().to_batches():
            for members in shingle_sets(batch, "text", n):
                cluster, class_id, h1, h2, label, marked = rows[place]
                place += 1
                if len(members) and set_key(members) == (h1, h2):  # else another row under the same id
                    units.setdefault(cluster, {})[class_id] = (members, label, bool(marked))
        a, b = [], []
        for unit in units.values():
            if len(unit) > 1:
                ids, found = list(unit), list(unit.values())
                across = [f[2] for f in found]
                tree = Tree([f[0] for f in found], num, den, [f[1] for f in found])
                for i, j in tree.join(None if all(across) else across):
                    a.append(ids[i])
                    b.append(ids[j])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return run


def _trees(units: DataFrame, n: int, num: int, den: int) -> DataFrame:
    return units.groupBy("unit").applyInArrow(_tree_links(n, num, den), "a long, b long")


def _marked_bits(step: int):
    """A part of the filter: its bits as bytes."""
    def run(key, table):
        bits = np.zeros(step, bool)
        bits[table["at"].to_numpy() % step] = True
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})
    return run


def _places(key: str, size: int) -> list[Column]:
    """Two places of a key in a filter of ``size`` bits."""
    return [F.pmod(F.xxhash64(F.lit(salt), key), F.lit(size)) for salt in (3, 4)]


def _may_be_wanted(shared, columns: list[str]):
    def run(batches):
        bits = shared.value
        for batch in batches:
            a, b = (batch.column(c).to_numpy() for c in ("place_a", "place_b"))
            held = [(bits[x >> 3] >> (7 - (x & 7)).astype(np.uint8)) & 1 for x in (a, b)]
            yield batch.select(columns).filter(pa.array((held[0] & held[1]).astype(bool)))
    return run


def _with_texts(units: DataFrame, plain: DataFrame) -> DataFrame:
    """The rows of ``units`` with the text of their ``rep``.

    A Bloom filter of the keys wanted, of at most ``FILTER_BITS``, keeps most other texts out of the shuffle; what it lets through
    by mistake, the join drops.
    """
    spark = units.sparkSession
    units = written(units, "jaccard-units")
    size = 1 << max(16, min(FILTER_BITS.bit_length() - 1, (16 * units.count()).bit_length()))
    step = size // 64
    at = units.select(F.explode(F.array(*_places("rep", size))).alias("at")).distinct().withColumn("part", F.expr(f"at div {step}"))
    bits = np.zeros(size // 8, np.uint8)
    for row in at.groupBy("part").applyInArrow(_marked_bits(step), "part long, bits binary").toLocalIterator():
        bits[row["part"] * step // 8:(row["part"] + 1) * step // 8] = np.frombuffer(row["bits"], np.uint8)
    a, b = _places("id", size)
    kind = plain.schema["id"].dataType.simpleString()
    texts = plain.select(F.col("id").alias("rep_id"), "text", a.alias("place_a"), b.alias("place_b"))
    texts = texts.mapInArrow(_may_be_wanted(spark.sparkContext.broadcast(bits), ["rep_id", "text"]), f"rep_id {kind}, text string")
    return units.join(texts, F.col("rep").eqNullSafe(F.col("rep_id")), "inner")


def similarity_classes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, num: int = 4, den: int = 5,
    block_classes: int = BLOCK_CLASSES, block_members: int = BLOCK_MEMBERS,
) -> DataFrame:
    """The key of every row with ``h1`` and ``h2`` (key of its set), ``n_shingles``, ``class_id`` and ``component_id``.

    Rows are linked when ``den * overlap >= num * union`` of their sets of distinct ``words``-word shingles
    (words: runs without ASCII white space, A-Z lower-cased). ``component_id`` is the smallest key reachable by links;
    ``class_id`` is equal for rows with equal sets. Null and empty texts have an empty set and are linked
    with nothing: their ``component_id`` is their own key. A null key keeps its row, counts as larger than any other, and
    is the component only where all keys are null. Repeated rows come out repeated. Other columns are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark, "8m")
    plain = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    kind = plain.schema["id"].dataType.simpleString()
    id_type = to_arrow_type(plain.schema["id"].dataType)
    sets = plain.mapInArrow(_sets_of(words, id_type), f"id {kind}, h1 long, h2 long, n_shingles long, cells binary")
    sets = written(sets.withColumn("row_no", F.monotonically_increasing_id()), "jaccard-sets")
    counted = sets.where("cells IS NOT NULL").select("cells")
    sets = sets.where("cells IS NULL").drop("cells")
    total = sets.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    classes = sets.where("n_shingles > 0").groupBy("h1", "h2").agg(
        F.min("row_no").alias("class_id"), F.min("id").alias("rep"), F.first("n_shingles").alias("members"))
    classes = written(classes, "jaccard-classes")

    buckets = buckets_for(total // 5, 750_000, spark)
    order = member_order(plain.select("text"), words, buckets)
    order = spark.sparkContext.broadcast((order.members, order.counts, word_levels(counted_cells(counted))))
    packed = plain.select("text").mapInArrow(
        _prefixes(order, "text", words, num, den, buckets), "bucket int, salted boolean, members binary, owners binary, sizes binary")
    shared = packed.groupBy("bucket").applyInArrow(_shared(num, den), "a long, b long, shared long, need long")
    shared = shared.groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.min("need").alias("need")).where("shared >= need")
    clusters = components(shared, "jaccard-clusters").select(F.col("node").alias("h1"), F.col("root").alias("cluster"))
    routed = written(classes.join(clusters, "h1"), "jaccard-routed")

    blocks = routed.groupBy("cluster").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / block_classes), F.ceil(F.sum("members") / block_members)).alias("blocks"),
        F.min("class_id").alias("pivot"))
    routed = routed.join(blocks, "cluster").withColumn("block", F.pmod(F.xxhash64("class_id"), F.col("blocks")))
    routed = written(routed, "jaccard-blocks")
    bins = buckets_for(total, 8_000_000, spark)
    at = F.when(F.col("blocks") == 1, F.array(F.lit(0).cast("long"))).when(
        F.col("class_id") == F.col("pivot"), F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array("block"))
    bin_of = F.pmod(F.xxhash64("cluster"), F.lit(bins))
    columns = ("unit", "cluster", "class_id", "h1", "h2", "label", "marked", "text")
    units = routed.withColumn("at", F.explode(at)).withColumn(
        "unit", F.when(F.col("blocks") == 1, F.concat(F.lit("bin "), bin_of)).otherwise(F.concat_ws(" ", "cluster", "at")))
    units = units.select(*columns[:5], F.col("class_id").alias("label"), F.lit(True).alias("marked"), "rep")
    links = _trees(_with_texts(units, plain).select(*columns), words, num, den)
    links = written(links, "jaccard-links")
    roots = components(links, "jaccard-components")

    if routed.where("blocks > 1").limit(1).count():
        big = routed.where("blocks > 1").join(roots, F.col("class_id") == F.col("node"), "left").withColumn(
            "label", F.coalesce("root", "class_id"))
        sizes = big.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("n"))
        main = sizes.groupBy("cluster").agg(F.max(F.struct("n", "label")).alias("top")).select("cluster", F.col("top.label").alias("main"))
        big = written(big.join(main, "cluster").withColumn("minor", F.col("label") != F.col("main")), "jaccard-minor")
        chunks = big.where("minor").groupBy("cluster").agg(
            F.greatest(F.ceil(F.count(F.lit(1)) / block_classes), F.ceil(F.sum("members") / block_members)).alias("chunks"))
        if chunks.limit(1).count():
            both = big.join(chunks, "cluster").withColumn("chunk", F.pmod(F.xxhash64("class_id", F.lit(1)), F.col("chunks")))
            span = lambda c: F.sequence(F.lit(0).cast("long"), F.col(c) - 1)
            here = F.transform(span("chunks"), lambda c: F.struct(F.col("block").alias("x"), c.alias("y"), F.lit(False).alias("marked")))
            minor = F.transform(span("blocks"), lambda b: F.struct(b.alias("x"), F.col("chunk").alias("y"), F.lit(True).alias("marked")))
            placed = both.withColumn("place", F.explode(here)).unionByName(both.where("minor").withColumn("place", F.explode(minor)))
            placed = placed.groupBy("cluster", "class_id", "h1", "h2", "label", "rep", "place.x", "place.y").agg(F.max("place.marked").alias("marked"))
            placed = placed.withColumn("unit", F.concat_ws(" ", "cluster", "x", "y"))
            more = written(_trees(_with_texts(placed, plain).select(*columns), words, num, den), "jaccard-links")
            roots = components(links.unionByName(more), "jaccard-components")

    named = classes.join(roots, F.col("class_id") == F.col("node"), "left").select(
        "h1", "h2", "class_id", "rep", F.coalesce("root", "class_id").alias("root"))
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "root").select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), "class_id", "component_id")
    found = sets.join(named, (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")) & (F.col("n_shingles") > 0), "left")
    return found.select(
        F.col("id").alias(key), "h1", "h2", "n_shingles", F.coalesce("class_id", "row_no").alias("class_id"),
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose key is the smallest of their component.

    Texts without words are linked with nothing, so each stays. Rows with the same key and set count as one text,
    and any one of them stays; rows with a null key stay where their component has no other key.
    """
    found = similarity_classes(docs, key, text, words, num, den)
    k, a, b, x, y = clear_of(docs, "key_", "set_a", "set_b", "set_x", "set_y")
    kept = found.where(F.col("component_id").eqNullSafe(F.col(key))).select(F.col(key).alias(k), F.col("h1").alias(a), F.col("h2").alias(b)).distinct()
    if not docs.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count():
        return docs.join(kept.select(k), docs[key].eqNullSafe(F.col(k)), "inner").select(*docs.columns)
    schema = T.StructType([*docs.schema, T.StructField(x, T.LongType()), T.StructField(y, T.LongType())])
    keyed = docs.mapInArrow(_with_set_keys(text, words, x, y), schema).dropDuplicates([key, x, y])
    return keyed.join(kept, keyed[key].eqNullSafe(F.col(k)) & (F.col(x) == F.col(a)) & (F.col(y) == F.col(b)), "inner").select(*docs.columns)
