"""Hierarchical Pitman-Yor bigram model: seating sampled by Gibbs over the whole training part, scores for every text.

A token's context is the token before it. Every context, told apart by its 64-bit hash, is a restaurant of its own; all share one
parent, the restaurant of single tokens, whose base is uniform over the vocabulary and one unknown token. Training tokens are the
customers; of a dish (token) in a restaurant the state is its number of tables, each of which sends a customer to the parent.

How it is spread: bigrams, counted per Arrow batch, go to buckets by token, so that a token's parent dish is in the
bucket of its restaurants. The few most frequent tokens are spread by context as well. Buckets sweep side by side with the
table totals of the round before. Totals of contexts are a table: each bucket sends one partial sum for each of its contexts, parts
of the contexts add them up, and each bucket gets the totals of its own contexts back; nothing is broadcast but totals of ``HOT`` tokens. A round's
table keeps the seating of each bucket beside the totals, and the next round starts from that table alone. Rounds are drawn from their bucket and number
alone, so a lost executor changes nothing. Hashes travel in the first round only; later ones name a context by its place in its part.
Bigrams met in held-out texts only are dishes without customers: they make sure that a bucket has the totals of every context it scores.
"""

from __future__ import annotations

import gc
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.storage import clear_of, dropped, written
from plumbline.llm.words import NOT_SPACE, hash_words, mix, slabs, text_bytes

HOT = 64  # tokens at most that are spread by context
HOT_SHARE = 1 / 500  # of all tokens; bigrams with that share are scored where they are met, from a shared table
SPREAD = 64  # parts by context of a hot token
BUCKET_TOKENS = 2_000_000
SLAB = 6 << 20  # text bytes looked at together
ROUNDS, BURN_IN = 4, 2  # the rounds after the burn-in are averaged
EXACT = 64  # customers of a dish up to which its tables are drawn from their exact conditional distribution
PART_BITS = 6  # at least, of the context's hash: parts in which totals are added up
PART_PAIRS = 1 << 20  # bigrams in a part, about
PAIR_BYTES = 5  # of a bigram's packed context, about
END = np.uint64(0x5EED0FE0D)
START = np.uint64(0x5EED057A7)


# Arrays as bytes

def packed(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes, behind their size."""
    planes = np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T).tobytes()
    return len(planes).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(planes, asbytes=True) if planes else b""


def unpacked(data: bytes, kind) -> np.ndarray:
    size, width = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data[8:], size, "zstd") if size else b"", np.uint8)
    return np.ascontiguousarray(planes.reshape(width, -1).T).reshape(-1).view(kind)


def packed_rising(values: np.ndarray) -> bytes:
    """Ascending unsigned integers, by their differences."""
    return packed(np.diff(values, prepend=values.dtype.type(0)))


def unpacked_rising(data: bytes, kind) -> np.ndarray:
    return np.cumsum(unpacked(data, kind), dtype=kind)


def packed_contexts(contexts: np.ndarray) -> bytes:
    """Distinct contexts ascending, and the number of each one among them."""
    distinct, number = np.unique(contexts, return_inverse=True)
    first = packed_rising(distinct)
    return len(first).to_bytes(8, "little") + first + packed_rising(number.astype(np.uint32))  # falls, which come back by overflow, are few


def unpacked_contexts(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    end = 8 + int.from_bytes(data[:8], "little")
    return unpacked_rising(data[8:end], np.uint64), unpacked_rising(data[end:], np.uint32).astype(np.int64)


# The tokens of Arrow batches

def tokens_of(batch: pa.RecordBatch, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of a batch's texts, each text with its end; the contexts they stand in; tokens per text."""
    words, counts = hash_words(*text_bytes(batch.column(text)), NOT_SPACE)
    sizes = counts + 1
    ends = np.cumsum(sizes) - 1
    tokens = np.empty(int(sizes.sum()), np.uint64)
    is_end = np.zeros(len(tokens), bool)
    is_end[ends] = True
    tokens[is_end], tokens[~is_end] = END, words
    before = np.empty_like(tokens)
    if len(tokens):
        before[1:] = tokens[:-1]
        before[np.concatenate([[0], ends[:-1] + 1])] = START
    return tokens, mix(before, 9), sizes


def bucket_of(tokens: np.ndarray, contexts: np.ndarray, hot: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each (token, context): by token, and of ``hot`` (sorted) tokens by part of the contexts as well."""
    place = np.searchsorted(hot, tokens)
    place[place == len(hot)] = 0
    is_hot = hot[place] == tokens if len(hot) else np.zeros(len(tokens), bool)
    spread = np.where(is_hot, contexts % np.uint64(SPREAD) + np.uint64(1), np.uint64(0))
    return (mix(tokens + spread * np.uint64(0x9E3779B97F4A7C15), 13) % np.uint64(buckets)).astype(np.int32)


def _frequent(text: str):
    """Tokens, and bigrams, that make up a batch's ``HOT_SHARE`` or more, and on the token 0 the number of tokens."""
    def run(batches):
        for batch in batches:
            for _, part in slabs(batch, text, SLAB):
                tokens, contexts, _ = tokens_of(part, text)
                least = max(2, HOT_SHARE * len(tokens))
                found, counts = np.unique(tokens, return_counts=True)
                many = counts >= least
                rows = [(0, None, len(tokens)), *((t, None, n) for t, n in zip(found[many].astype(np.int64).tolist(), counts[many].tolist(), strict=True))]
                for token in found[many]:
                    before, counts = np.unique(contexts[tokens == token], return_counts=True)
                    own = counts >= least
                    rows += [(int(token.astype(np.int64)), c, n) for c, n in zip(before[own].astype(np.int64).tolist(), counts[own].tolist(), strict=True)]
                yield _batch(rows, pa.schema([("token", pa.int64()), ("context", pa.int64()), ("n", pa.int64())]))
    return run


def frequent(docs: DataFrame, text: str) -> tuple[int, np.ndarray, np.ndarray]:
    """The number of tokens, the ``HOT`` most frequent that make up ``HOT_SHARE`` or more, and the bigrams that do, as rows of
    (token, context). They only decide where work goes."""
    sums = docs.select(text).mapInArrow(_frequent(text), "token long, context long, n long").groupBy("token", "context").agg(F.sum("n").alias("n"))
    most = 1 + 2 * int(1 / HOT_SHARE)  # no more can have that share
    rows = sums.orderBy(F.desc(F.col("token") == 0), F.desc("n"), "token", "context").limit(most).collect()
    total = next((r["n"] for r in rows if r["token"] == 0), 0)
    rows = [r for r in rows if r["token"] != 0 and r["n"] >= HOT_SHARE * total]
    hot = [r["token"] for r in rows if r["context"] is None][:HOT]
    pairs = sorted((r["token"] % (1 << 64), r["context"] % (1 << 64)) for r in rows if r["context"] is not None)
    return total, np.sort(np.array(hot, np.int64).astype(np.uint64)), np.array(pairs, np.uint64).reshape(-1, 2)


def frequent_tokens(docs: DataFrame, text: str) -> tuple[int, np.ndarray]:
    """The number of tokens and the hot tokens of :func:`frequent`."""
    return frequent(docs, text)[:2]


# Customers: distinct (token, context) with counts, by bucket

def grouped(tokens: np.ndarray, contexts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct tokens ascending, ends of their rows, contexts ascending in a token, and added counts."""
    order = np.lexsort((contexts, tokens))
    tokens, contexts = tokens[order], contexts[order]
    new = np.r_[True, tokens[1:] != tokens[:-1]] if len(tokens) else np.empty(0, bool)
    firsts = np.flatnonzero(new | np.r_[True, contexts[1:] != contexts[:-1]]) if len(tokens) else np.empty(0, np.int64)
    added = np.add.reduceat(counts[order], firsts) if len(tokens) else counts
    starts = np.flatnonzero(new[firsts])
    return tokens[firsts][starts], np.r_[starts[1:], len(firsts)] if len(starts) else starts, contexts[firsts], added


def _rows_by_bucket(tokens, contexts, values, hot, buckets):
    """(bucket, token per run, ends of runs, contexts, values) of rows with ascending tokens, cut by bucket."""
    bucket = bucket_of(tokens, contexts, hot, buckets)
    order = np.argsort(bucket, kind="stable")
    bucket, tokens, contexts, values = bucket[order], tokens[order], contexts[order], values[order]
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True]) if len(bucket) else [0]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        own = tokens[a:b]
        ends = np.flatnonzero(np.r_[own[1:] != own[:-1], True])
        yield int(bucket[a]), packed_rising(own[ends]), packed_rising((ends + 1).astype(np.uint32)), packed_contexts(contexts[a:b]), packed(values[a:b])


def _unpacked(tokens: bytes, ends: bytes, contexts: bytes, values: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    distinct, number = unpacked_contexts(contexts)
    return np.repeat(unpacked_rising(tokens, np.uint64), unpacked(ends, np.uint32)), distinct[number], unpacked(values, np.uint32)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_CUSTOMERS = pa.schema([("bucket", pa.int32()), *((c, pa.binary()) for c in ("tokens", "ends", "contexts", "counts"))])


def _bigrams(text: str, hot: np.ndarray, buckets: int, held: str | None = None):
    """Bigrams with their counts; those of rows where ``held`` is true count 0."""
    def run(batches):
        for batch in batches:
            for _, part in slabs(batch, text, SLAB):
                tokens, contexts, sizes = tokens_of(part, text)
                trains = np.ones(len(sizes), np.uint32) if held is None else 1 - np.array(part.column(held)).astype(np.uint32)
                words, ends, contexts, counts = grouped(tokens, contexts, np.repeat(trains, sizes))
                tokens = np.repeat(words, np.diff(ends, prepend=0))
                yield _batch(list(_rows_by_bucket(tokens, contexts, counts.astype(np.uint32), hot, buckets)), _CUSTOMERS)
    return run


def _merged(key, table):
    parts = [_unpacked(*row) for row in zip(*(table[c].to_pylist() for c in ("tokens", "ends", "contexts", "counts")), strict=True)]
    tokens, contexts, counts = (np.concatenate([p[i] for p in parts]) for i in range(3))
    words, ends, contexts, counts = grouped(tokens, contexts, counts.astype(np.int64))
    row = (key[0].as_py(), packed_rising(words), packed_rising(ends.astype(np.uint32)), packed_contexts(contexts), packed(counts.astype(np.int64)))
    return pa.Table.from_batches([_batch([row], _CUSTOMERS)])


# Seating

def log_stirling(discount: float, most: int) -> np.ndarray:
    """log S(c, t): ways, weighted by the discount, to seat c customers at t tables (index from 0)."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[1, 1] = 0
    for c in range(1, most):
        t = np.arange(1, c + 1)
        with np.errstate(divide="ignore"):
            out[c + 1, 1:c + 2] = np.logaddexp(out[c, :c + 1], np.concatenate([out[c, 1:c + 1] + np.log(c - discount * t), [-np.inf]]))
    return out


def draw_tables(rng, customers, others, base, discount: float, strength: float, stirling: np.ndarray) -> np.ndarray:
    """New numbers of tables for dishes with ``customers``, given ``others`` tables of the restaurant and the parent's probability.

    None without customers. Up to ``EXACT`` customers: from P(t | rest) ~ S(c, t) * prod_k<t (strength + discount * (others + k)) * base^t. Beyond, the
    dish's customers leave and sit down again one after the other; the tables' arrivals are drawn directly.
    """
    tables = np.minimum(customers, 1).astype(np.int64)
    for c in range(2, EXACT + 1):
        at = np.flatnonzero(customers == c)
        for part in np.array_split(at, max(1, len(at) * c // 400_000)):
            if not len(part):
                continue
            steps = np.log((strength + discount * (others[part, None] + np.arange(c))) * base[part, None])
            logs = np.cumsum(steps, axis=1) + stirling[c, 1:c + 1]
            shares = np.cumsum(np.exp(logs - logs.max(axis=1, keepdims=True)), axis=1)
            tables[part] = 1 + (rng.random((len(part), 1)) * shares[:, -1:] > shares).sum(axis=1)
    at = np.flatnonzero(customers > EXACT)
    seated, t = np.ones(len(at)), np.ones(len(at), np.int64)
    live = np.arange(len(at))
    while len(live):
        weight = (strength + discount * (others[at[live]] + t[live])) * base[at[live]]
        half = (weight - 1) / 2 - discount * t[live]
        with np.errstate(over="ignore"):
            after = np.maximum(seated[live] + half, 1e-3) * rng.random(len(live)) ** (-1 / weight) - half
        came = np.maximum(np.floor(after), seated[live]) < customers[at[live]]
        live, after = live[came], after[came]
        seated[live] = np.maximum(np.floor(after), seated[live]) + 1
        t[live] += 1
    tables[at] = np.minimum(t, customers[at])
    return tables


class TableTotals:
    """Totals of contexts, looked up on the driver in the table of a round; hashes are in that of the first."""

    def __init__(self, table: DataFrame, first: DataFrame, which: int):
        self.table, self.first, self.which = table, first, which

    def __getitem__(self, contexts: np.ndarray) -> np.ndarray:
        sought, inverse = np.unique(contexts, return_inverse=True)
        out = np.zeros(len(sought), np.int64)
        hashes, sums = (t.where("bucket = -1 AND part >= 0").select("part", c) for t, c in ((self.first, "contexts"), (self.table, "sums")))
        for row in hashes.join(sums, "part").toLocalIterator():
            found = unpacked_rising(row["contexts"], np.uint64)
            _, at, own = np.intersect1d(sought, found, assume_unique=True, return_indices=True)
            out[at] = unpacked(row["sums"], np.int64).reshape(-1, len(found))[self.which, own]
        return out[inverse]


class Model:
    """What all buckets share: sizes, discounts, and the totals of each round so far; those of contexts are tables."""

    def __init__(self, hot: np.ndarray, vocabulary: int, trained: int, of_context: TableTotals | None, discounts: tuple[float, float], hot_counts: np.ndarray):
        self.hot, self.vocabulary, self.trained, self.of_context, self.discounts = hot, vocabulary, trained, of_context, discounts
        self.hot_counts = hot_counts  # training counts of the hot tokens
        self.strength = 1.0
        self.rounds: list[dict] = []  # tables by context, parent customers and tables, of hot tokens and of all

    def fields(self) -> dict:
        """What travels: all but the totals of contexts."""
        return vars(self) | {"of_context": None, "rounds": [s | {"by_context": None} for s in self.rounds]}

    @classmethod
    def of(cls, fields: dict) -> Model:
        """A model from its fields; plain arrays are what travels."""
        model = cls.__new__(cls)
        vars(model).update(fields)
        return model

    def parent(self, customers, tables, state: dict) -> np.ndarray:
        """P(token) in the parent restaurant."""
        d = self.discounts[1]
        fresh = (self.strength + d * state["tables"]) / (self.vocabulary + 1)
        return (customers - d * tables + fresh) / (self.strength + state["customers"])

    def child(self, counts, tables, contexts, parent, state: dict) -> np.ndarray:
        """P(token | context)."""
        d = self.discounts[0]
        total = self.of_context[contexts]
        seen = (np.maximum(0, counts - d * tables) + (self.strength + d * state["by_context"][contexts]) * parent) / (self.strength + total)
        return np.where(total > 0, seen, parent)


class Bucket:
    """One bucket's customers, and how a round seats them."""

    def __init__(self, number: int, tokens: bytes, ends: bytes, contexts: bytes, counts: bytes):
        self.number = number
        self.words = unpacked_rising(tokens, np.uint64)
        self.ends = unpacked_rising(ends, np.uint32).astype(np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]]) if len(self.ends) else self.ends
        self.word = np.repeat(np.arange(len(self.words)), self.ends - self.starts)
        self.distinct, self.context = unpacked_contexts(contexts)
        self.contexts = self.distinct[self.context]
        self.counts = unpacked(counts, np.int64)

    def sums(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.starts) if len(self.starts) else values[:0]

    def hot_places(self, model: Model) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the bucket's words that are hot, and their numbers among the hot."""
        if not len(model.hot):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.searchsorted(model.hot, self.words)
        at[at == len(model.hot)] = 0
        own = np.flatnonzero(model.hot[at] == self.words)
        return own, at[own]

    def opened(self) -> tuple:
        """Before the first round every dish has one table: (tables, parent customers, parent tables)."""
        tables = np.minimum(self.counts, 1)
        sent = self.sums(tables)
        return tables, sent, np.minimum(sent, 1)

    def seated(self, model: Model, seed: int, i: int, tables: np.ndarray, sent: np.ndarray, above: np.ndarray) -> tuple:
        """The seating that a round draws from the one before it and its state, which is number ``i``."""
        stirling = [log_stirling(d, EXACT) for d in model.discounts]
        own, hot = self.hot_places(model)
        state = model.rounds[i]
        rng = np.random.default_rng([seed, self.number, i])
        customers, parent_tables = sent.astype(float), above.astype(float)
        customers[own], parent_tables[own] = state["hot_customers"][hot], state["hot_tables"][hot]
        parent = model.parent(customers, parent_tables, state)
        others = np.maximum(0, state["by_context"][self.contexts] - tables)
        tables = draw_tables(rng, self.counts, others, parent[self.word], model.discounts[0], model.strength, stirling[0])
        sent = self.sums(tables)
        base = np.full(len(sent), 1 / (model.vocabulary + 1))
        above = draw_tables(rng, sent, np.maximum(0, state["tables"] - above), base, model.discounts[1], model.strength, stirling[1])
        return tables, sent, above

    def replay(self, model: Model, seed: int, rounds: int, keep: int = 0) -> list[tuple]:
        """Draws ``rounds`` rounds; returns (tables, parent customers, parent tables) after those from ``keep`` on."""
        out = [self.opened()]
        for i in range(rounds):
            out.append(self.seated(model, seed, i, *out[-1]))
        return out[keep:]


_TOTALS = pa.schema([("bucket", pa.int32()), ("part", pa.int32()), ("contexts", pa.binary()), ("sums", pa.binary())])
_TOTALS_KIND = "bucket int, part int, contexts binary, sums binary"


def _placed(customers: dict, before: list[dict], fields: dict) -> tuple[Bucket, Model, dict, dict]:
    """A bucket whose contexts are numbers, the model with the totals of those, the seating by round, and by part the contexts' places."""
    model = Model.of(fields)
    bucket = Bucket(*(customers[c] for c in _CUSTOMERS.names))
    bucket.contexts = bucket.context
    seats, sums, places = {0: bucket.opened()}, {}, {}
    for r in sorted(before, key=lambda r: r["part"]):
        if r["part"] >= 0:
            sums.setdefault(r["round"], []).append(unpacked(r["sums"], np.int64).reshape(1 if r["round"] else 2, -1))
            places[r["part"]] = r["contexts"]
        else:
            tables = unpacked(r["sums"], np.uint32).astype(np.int64)
            seats[r["round"]] = tables, bucket.sums(tables), unpacked(r["contexts"], np.uint32).astype(np.int64)
    model.rounds = list(model.rounds)
    for i, parts in sums.items():
        own = np.concatenate(parts, axis=1)
        model.rounds[i] = model.rounds[i] | {"by_context": own[0].astype(float)}
        if not i:
            model.of_context = own[1]
    return bucket, model, seats, places


def _sums(customers: dict, before: list[dict], fields: dict, seed: int, rounds: int, bits: int) -> pa.RecordBatch:
    """What a bucket adds after ``rounds`` rounds: tables (at first customers as well) by context in parts, on part -1 the rest, and
    its seating on a part of its own, below."""
    bucket, model, seats, places = _placed(customers, before, fields)
    tables, sent, above = bucket.seated(model, seed, rounds - 1, *seats[rounds - 1]) if rounds else seats[0]
    own, hot = bucket.hot_places(model)
    cold = np.ones(len(bucket.words), bool)
    cold[own] = False
    rest = np.zeros(7 + 2 * HOT, np.int64)
    rest[:2] = sent.sum(), above[cold].sum()
    rest[7 + hot] = sent[own]
    distinct = bucket.distinct
    by_context = [np.bincount(bucket.contexts, tables, len(distinct))]
    if not rounds:
        by_context.append(np.bincount(bucket.contexts, bucket.counts, len(distinct)))
        rest[2:7] = bucket.counts.sum(), (bucket.counts == 1).sum(), (bucket.counts == 2).sum(), (sent[cold] == 1).sum(), (sent[cold] == 2).sum()
        rest[7 + HOT + hot] = bucket.sums(bucket.counts)[own]
    by_context = np.array(by_context).astype(np.int64)
    part = (distinct >> np.uint64(64 - bits)).astype(np.int64)
    cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True]) if len(part) else [0]
    rows = [(bucket.number, -1, b"", rest.tobytes())]
    rows += [(bucket.number, int(part[a]), places[int(part[a])] if rounds else packed_rising(distinct[a:b]), packed(by_context[:, a:b]))
             for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    if rounds:
        rows.append((bucket.number, -2 - bucket.number, packed(above.astype(np.uint32)), packed(tables.astype(np.uint32))))
    return _batch(rows, _TOTALS)


def _first_sums(shared, seed: int, bits: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield _sums(row, [], shared.value, seed, 0, bits)
    return run


def _next_sums(shared, seed: int, rounds: int, bits: int):
    def run(key, customers, before):
        (row,) = customers.to_pylist()
        return pa.Table.from_batches([_sums(row, before.to_pylist(), shared.value, seed, rounds, bits)])
    return run


def _added(rounds: int):
    """A part's totals on bucket -1, and those of each bucket's contexts in its order beside their places in the part; a seating as it is."""
    def run(key, table):
        part, buckets = key[0].as_py(), table["bucket"].to_pylist()
        if part < -1:
            return table
        if part < 0:
            sums = [np.frombuffer(x, np.int64) for x in table["sums"].to_pylist()]
            return pa.Table.from_batches([_batch([(-1, part, b"", np.sum(sums, axis=0).tobytes())], _TOTALS)])
        sums, given = [unpacked(x, np.int64) for x in table["sums"].to_pylist()], table["contexts"].to_pylist()
        if rounds:
            at, hashes = [unpacked_rising(x, np.uint32) for x in given], b""
            size = 1 + max(int(x[-1]) for x in at)
        else:
            contexts = [unpacked_rising(x, np.uint64) for x in given]
            found, inverse = np.unique(np.concatenate(contexts), return_inverse=True)
            at = np.split(inverse.astype(np.uint32), np.cumsum([len(c) for c in contexts])[:-1])
            size, hashes, given = len(found), packed_rising(found), [packed_rising(x) for x in at]
        totals = np.zeros((1 if rounds else 2, size), np.int64)
        for places, own in zip(at, sums, strict=True):
            totals[:, places] += own.reshape(len(totals), -1)
        rows = [(-1, part, hashes, packed(totals))]
        rows += [(b, part, names, packed(totals[:, places])) for b, names, places in zip(buckets, given, at, strict=True)]
        return pa.Table.from_batches([_batch(rows, _TOTALS)])
    return run


def _of_buckets(model: Model, rounds) -> DataFrame:
    """What the tables of ``rounds`` keep for the buckets: totals of their contexts, and their seating."""
    tables = [model.rounds[i]["by_context"].table.where("bucket >= 0").withColumn("round", F.lit(i)) for i in rounds]
    return reduce(DataFrame.unionAll, tables)


def _add_up(customers: DataFrame, model: Model, seed: int, rounds: int, bits: int) -> tuple[DataFrame, np.ndarray]:
    """The table of totals and seating after ``rounds`` rounds, and the rest."""
    shared = customers.sparkSession.sparkContext.broadcast(model.fields())
    if rounds:
        before = _of_buckets(model, [rounds - 1]).groupBy("bucket")
        rows = customers.groupBy("bucket").cogroup(before).applyInArrow(_next_sums(shared, seed, rounds, bits), _TOTALS_KIND)
    else:
        rows = customers.mapInArrow(_first_sums(shared, seed, bits), _TOTALS_KIND)
    table = written(rows.groupBy("part").applyInArrow(_added(rounds), _TOTALS_KIND), "pitman-yor-totals")
    rest = table.where("part = -1").first()
    return table, np.frombuffer(rest["sums"], np.int64) if rest else np.zeros(7 + 2 * HOT, np.int64)


def _drop_shuffles(spark) -> None:
    """Lets Spark's cleaner delete the files of shuffles that no table refers to any more; it acts on what the JVM collects."""
    gc.collect()
    spark._jvm.System.gc()


def _state(model: Model, table: DataFrame, first: DataFrame, rest: np.ndarray, rng) -> dict:
    """A round's shared state; parent tables of the hot tokens, which no bucket has whole, are drawn here."""
    n = len(model.hot)
    sent = rest[7:7 + n]
    before = model.rounds[-1]["tables"] if model.rounds else float(rest[1] + n)
    base = np.full(n, 1 / (model.vocabulary + 1))
    d = model.discounts[1]
    above = draw_tables(rng, sent, np.full(n, before), base, d, model.strength, log_stirling(d, EXACT)) if model.rounds else (sent > 0).astype(np.int64)
    above = np.where(sent > 0, above, 0)
    return {
        "by_context": TableTotals(table, first, 0), "customers": float(rest[0]),
        "tables": float(rest[1] + above.sum()), "hot_customers": sent.astype(float), "hot_tables": above.astype(float)}


def trained(customers: DataFrame, hot: np.ndarray, vocabulary: int, seed: int, rounds: int, keep: int = 0) -> Model:
    """Runs the rounds. Discounts come from the numbers of dishes with one and with two customers, as in Kneser-Ney smoothing.

    Tables of the rounds between the first and ``keep`` are deleted once the next round has been drawn from them.
    """
    pairs = customers.agg(F.coalesce(F.sum(F.octet_length("contexts")), F.lit(0))).first()[0] // PAIR_BYTES
    bits = max(PART_BITS, int(pairs // PART_PAIRS).bit_length())
    model = Model(hot, vocabulary, 0, None, (0.5, 0.5), np.zeros(len(hot), np.int64))
    first, rest = _add_up(customers, model, seed, 0, bits)
    ratio = lambda one, two: float(np.clip(one / max(1, one + 2 * two), 0.1, 0.9))
    model = Model(hot, vocabulary, int(rest[2]), TableTotals(first, first, 1), (ratio(rest[3], rest[4]), ratio(rest[5], rest[6])), rest[7 + HOT:7 + HOT + len(hot)].copy())
    model.rounds.append(_state(model, first, first, rest, np.random.default_rng([seed, 0])))
    for i in range(1, rounds + 1):
        table, rest = _add_up(customers, model, seed, i, bits)
        model.rounds.append(_state(model, table, first, rest, np.random.default_rng([seed, 0, i])))
        if 1 < i <= keep:
            dropped(model.rounds[i - 1]["by_context"].table)
        _drop_shuffles(customers.sparkSession)
    return model


# Scores

def _judging(customers: DataFrame, model: Model, rounds: int, keep: int) -> DataFrame:
    """By bucket what :class:`Scores` needs: its customers, and the totals and seatings of the rounds from ``keep`` on; of the first one the totals."""
    return customers.unionByName(_of_buckets(model, sorted({0, *range(keep, rounds + 1)})), allowMissingColumns=True)


class Scores:
    """A bucket's bigrams with log10 of their probabilities averaged over the rounds from ``keep`` on, and its tokens' training counts."""

    def __init__(self, rows: list[dict], fields: dict, rounds: int, keep: int):
        (customers,) = (r for r in rows if r["round"] is None)
        bucket, model, seats, _ = _placed(customers, [r for r in rows if r["round"] is not None], fields)
        own, hot = bucket.hot_places(model)
        mean = np.zeros(len(bucket.counts))
        for i in range(keep, rounds + 1):
            (tables, sent, above), state = seats[i], model.rounds[i]
            parent_customers, parent_tables = sent.astype(float), above.astype(float)
            parent_customers[own], parent_tables[own] = state["hot_customers"][hot], state["hot_tables"][hot]
            parent = model.parent(parent_customers, parent_tables, state)
            mean += model.child(bucket.counts, tables, bucket.contexts, parent[bucket.word], state)
        self.counts = bucket.sums(bucket.counts)
        self.counts[own] = model.hot_counts[hot]
        self.logs = np.log10(mean / (rounds - keep + 1))
        self.words, self.distinct, self.keys = bucket.words, bucket.distinct, (bucket.word << 32) | bucket.context

    def at(self, words: np.ndarray, contexts: np.ndarray) -> np.ndarray:
        """Places of bigrams (numbers of the word and of the context), which the bucket has."""
        return np.searchsorted(self.keys, (words << 32) | contexts)


def _shared_pairs(shared, pairs: np.ndarray, rounds: int, keep: int):
    """Score and training count of the ``pairs`` that a bucket has, with their numbers."""
    schema = pa.schema([("number", pa.int32()), ("log", pa.float64()), ("n", pa.int64())])

    def run(key, table):
        own = Scores(table.to_pylist(), shared.value, rounds, keep)
        word, context = np.searchsorted(own.words, pairs[:, 0]), np.searchsorted(own.distinct, pairs[:, 1])
        at = np.minimum(own.at(word, context), len(own.keys) - 1)
        has = np.flatnonzero(np.isin(pairs[:, 0], own.words) & np.isin(pairs[:, 1], own.distinct) & (own.keys[at] == (word << 32) | context))
        return pa.Table.from_batches([_batch([(int(i), float(own.logs[at[i]]), int(own.counts[word[i]])) for i in has], schema)])
    return run


_PARTIAL = [("place", pa.int64()), ("docs", pa.binary()), ("known", pa.binary()), ("base", pa.binary()), ("score", pa.binary())]


def _partial(docs: np.ndarray, known: np.ndarray, base: np.ndarray, score: np.ndarray) -> tuple[bytes, ...]:
    return packed_rising(docs.astype(np.uint16)), packed(known.astype(np.uint32)), packed(base), packed(score)


def _occurrences(shared, text: str, buckets: int):
    """Each text's tokens by bucket; those of shared bigrams are scored here, and come with the texts' keys under a bucket of their own."""
    def run(batches):
        fields, pairs, logs, counts = shared.value
        model = Model.of(fields)
        place = TaskContext.get().partitionId() << 32
        flat = np.log10(model.trained + 0.5 * (model.vocabulary + 1))
        for batch in batches:
            for _, piece in slabs(batch, text, SLAB):
                for start in range(0, piece.num_rows, 1 << 16):
                    part = piece.slice(start, 1 << 16)
                    tokens, contexts, sizes = tokens_of(part, text)
                    docs = np.repeat(np.arange(len(sizes)), sizes)
                    which = np.full(len(tokens), -1)
                    maybe = np.flatnonzero(np.isin(tokens, pairs[:, 0]))
                    for i, (token, context) in enumerate(pairs):
                        which[maybe[(tokens[maybe] == token) & (contexts[maybe] == context)]] = i
                    is_hot, n = which >= 0, part.num_rows
                    which, own = which[is_hot], docs[is_hot]
                    sums = [np.bincount(own, w, n) for w in ((counts[which] > 0).astype(float), np.log10(counts[which] + 0.5) - flat, logs[which])]
                    head = (buckets + place % buckets, None, None, None, None, place, *_partial(np.arange(n), *sums), part.column("key").to_pylist(),
                            part.column("held").to_pylist(), sizes.tolist())
                    cold = np.flatnonzero(~is_hot)
                    cold = cold[np.lexsort((contexts[cold], tokens[cold]))]
                    rows = _rows_by_bucket(tokens[cold], contexts[cold], docs[cold].astype(np.uint16), model.hot, buckets)
                    yield _batch([head, *((*row, place, *[None] * 7) for row in rows)], _occurrence_schema(part.column("key").type))
                    place += 1
    return run


def _occurrence_schema(key: pa.DataType) -> pa.Schema:
    return pa.schema([*_CUSTOMERS, *_PARTIAL, ("keys", pa.list_(key)), ("held", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int64()))])


def _looked_up(shared, rounds: int, keep: int, key_type: pa.DataType):
    schema = pa.schema([*_PARTIAL, ("keys", pa.list_(key_type)), ("held", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int64()))])

    def run(key, occurrences, judging):
        heads = occurrences.filter(pa.compute.is_valid(occurrences["keys"])).select(schema.names).cast(schema)
        rows = occurrences.filter(pa.compute.is_null(occurrences["keys"]))
        if not rows.num_rows:
            return heads
        model = Model.of(shared.value[0])
        flat = np.log10(model.trained + 0.5 * (model.vocabulary + 1))
        own = Scores(judging.to_pylist(), shared.value[0], rounds, keep)
        out = []
        for row in zip(*(rows[c].to_pylist() for c in ("tokens", "ends", "contexts", "counts", "place")), strict=True):
            word = np.repeat(np.searchsorted(own.words, unpacked_rising(row[0], np.uint64)), unpacked(row[1], np.uint32))
            distinct, number = unpacked_contexts(row[2])
            score = own.logs[own.at(word, np.searchsorted(own.distinct, distinct)[number])]
            count = own.counts[word]
            docs = unpacked(row[3], np.uint16).astype(np.int64)
            found, local = np.unique(docs, return_inverse=True)
            sums = np.bincount(local, count > 0), np.bincount(local, np.log10(count + 0.5) - flat), np.bincount(local, score)
            out.append((row[4], *_partial(found, *sums), None, None, None))
        found = pa.Table.from_batches([_batch(out, schema)])
        return pa.concat_tables([heads, found]) if heads.num_rows else found
    return run


def _summed(key_type: pa.DataType):
    schema = pa.schema([("key", key_type), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(key, table):
        head = table.filter(pa.compute.is_valid(table["keys"]))
        sizes = np.array(head["sizes"].to_pylist()[0], np.int64)
        known, base, score = np.zeros(len(sizes), np.int64), np.zeros(len(sizes)), np.zeros(len(sizes))
        parts = zip(*(table[c].to_pylist() for c in ("docs", "known", "base", "score")), strict=True)
        for docs, k, b, s in sorted(parts):  # always in the same order, for the same rounding
            at = unpacked_rising(docs, np.uint16).astype(np.int64)
            known[at] += unpacked(k, np.uint32)
            base[at] += unpacked(b, np.float64)
            score[at] += unpacked(s, np.float64)
        return pa.Table.from_arrays(
            [pa.array(head["keys"].to_pylist()[0], key_type), pa.array(head["held"].to_pylist()[0], pa.bool_()), pa.array(sizes), pa.array(known), pa.array(base), pa.array(score)],
            schema=schema)
    return run


def scored(docs: DataFrame, held: Column, key: str = "doc_id", text: str = "text", seed: int = 5, rounds: int = ROUNDS, burn_in: int = BURN_IN) -> DataFrame:
    """Every text's log10 probability under the model learned from the rows where ``held`` is not true.

    Tokens are runs without ASCII white space, A-Z lower-cased, then one end; a null or empty text has the end only. Returns ``key``,
    ``held_out``, ``n_tokens``, ``n_known`` (tokens seen in training), ``train_tokens``, ``base_score`` (sum of log10 of add-a-half unigram
    probabilities) and ``score`` (of probabilities averaged over the rounds after ``burn_in``). A null ``held`` is false. Null keys
    and repeated rows come out as they are; other columns are not read. Without training rows all tokens are unknown. Seating is drawn
    from ``seed``, so a table gives the same scores again as long as its partitions stay. Perplexity of a text: 10 ** (-score / n_tokens).
    """
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    (t,) = clear_of(docs.select(F.col(key).alias("key")), "text")
    plain = docs.select(F.col(key).alias("key"), F.coalesce(held, F.lit(False)).alias("held"), F.col(text).alias(t))
    kind = plain.schema["key"].dataType.simpleString()
    key_type = to_arrow_type(plain.schema["key"].dataType)
    total, hot, pairs = frequent(plain, t)
    buckets = max(12, -(-total // BUCKET_TOKENS))
    kind_of = lambda names: "bucket int, " + ", ".join(f"{c} binary" for c in names.names[1:])
    packed_rows = plain.select(t, "held").mapInArrow(_bigrams(t, hot, buckets, "held"), kind_of(_CUSTOMERS))
    customers = written(packed_rows.groupBy("bucket").applyInArrow(_merged, kind_of(_CUSTOMERS)), "pitman-yor-customers")

    seen = [np.frombuffer(r["seen"], np.int64) for r in customers.mapInArrow(_known(hot), "seen binary").collect()]
    seen = np.sum(seen, axis=0) if seen else np.zeros(len(hot) + 1, np.int64)
    vocabulary = int(seen[-1] + np.minimum(seen[:-1], 1).sum())
    del packed_rows
    _drop_shuffles(spark)
    keep = min(burn_in + 1, rounds)
    model = trained(customers, hot, vocabulary, seed, rounds, keep)
    judging = _judging(customers, model, rounds, keep)
    logs, counts = np.zeros(len(pairs)), np.zeros(len(pairs), np.int64)
    if len(pairs):
        shared = spark.sparkContext.broadcast(model.fields())
        own = judging.where(F.col("bucket").isin(np.unique(bucket_of(pairs[:, 0], pairs[:, 1], hot, buckets)).tolist()))
        for r in own.groupBy("bucket").applyInArrow(_shared_pairs(shared, pairs, rounds, keep), "number int, log double, n long").collect():
            logs[r["number"]], counts[r["number"]] = r["log"], r["n"]
        _drop_shuffles(spark)
    with_pairs = spark.sparkContext.broadcast((model.fields(), pairs, logs, counts))
    partial = "place long, docs binary, known binary, base binary, score binary"
    lists = f"keys array<{kind}>, held array<boolean>, sizes array<long>"
    found = plain.mapInArrow(_occurrences(with_pairs, t, buckets), f"{kind_of(_CUSTOMERS)}, {partial}, {lists}")
    looked_up = found.groupBy("bucket").cogroup(judging.groupBy("bucket")).applyInArrow(_looked_up(with_pairs, rounds, keep, key_type), f"{partial}, {lists}")
    scores = looked_up.groupBy("place").applyInArrow(
        _summed(key_type), f"key {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scores.select(
        F.col("key").alias(key), "held_out", "n_tokens", "n_known", F.lit(model.trained).cast("long").alias("train_tokens"), "base_score", "score")


def _known(hot: np.ndarray):
    """Per bucket, which hot tokens it trains, and how many others."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                bucket = Bucket(*(row[c] for c in _CUSTOMERS.names))
                words = bucket.words[bucket.sums(bucket.counts) > 0]
                seen = np.isin(hot, words)
                yield pa.RecordBatch.from_arrays([pa.array([np.r_[seen, len(words) - seen.sum()].astype(np.int64).tobytes()], pa.binary())], ["seen"])
    return run
