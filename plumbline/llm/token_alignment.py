"""Tokens of two tokenizers over the same bytes: groups by pointer jumping, and how often two tokens end together."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.storage import bounded_batches, clear_of, work_dir
from plumbline.llm.words import slabs

SLAB = 1 << 19  # bytes of text aligned together
PART = 1 << 17  # tokens of an alignment looked at together
STRETCH = 1 << 18  # characters of a long text encoded together
KNOWN_BYTES = 64 << 20  # of remembered units, their tokens and what Python adds to them
CALL = 1 << 16  # characters of units encoded together
CUT = re.compile(r"(?<=\S)(?= \S)")
ARRAYS = ("a_ids", "b_ids", "a_sizes", "b_sizes")


def _printable() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1 is itself, the other bytes follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = sorted(set(range(256)).difference(own))
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


PRINTABLE = _printable()


def byte_level(entry: str) -> bytes:
    """The bytes of a byte-level vocabulary entry; one with other characters is a special string and stands for itself."""
    try:
        return bytes(map(PRINTABLE.__getitem__, entry))
    except KeyError:
        return entry.encode()


def piece_bytes(piece: str) -> bytes:
    """The bytes of a piece: U+2581 is a space, <0xHH> a byte."""
    one = re.fullmatch("<0x([0-9A-F]{2})>", piece)
    return bytes([int(one[1], 16)]) if one else piece.replace("▁", " ").encode()


class Pair:
    """The two tokenizers with the bytes of their tokens, and the tokens of units seen before.

    A unit begins with one space between two other characters (the first one with the space before the text) and ends where
    the next begins. Neither side's tokens span such a place (A's pattern cuts before the space, and no piece of B has
    one behind another character), so a text's tokens are those of its units.
    """

    def __init__(self, a_path: str, b_path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a_bytes = [byte_level(self.a.id_to_token(i) or "") for i in range(self.a.get_vocab_size(with_added_tokens=True))]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [piece_bytes(p) for p in pieces]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("the model has pieces that reach over the start of a word")
        self.a_len = np.array([len(t) for t in self.a_bytes])
        self.b_len = np.array([len(t) for t in self.b_bytes])
        self.forget()

    def forget(self) -> None:
        """No unit is known: tokens and groups of known ones lie in four arrays, one unit after the other."""
        self.known: dict[str, int] = {}
        self.held = 0
        self.tokens = [np.empty(1 << 12, np.int32) for _ in ARRAYS]
        self.ends = [np.zeros(1 << 12, np.int64) for _ in ARRAYS]  # where each unit's part of an array ends

    @staticmethod
    def stretches(spaced: str):
        """Parts of a space and a text that end where a unit does."""
        at = 0
        while at < len(spaced):
            step = CUT.search(spaced, at + STRETCH)
            end = step.start() if step else len(spaced)
            yield spaced[at:end]
            at = end

    def _ids(self, units: list[str]) -> tuple[list[int], list[int]]:
        """Ids of one text made of units."""
        text = "".join(units)
        return self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.b.encode(text[1:])

    def _ends(self, a: np.ndarray, b: np.ndarray, units: list[str]) -> tuple[np.ndarray, ...] | None:
        """Where tokens end in bytes, and how many tokens of each side lie before the end of each unit; None where bytes differ."""
        spelled = "".join(units).encode()
        if b"".join(map(self.a_bytes.__getitem__, a.tolist())) != spelled or b"".join(map(self.b_bytes.__getitem__, b.tolist())) != spelled:
            return None
        upto = np.cumsum([len(u.encode()) for u in units])
        a_end, b_end = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        a_at, b_at = np.searchsorted(a_end, upto, "right"), np.searchsorted(b_end, upto, "right")
        if (a_end[a_at - 1] != upto).any() or (b_end[b_at - 1] != upto).any():
            return None
        return a_end, b_end, a_at, b_at

    def learn(self, units: list[str]) -> None:
        """Tokens and groups of new units, encoded many at a time; one by one where their bytes don't come out as they are.

        A unit that ends with white space is encoded by itself, since what follows would change it.
        """
        call: list[str] = []
        size = 0
        for unit in sorted(units, key=len):
            if unit[-1].isspace():
                self._learn([unit])
                continue
            call.append(unit)
            size += len(unit)
            if size >= CALL:
                self._learn(call)
                call, size = [], 0
        if call:
            self._learn(call)

    def _learn(self, units: list[str]) -> None:
        a, b = (np.array(ids, np.int32) for ids in self._ids(units))
        found = self._ends(a, b, units)
        if found is None and len(units) > 1:
            for unit in units:
                self._learn([unit])
            return
        if found is None:
            empty = np.zeros(1, np.int64)
            self._remember(units, [a[:0]] * 4, [empty] * 4, False)
            return
        a_end, b_end, a_at, b_at = found
        a_group, b_group = labelled(a_end, b_end)
        groups = int(b_group[-1]) + 1
        sizes = [np.bincount(g, minlength=groups).astype(np.int32) for g in (a_group, b_group)]
        upto = b_group[b_at - 1] + 1  # a unit's end is a group's
        self._remember(units, [a, b, *sizes], [a_at, b_at, upto, upto], True)

    def _remember(self, units: list[str], parts: list[np.ndarray], upto: list[np.ndarray], same: bool) -> None:
        first = len(self.known) + 1
        last = first + len(units)
        for i, (part, ends) in enumerate(zip(parts, upto, strict=True)):
            if last > len(self.ends[i]):
                self.ends[i] = np.concatenate([self.ends[i], np.zeros(max(last, len(self.ends[i])), np.int64)])
            done = int(self.ends[i][first - 1])
            self.ends[i][first:last] = done + ends
            if done + len(part) > len(self.tokens[i]):
                self.tokens[i] = np.concatenate([self.tokens[i], np.empty(max(len(part), len(self.tokens[i])), np.int32)])
            self.tokens[i][done:done + len(part)] = part
            self.held += 4 * len(part) + 8 * len(units)
        # a unit whose bytes either side changes is known by a negative number
        self.known.update(zip(units, range(first, last) if same else range(-first, -last, -1), strict=True))
        self.held += sum(map(len, units)) + 110 * len(units)

    def align(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each of the four arrays the values of all texts and how many each text has; none where either side changes its bytes."""
        cut = [[unit for part in self.stretches(" " + text) for unit in CUT.split(part)] if text else [] for text in texts]
        wanted = set().union(*cut)
        if self.held > KNOWN_BYTES:
            self.forget()
        self.learn(list(wanted.difference(self.known)))
        count = np.array([len(units) for units in cut], np.int64)
        known = self.known.__getitem__
        place = np.fromiter((number for units in cut for number in map(known, units)), np.int64, int(count.sum()))
        row = np.repeat(np.arange(len(cut)), count)
        changed = np.bincount(row[place < 0], minlength=len(cut)) > 0
        own = ~changed[row]
        place, row = place[own], row[own]
        out = []
        for values, ends in zip(self.tokens, self.ends, strict=True):
            start, n = ends[place - 1], ends[place] - ends[place - 1]
            before = np.cumsum(n) - n
            spot = np.arange(int(n.sum())) + np.repeat(start - before, n)
            out.append((values[spot], np.bincount(row, n, len(cut)).astype(np.int64)))
        return out


def labelled(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group number of every A and every B token, from where they end in the same bytes.

    A token points to the token of the other side that covers its last byte, which is its farthest-right overlap; a B
    token that ends with that A token is a group's last and points to itself. Doubling the pointers until they stay
    leads every token to its group's last one, in as many rounds as the longest chain has binary digits.
    """
    to_b = np.searchsorted(b_end, a_end)
    to_a = np.searchsorted(a_end, b_end)
    last = a_end[np.minimum(to_a, len(a_end) - 1)] == b_end if len(a_end) else np.zeros(len(b_end), bool)
    own = np.arange(len(b_end)) + len(a_end)
    step = np.concatenate([to_b + len(a_end), np.where(last, own, to_a)])
    while True:
        further = step[step]
        if np.array_equal(further, step):
            break
        step = further
    group = np.searchsorted(own[last], step)
    return group[:len(a_end)], group[len(a_end):]


def _rows(values: np.ndarray, counts: np.ndarray, packed: bool) -> pa.Array:
    """Each row's values as a list, or packed as little-endian 32-bit numbers."""
    ends = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=ends[1:])
    if packed:
        return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(4 * ends), pa.py_buffer(values.astype("<i4"))])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int32()))


def _aligned(a_path: str, b_path: str, text: str, packed: bool):
    def run(batches):
        pair = Pair(a_path, b_path)
        for batch in batches:
            for _, part in slabs(batch, text, SLAB):
                found = pair.align(part.column(text).to_pylist())
                kept = part.drop_columns([text])
                yield pa.RecordBatch.from_arrays([*kept.columns, *[_rows(*side, packed) for side in found]], [*kept.schema.names, *ARRAYS])
    return run


def aligned(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text", packed: bool = False) -> DataFrame:
    """``key``, ``a_ids``, ``b_ids`` and, for each group in order, how many A and B tokens it has: ``a_sizes``, ``b_sizes``.

    A (a tokenizers file) encodes a space and the text, B (a sentencepiece model that adds the space itself) the
    text, both without special tokens; their strings in a text are plain text. Byte offsets where tokens of both end cut
    the tokens into groups. Null and empty texts, and those whose joined A or B bytes aren't a space and the text,
    have empty arrays. Null and repeated keys come out row by row; other columns aren't read. Nothing is shuffled; a task holds the
    tokens of about half a MB of text (one row at least), and long texts are encoded in stretches. With ``packed`` each array is a binary of
    little-endian 32-bit numbers, which the JVM passes on as it is; the functions below take either.
    """
    bounded_batches(docs.sparkSession)
    (k,) = clear_of(docs.select(text, *[F.lit(0).alias(n) for n in ARRAYS]), "key")
    plain = docs.select(F.col(key).alias(k), F.col(text))
    kind = plain.schema[k].dataType.simpleString()
    own = "binary" if packed else "array<int>"
    found = plain.mapInArrow(_aligned(a_path, b_path, text, packed), f"{k} {kind}, " + ", ".join(f"{n} {own}" for n in ARRAYS))
    return found.select(F.col(k).alias(key), *ARRAYS)


def _sizes(column: pa.Array) -> np.ndarray:
    """How many values each row has."""
    if pa.types.is_binary(column.type):
        return pa.compute.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64) // 4
    return pa.compute.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)


def _numpy(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """A column's values and the offsets of its rows."""
    column = batch.column(name)
    offsets = np.zeros(len(column) + 1, np.int64)
    np.cumsum(_sizes(column), out=offsets[1:])
    if pa.types.is_binary(column.type):
        ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
        data = column.buffers()[2]
        values = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]].copy().view("<i4") if data is not None else np.empty(0, np.int32)
    else:
        values = column.flatten().to_numpy(zero_copy_only=False)
    return values.astype(np.int64), offsets


def _links(a: np.ndarray, b: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray) -> np.ndarray:
    """The A and the B token that end each group, as one number."""
    return a[np.cumsum(a_sizes) - 1] << 32 | b[np.cumsum(b_sizes) - 1]


def _parts(batch: pa.RecordBatch):
    """Slices of a batch with about ``PART`` tokens each (one row at least)."""
    tokens = np.cumsum(_sizes(batch.column("a_ids")))
    at = 0
    while at < batch.num_rows:
        done = tokens[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(tokens, done + PART, "right")))
        yield batch.slice(at, end - at)
        at = end


def _counted(batches):
    keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    for batch in batches:
        for part in _parts(batch):
            more, n = np.unique(_links(*(_numpy(part, name)[0] for name in ARRAYS)), return_counts=True)
            keys, place = np.unique(np.concatenate([keys, more]), return_inverse=True)
            counts = np.bincount(place, np.concatenate([counts, n]), len(keys)).astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(keys >> 32), pa.array(keys & 0xFFFFFFFF), pa.array(counts)], ["a_id", "b_id", "links"])


def link_counts(alignment: DataFrame) -> DataFrame:
    """``a_id``, ``b_id`` and their ``links``: how many groups of all rows end with both; ``best`` where no A id has more with the B id.

    Counts are added up inside each task first. Of two tokens that end together one ends with the other's
    bytes, so there are at most as many pairs as the vocabularies' tokens have ends.
    """
    from pyspark.sql import Window

    # each task's counts are whole numbers below 2**53, so adding them as floats inside bincount is exact
    parts = alignment.select(*ARRAYS).mapInArrow(_counted, "a_id long, b_id long, links long")
    summed = parts.groupBy("a_id", "b_id").agg(F.sum("links").alias("links"))
    return summed.withColumn("best", F.col("links") == F.max("links").over(Window.partitionBy("b_id")))


def _scored(counts, key: str):
    def run(batches):
        keys, links, best = counts.value
        names: list[str] = []
        for batch in batches:
            for part in _parts(batch):
                (a, a_at), (b, b_at), (a_sizes, at), (b_sizes, _) = (_numpy(part, name) for name in ARRAYS)
                place = np.searchsorted(keys, _links(a, b, a_sizes, b_sizes))
                best_to, sum_to = (np.concatenate([[0], np.cumsum(values[place])]) for values in (best, links))
                top = int(max(a.max(initial=-1), b.max(initial=-1))) + 1
                names.extend(f"{i}{end}" for i in range(len(names) // 3, top) for end in ",|;")
                ends = np.cumsum(a_sizes) + np.cumsum(b_sizes)  # places in a line of each group's A and then its B tokens
                line = np.zeros(len(a) + len(b), np.int64)
                own = np.arange(len(a_sizes))
                a_place = np.arange(len(a)) + np.repeat(np.cumsum(b_sizes) - b_sizes, a_sizes)
                b_place = np.arange(len(b)) + np.repeat(np.cumsum(a_sizes), b_sizes)
                line[a_place], line[b_place] = a * 3, b * 3
                line[ends[own] - b_sizes - 1] += 1
                line[ends[own] - 1] += 2
                spelled = line.tolist()
                digests = []
                for start, end in zip((a_at + b_at)[:-1].tolist(), (a_at + b_at)[1:].tolist(), strict=True):
                    said = "".join(map(names.__getitem__, spelled[start:end]))[:-1]
                    digests.append(hashlib.sha256(said.encode()).hexdigest() if said else "")
                numbers = [np.diff(a_at), np.diff(b_at), np.diff(at), np.diff(at), best_to[at[1:]] - best_to[at[:-1]], sum_to[at[1:]] - sum_to[at[:-1]]]
                yield pa.RecordBatch.from_arrays(
                    [part.column(key), *[pa.array(n, pa.int64()) for n in numbers], pa.array(digests, pa.string())],
                    [key, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])
    return run


def stored(alignment: DataFrame) -> DataFrame:
    """The alignment as a table in the shared folder, which the two passes over it read."""
    spark = alignment.sparkSession
    path = work_dir(spark, "token-alignment")
    alignment.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(alignment.schema).parquet(path)


def alignment_scores(alignment: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per row of a stored alignment: sizes, ``n_best`` and ``count_sum`` over its links, and the digest of its groups.

    The digest is that of ``a1,a2|b1;a3|b2,b3`` (decimal ids, groups by ``;``), the empty string without tokens. Each group has
    one link, of its last tokens. The counts go to every task: see :func:`link_counts` for their bound, some hundred thousand
    rows for vocabularies of 50,000 tokens, whatever the rows.
    """
    spark = alignment.sparkSession
    found = link_counts(alignment).select(
        F.expr("shiftleft(a_id, 32) | b_id").alias("pair"), "links", F.col("best").cast("long").alias("best")).toArrow()
    pair, links, best = (found.column(n).to_numpy() for n in ("pair", "links", "best"))
    order = np.argsort(pair)
    counts = spark.sparkContext.broadcast((pair[order], links[order], best[order]))
    (k,) = clear_of(alignment.drop(key), "key")
    rows = alignment.select(F.col(key).alias(k), *ARRAYS)
    kind = rows.schema[k].dataType.simpleString()
    longs = ", ".join(f"{n} long" for n in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"))
    return rows.mapInArrow(_scored(counts, k), f"{k} {kind}, {longs}, groups_sha256 string").withColumnRenamed(k, key)
