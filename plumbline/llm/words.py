"""Words of Arrow string columns as 64-bit hashes, computed with numpy over the text bytes.

A word's hash depends on its (lower-cased) bytes only. Hashes of different words are
equal with a chance of about 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 16  # bytes hashed at a time
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15


def table(*separators: tuple[int, int]) -> np.ndarray:
    """Byte -> is part of a word, for closed ranges of separating bytes."""
    is_word = np.ones(256, bool)
    for low, high in separators:
        is_word[low:high + 1] = False
    return is_word


NOT_SPACE = table((0x20, 0x20), (0x09, 0x0D))
ALPHANUMERIC = table((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
_VALUES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)


def _powers(base: int, count: int) -> np.ndarray:
    out = np.ones(count, np.uint64)
    if count > 1:
        out[1:] = np.uint64(base)
        np.multiply.accumulate(out, out=out)
    return out


_POWERS = [np.empty(0, np.uint64), np.empty(0, np.uint64)]


def _power_tables(count: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < count:
        _POWERS[0] = _powers(_BASE, count)
        _POWERS[1] = _powers(pow(_BASE, -1, 1 << 64), count)
    return _POWERS


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A second, independent-looking 64-bit value for each hash."""
    out = h ^ np.uint64((salt * 0xD6E8FEB86659FD93) & _MASK)
    shifted = out >> np.uint64(32)
    out ^= shifted
    out *= np.uint64(0xD6E8FEB86659FD93)
    np.right_shift(out, np.uint64(29), out=shifted)
    out ^= shifted
    out *= np.uint64(0xBF58476D1CE4E5B9)
    np.right_shift(out, np.uint64(32), out=shifted)
    out ^= shifted
    return out


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def hash_words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word in order, and the number of words of each row."""
    found, starts_at = [], []
    edges = offsets[1:-1]
    at = 0
    while at < len(data):
        end = min(at + BLOCK, len(data))
        while end < len(data):  # a block ends where a word does
            rest = ~is_word[LOWER[data[end:end + BLOCK]]]
            if rest.any():
                end += int(rest.argmax())
                break
            end = min(end + BLOCK, len(data))
        part = LOWER[data[at:end]]
        inside = is_word[part]
        cut = edges[np.searchsorted(edges, at):np.searchsorted(edges, end)] - at
        before = np.empty_like(inside)
        before[0], before[1:] = False, inside[:-1]
        before[cut] = False
        starts = np.flatnonzero(inside & ~before)
        after = np.empty_like(inside)
        after[-1], after[:-1] = False, inside[1:]
        after[cut[cut > 0] - 1] = False
        ends = np.flatnonzero(inside & ~after) + 1
        up, down = _power_tables(len(part))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_VALUES[part] * up[:len(part)], out=sums[1:])
        found.append(mix((sums[ends] - sums[starts]) * down[starts]))
        starts_at.append(starts + at)
        at = end
    hashes = np.concatenate(found) if found else np.empty(0, np.uint64)
    starts = np.concatenate(starts_at) if starts_at else np.empty(0, np.int64)
    return hashes, np.diff(np.searchsorted(starts, offsets))


def slabs(batch: pa.RecordBatch, column: str, size: int = 1 << 19) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Slices of a batch with about ``size`` text bytes each (one row at least) and their first row's place."""
    _, offsets = text_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, batch.slice(at, end - at)
        at = end


def _shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each place on."""
    whole = len(hashes) - n + 1
    rolled = np.zeros(max(whole, 0), np.uint64)
    for j in range(n if whole > 0 else 0):
        rolled *= np.uint64(_BASE)
        rolled += hashes[j:j + whole]
    return mix(rolled, n)


def _as_one(hashes: np.ndarray) -> np.ndarray:
    """One hash of all words, which are fewer than a shingle's."""
    one = np.zeros(1, np.uint64)
    for h in hashes:
        one = one * np.uint64(_BASE) + h
    return mix(one, len(hashes))


def shingle_sets(batch: pa.RecordBatch, column: str, n: int, is_word: np.ndarray = NOT_SPACE) -> Iterator[np.ndarray]:
    """Each row's sorted distinct ``n``-word shingles; all its words as one where it has fewer, nothing without words."""
    for _, part in slabs(batch, column):
        hashes, counts = hash_words(*text_bytes(part.column(column)), is_word)
        rolled = _shingles(hashes, n)
        at = 0
        for count in counts.tolist():
            if count >= n:
                yield np.unique(rolled[at:at + count - n + 1])
            else:
                yield _as_one(hashes[at:at + count]) if count else hashes[:0]
            at += count


def leveled_sets(
    batch: pa.RecordBatch, column: str, n: int, levels: np.ndarray, is_word: np.ndarray = NOT_SPACE,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The sets of :func:`shingle_sets` with the sum of the words' ``levels`` for each member."""
    shift = np.uint64(64 - (len(levels) - 1).bit_length())
    for _, part in slabs(batch, column):
        hashes, counts = hash_words(*text_bytes(part.column(column)), is_word)
        rolled = _shingles(hashes, n)
        own = levels[(hashes >> shift).astype(np.int64)].astype(np.uint16)
        sums = np.zeros(len(rolled), np.uint16)
        for j in range(n if len(rolled) else 0):
            sums += own[j:j + len(rolled)]
        at = 0
        for count in counts.tolist():
            if count >= n:
                members, first = np.unique(rolled[at:at + count - n + 1], return_index=True)
                yield members, sums[at:at + count - n + 1][first]
            else:
                yield (_as_one(hashes[at:at + count]), np.zeros(1, np.uint16)) if count else (hashes[:0], sums[:0])
            at += count


def word_cells(batch: pa.RecordBatch, column: str, cells: int, is_word: np.ndarray = NOT_SPACE) -> np.ndarray:
    """Number of words that fall into each cell of the hash range."""
    out = np.zeros(cells, np.int64)
    for _, part in slabs(batch, column):
        hashes, _ = hash_words(*text_bytes(part.column(column)), is_word)
        out += np.bincount((hashes >> np.uint64(64 - (cells - 1).bit_length())).astype(np.int64), minlength=cells)
    return out
