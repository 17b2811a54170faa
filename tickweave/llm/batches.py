"""Numpy helpers for ``mapInArrow`` tasks: text slices, words, rolling hashes, minimisers, groups.

All of them work on bounded slices of a partition: a slice holds whole rows of about
``SLICE_BYTES`` of text, so the arrays of one slice stay at a few tens of megabytes whatever the
partition or the Arrow batch holds. One text longer than that is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
U64 = np.uint64


# ---------------------------------------------------------------------------------- text slices
@dataclass
class Slice:
    """Some rows of a batch and their texts as one byte buffer (null texts are empty)."""

    rows: pa.RecordBatch
    data: np.ndarray      # uint8
    offsets: np.ndarray   # int64, rows + 1

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.offsets)

    def bytes_of(self, row: int) -> bytes:
        return self.data[self.offsets[row]:self.offsets[row + 1]].tobytes()


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[Slice]:
    for batch in batches:
        if batch.num_rows == 0:
            continue
        texts = batch.column(batch.schema.get_field_index(column))
        if texts.null_count:
            texts = texts.fill_null("")
        wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
        _, index, content = texts.buffers()
        offsets = np.frombuffer(index, np.int64 if wide else np.int32)
        offsets = offsets[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(content, np.uint8) if content is not None else np.zeros(0, np.uint8)
        first = 0
        while first < len(texts):
            last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
            last = min(max(last, first + 1), len(texts))
            low, high = offsets[first], offsets[last]
            yield Slice(batch.slice(first, last - first), data[low:high],
                        offsets[first:last + 1] - low)
            first = last


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """A record batch from arrays or lists in the order of ``schema``."""
    return pa.RecordBatch.from_arrays(
        [c.cast(f.type) if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type)
         for c, f in zip(columns, schema)], schema=schema)


def longs(values: np.ndarray) -> np.ndarray:
    """Unsigned hashes as the signed longs Spark stores."""
    return np.ascontiguousarray(values).view(np.int64)


# ---------------------------------------------------------------------------------- hashing
def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (the splitmix64 finaliser); works on a copy."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def random_words(count: int, seed: int) -> np.ndarray:
    """``count`` fixed pseudo-random 64-bit values."""
    return mix(np.arange(1, count + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))


def random_odd(count: int, seed: int) -> np.ndarray:
    return random_words(count, seed) | U64(1)


BYTE_CODES = random_words(256, 11)
BASES = tuple(int(x) for x in random_odd(2, 12))


class Powers:
    """Powers of an odd base modulo 2**64 and their inverses, grown on demand."""

    def __init__(self, base: int):
        self.base = base
        self.inverse = pow(base, -1, 1 << 64)
        self.up = np.ones(1, U64)
        self.down = np.ones(1, U64)

    def ensure(self, count: int) -> "Powers":
        if len(self.up) < count:
            def run(base):
                steps = np.full(count, base, U64)
                steps[0] = 1
                return np.multiply.accumulate(steps)
            self.up, self.down = run(self.base), run(self.inverse)
        return self


POWERS = tuple(Powers(base) for base in BASES)


class Rolling:
    """Hash of any range of a sequence in constant time (two polynomials modulo 2**64)."""

    def __init__(self, codes: np.ndarray, which: int = 0):
        powers = POWERS[which].ensure(len(codes) + 1)
        self.down = powers.down
        self.sums = np.zeros(len(codes) + 1, U64)
        np.cumsum(codes * powers.up[:len(codes)], out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start]
                   + (end - start).astype(U64))

    def grams(self, k: int) -> np.ndarray:
        """Hash of each run of ``k`` codes, by start."""
        count = max(0, len(self.sums) - k)
        out = self.sums[k:] - self.sums[:count]
        out *= self.down[:count]
        return mix(out)


# ---------------------------------------------------------------------------------- words
@dataclass
class Words:
    start: np.ndarray    # byte position in the slice
    end: np.ndarray
    code: np.ndarray     # 64-bit hash of the word
    first: np.ndarray    # per row: index of its first word, rows + 1 entries

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low:high + 1] = True
    return table


# fixed values: word bytes. UTF-8 keeps every byte of a non-ASCII character above 0x7F.
ALPHANUMERIC = byte_set((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
NOT_SPACE = ~byte_set((0x20, 0x20), (0x09, 0x0D))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def find_words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = NOT_SPACE,
               lower: bool = False) -> Words:
    """Maximal runs of ``inside`` bytes that do not cross a row border."""
    if lower:
        data = LOWER[data]
    n = len(data)
    mask = inside[data]
    begins, ends = mask.copy(), mask.copy()
    if n:
        begins[1:] &= ~mask[:-1]
        ends[:-1] &= ~mask[1:]
        filled = offsets[:-1] < offsets[1:]
        heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
        begins[heads] = mask[heads]
        ends[tails] = mask[tails]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    code = np.zeros(len(start), U64)
    if len(start):
        sizes = end - start
        packed = np.zeros(len(start), np.int64)
        np.cumsum(sizes[:-1], out=packed[1:])
        place = np.arange(int(sizes.sum())) - np.repeat(packed, sizes)
        powers = POWERS[1].ensure(int(sizes.max())).up
        code = mix(np.add.reduceat(BYTE_CODES[data[mask]] * powers[place], packed)
                   + sizes.astype(U64))
    return Words(start, end, code, np.searchsorted(start, offsets))


def window_starts(first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the runs of ``k`` items inside each row, and the row of each."""
    counts = np.maximum(0, np.diff(first) - k + 1)
    row = np.repeat(np.arange(len(counts)), counts)
    return ramp(counts) + first[:-1][row], row


def ramp(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count, one after another."""
    total = int(counts.sum())
    before = np.cumsum(counts) - counts
    return np.arange(total) - np.repeat(before, counts)


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices ``starts[i] .. starts[i]+counts[i]-1`` for each i, one after another."""
    return np.repeat(starts, counts) + ramp(counts)


# ---------------------------------------------------------------------------------- minimisers
def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by start, in linear time."""
    n = len(values)
    if n < width:
        return values[:0]
    whole = -(-n // width) * width
    padded = np.full(whole, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def minimiser_runs(grams: np.ndarray, first: np.ndarray, k: int, window: int):
    """Cut the windows of each row into runs that share a minimiser.

    ``grams`` are the hashes of all runs of ``k`` items, ``first`` the item borders of the rows; a
    window is ``window`` items and its minimiser the smallest of its gram hashes. Returns row,
    first window start, number of windows and minimiser of each run.
    """
    least = sliding_min(grams, window - k + 1)
    starts, row = window_starts(first, window)
    if not len(starts):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, np.zeros(0, U64)
    least = least[starts]
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(fresh)
    return row[at], starts[at], np.diff(np.append(at, len(starts))), least[at]


# ---------------------------------------------------------------------------------- groups
def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str],
                  limit: int) -> Iterator[pa.Table]:
    """Tables of whole key groups from batches sorted by ``keys``.

    A table holds as many whole groups as come until ``limit`` rows are reached; the caller sees
    to it that no single group is large.
    """
    held: list[pa.RecordBatch] = []
    rows = 0
    pieces = (b.slice(low, limit) for b in batches for low in range(0, b.num_rows, limit))
    for piece in pieces:
        held.append(piece)
        rows += piece.num_rows
        if rows < limit:
            continue
        table = pa.Table.from_batches(held)
        cut = last_change(table, keys)
        if cut:
            yield table.slice(0, cut)
            table = table.slice(cut)
        held, rows = table.to_batches(), table.num_rows
    if rows:
        yield pa.Table.from_batches(held)


def last_change(table: pa.Table, keys: list[str]) -> int:
    """Row at which the last group of a sorted table begins."""
    return int(group_starts(table, keys)[-1])


def group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    fresh = np.zeros(table.num_rows, bool)
    fresh[0] = True
    for key in keys:
        values = table.column(key).to_numpy()
        fresh[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(fresh)


def binary_values(column) -> tuple[np.ndarray, np.ndarray]:
    """Content and offsets of a binary or string column."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(array, pa.ChunkedArray):
        array = pa.concat_arrays(array.chunks)
    wide = pa.types.is_large_binary(array.type) or pa.types.is_large_string(array.type)
    _, index, content = array.buffers()
    offsets = np.frombuffer(index, np.int64 if wide else np.int32)
    offsets = offsets[array.offset:array.offset + len(array) + 1].astype(np.int64)
    data = np.frombuffer(content, np.uint8) if content is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def to_binary(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary values cut out of a byte buffer (ranges may overlap)."""
    sizes = ends - starts
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    content = data[ragged(starts, sizes)]
    return pa.Array.from_buffers(pa.binary(), len(sizes), [
        None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(content))])


def minimiser_cuts(grams: np.ndarray, first: np.ndarray, k: int, window: int):
    """Like ``minimiser_runs``, cut by the place of the minimiser instead of its value.

    The leftmost of equal grams (by their upper 32 bits) is the minimiser, so the place is a matter
    of the window's content alone; a run has at most ``window - k + 1`` windows.
    """
    place = np.arange(len(grams), dtype=U64)
    key = (grams & U64(0xFFFFFFFF00000000)) | place
    row, start, count, least = minimiser_runs(key, first, k, window)
    return row, start, count, grams[(least & U64(0xFFFFFFFF)).astype(np.int64)]
