"""Suffix-array dedup over bytes: what is covered by a 400-byte string that occurs twice goes.

Windows of 400 bytes meet by their minimiser (the smallest hash of their 32-byte grams). The strings
of a bucket are concatenated and their suffixes sorted in two stages: only suffixes smaller than
their successors are sorted directly, the others follow by one scan over the buckets of first
bytes. Neighbours in the suffix array with a common prefix of 400 bytes are repeats.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickweave.llm import batches as B
from tickweave.llm.frames import arrow_schema, keyed_texts
from tickweave.llm.repeats import BUCKET_WINDOWS, covered, repeated_windows

WINDOW = 400
GRAM = 32
CORE = 300      # windows of a large bucket meet by their smallest string of this many bytes
U64 = np.uint64


# ------------------------------------------------------------------------------ suffix arrays
def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position as one big-endian number, zeros beyond the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(U64)
    out = np.zeros(len(data), U64)
    for i in range(8):
        out = (out << U64(8)) | padded[i:i + len(data)]
    return out


def smaller_than_next(data: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it (the empty suffix is the smallest)."""
    n = len(data)
    rises = np.zeros(n, bool)
    differs = np.zeros(n, bool)
    rises[:-1], differs[:-1] = data[:-1] < data[1:], data[:-1] != data[1:]
    differs[-1] = True
    # an equal byte decides like the next place where bytes differ
    place = np.where(differs, np.arange(n), n)
    ahead = np.minimum.accumulate(place[::-1])[::-1]
    return rises[ahead]


def dense_ranks(*keys: np.ndarray) -> np.ndarray:
    """Ranks from 1, equal for equal keys (most significant first)."""
    order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
    fresh = np.zeros(len(order), np.int64)
    fresh[:1] = 1
    for key in keys:
        fresh[1:] |= key[order[1:]] != key[order[:-1]]
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(fresh)
    return ranks


def sort_directly(data: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """Order the suffixes at ``places`` (those smaller than their successors) by ``depth`` bytes.

    A suffix is the chain of its pieces, each from one such place up to the next. Pieces get ranks;
    doubling the number of pieces compared sorts the chains. A piece that ends where another
    goes on is the larger one, for its last byte begins a suffix that is smaller than its successor.
    """
    count, n = len(places), len(data)
    ends = np.append(places[1:] + 1, n)        # the next place's byte belongs to the piece
    sizes = ends - places
    word = words_at(data)
    last = np.zeros(count, bool)
    last[-1:] = True
    ranks, step, left = None, 0, np.arange(count)
    while True:
        # eight bytes of (piece, 0xFF); the text's own end sorts below everything instead
        at = places[left] + step
        room = np.clip(sizes[left] - step, 0, 8)
        key = np.where(room > 0, word[np.minimum(at, n - 1)], U64(0))
        keep = (U64(0xFFFFFFFFFFFFFFFF) << ((U64(8) - room.astype(U64)) * U64(8) % U64(64)))
        key = np.where(room == 8, key, np.where(room == 0, U64(0), key & keep))
        ending = (sizes[left] - step >= 0) & (sizes[left] - step < 8) & ~last[left]
        key = np.where(ending, key | (U64(0xFF) << (U64(56) - U64(8) * (room.astype(U64) % U64(8)))),
                       key)
        if ranks is None:
            ranks = dense_ranks(key)
        else:
            full = np.zeros(count, U64)
            full[left] = key
            ranks = dense_ranks(ranks, full)
        step += 8
        left = np.flatnonzero(sizes >= step)
        if not len(left):
            break
    span = 1
    while True:
        tops = int(ranks.max(initial=0))
        if tops == count:
            break
        tied = np.bincount(ranks, minlength=tops + 1)[ranks] > 1
        reach = places[np.minimum(np.arange(count) + span, count - 1)] - places
        inner = np.arange(count) + span < count
        if not (tied & inner & (reach < depth)).any():
            break
        follow = np.zeros(count, np.int64)
        follow[:-span] = ranks[span:]
        ranks = dense_ranks(ranks * (tops + 1) + follow)
        span *= 2
    return places[np.argsort(ranks, kind="stable")]


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in order of their first ``depth`` bytes, by two-stage sorting."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    small = smaller_than_next(data)
    places = np.flatnonzero(small)
    direct = sort_directly(data, places, depth + 1) if len(places) else places
    heads = data[direct]
    cuts = np.searchsorted(heads, np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[data[-1]].append(np.array([n - 1]))     # it precedes the empty suffix
    out = []
    for byte in np.flatnonzero(np.bincount(data, minlength=256)):
        # larger than their successors: induced from smaller buckets, then from this one
        group = list(waiting[byte])
        current = np.concatenate(group) if group else np.zeros(0, np.int64)
        while len(current):
            before = current[current > 0] - 1
            current = before[(data[before] == byte) & ~small[before]]
            if len(current):
                group.append(current)
        group.append(direct[cuts[byte]:cuts[byte + 1]])
        bucket = np.concatenate(group)
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        first = data[before]
        chosen = (first > byte) & ~small[before]
        before, first = before[chosen], first[chosen]
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        borders = np.flatnonzero(np.diff(first, prepend=-1).astype(bool)) if len(first) else []
        for low, high in zip(borders, [*borders[1:], len(first)]):
            waiting[first[low]].append(before[low:high])
    return np.concatenate(out)


def equal_prefixes(data: np.ndarray, left: np.ndarray, right: np.ndarray, size: int) -> np.ndarray:
    """Whether the common prefix of each pair of suffixes has ``size`` bytes or more."""
    word = words_at(data)
    alive = np.flatnonzero((left + size <= len(data)) & (right + size <= len(data)))
    for step in range(0, size, 8):
        step = min(step, size - 8)
        alive = alive[word[left[alive] + step] == word[right[alive] + step]]
    out = np.zeros(len(left), bool)
    out[alive] = True
    return out


# ------------------------------------------------------------------------------ the operator
def cut(piece: B.Slice, hashes: bool = True, gram: int = GRAM):
    codes = B.BYTE_CODES[piece.data]
    one = B.Rolling(codes, 0)
    row, start, size, least = B.minimiser_cuts(one.grams(gram), piece.offsets, gram, WINDOW)
    if not hashes:
        return row, start, size, least
    end = start + size + WINDOW - 1
    s1, s2 = one.ranges(start, end), B.Rolling(codes, 1).ranges(start, end)
    return row, start - piece.offsets[row], size, least, s1, s2


def recut(piece: B.Slice):
    return cut(piece, gram=CORE)


def content(piece: B.Slice, row, start, size) -> pa.Array:
    low = piece.offsets[row] + start
    return B.to_binary(piece.data, low, low + size + WINDOW - 1)


def window_hashes(piece: B.Slice, row, start):
    low, codes = piece.offsets[row] + start, B.BYTE_CODES[piece.data]
    return (B.Rolling(codes, 0).ranges(low, low + WINDOW),
            B.Rolling(codes, 1).ranges(low, low + WINDOW))


def resolve(table: pa.Table):
    """Windows of whole buckets whose 400 bytes occur twice, by their suffix array."""
    data, offsets = B.binary_values(table.column("content"))
    low, owner = B.window_starts(offsets, WINDOW)
    place = low - offsets[owner]
    number = np.full(len(data), -1)
    number[low] = np.arange(len(low))
    order = number[suffix_array(data, WINDOW)]
    order = order[order >= 0]
    same = equal_prefixes(data, low[order[:-1]], low[order[1:]], WINDOW)
    flags = np.zeros(len(low), bool)
    flags[order[:-1]] |= same
    flags[order[1:]] |= same
    return flags, owner, place


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   bucket_windows: int = BUCKET_WINDOWS, digest: bool = False) -> DataFrame:
    """Per row: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (binary).

    A byte of the UTF-8 text goes if a 400-byte string that covers it also starts anywhere else in
    the rows, the same row included; strings are judged on the input and do not cross rows. A
    repeated row counts as another place. ``n_spans`` is the number of maximal removed runs. A null
    text is empty. With ``digest`` the last column is ``kept_sha256`` (lower-case hex) instead.
    """
    last = "kept_sha256 string" if digest else "kept binary"
    ddl = f"doc_id long, n_bytes long, n_removed long, n_spans long, {last}"
    schema = arrow_schema(ddl)

    def finish(stream):
        for piece in B.text_slices(stream):
            gone = covered(piece.rows.column(4), piece.offsets, WINDOW)
            borders = piece.offsets
            removed = np.concatenate([[0], np.cumsum(gone)])[borders]
            head = gone.copy()
            head[1:] &= ~gone[:-1]
            firsts = borders[:-1][piece.lengths > 0]
            head[firsts] = gone[firsts]
            spans = np.concatenate([[0], np.cumsum(head)])[borders]
            kept = piece.data[~gone]
            places = borders - removed
            raw = kept.tobytes()
            texts = [raw[a:b] for a, b in zip(places[:-1].tolist(), places[1:].tolist())]
            if digest:
                texts = [hashlib.sha256(t).hexdigest() for t in texts]
            yield B.batch_of(schema, piece.rows.column(2), piece.lengths, np.diff(removed),
                             np.diff(spans), texts)

    marked = repeated_windows(keyed_texts(docs, id_col, text_col), cut, content, window_hashes,
                              resolve, keep_first=False, bucket_windows=bucket_windows, recut=recut)
    return marked.mapInArrow(finish, ddl)
