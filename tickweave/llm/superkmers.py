"""Substring dedup over words: windows of 20 words that occurred before are removed.

Consecutive windows that share a minimiser (the smallest hash of their 5-word grams) travel as one
packed string of words to the minimiser's bucket; there the windows of all strings are sorted, so
equal windows lie side by side and the first occurrence of each is known exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickweave.llm import batches as B
from tickweave.llm.frames import arrow_schema, keyed_texts
from tickweave.llm.repeats import BUCKET_WINDOWS, covered, repeated_windows

WINDOW = 20
GRAM = 5


def rolls(codes: np.ndarray) -> tuple[B.Rolling, B.Rolling]:
    return B.Rolling(codes, 0), B.Rolling(B.mix(codes), 1)


def cut(piece: B.Slice, hashes: bool = True):
    words = B.find_words(piece.data, piece.offsets)
    one = B.Rolling(words.code, 0)
    row, start, size, least = B.minimiser_cuts(one.grams(GRAM), words.first, GRAM, WINDOW)
    if not hashes:
        return row, start, size, least
    two = B.Rolling(B.mix(words.code), 1)
    end = start + size + WINDOW - 1
    return row, start - words.first[row], size, least, one.ranges(start, end), two.ranges(start, end)


def content(piece: B.Slice, row, start, size) -> pa.Array:
    words = B.find_words(piece.data, piece.offsets)
    low = words.first[row] + start
    return B.to_binary(piece.data, words.start[low], words.end[low + size + WINDOW - 2])


def window_hashes(piece: B.Slice, row, start):
    words = B.find_words(piece.data, piece.offsets)
    one, two = rolls(words.code)
    low = words.first[row] + start
    return one.ranges(low, low + WINDOW), two.ranges(low, low + WINDOW)


def resolve(table: pa.Table):
    """Sort the windows of whole buckets; all but the first of equal ones are flagged."""
    data, offsets = B.binary_values(table.column("content"))
    words = B.find_words(data, offsets)
    one, two = rolls(words.code)
    low, owner = B.window_starts(words.first, WINDOW)
    place = low - words.first[owner]
    ident, text = (table.column(c).to_numpy()[owner] for c in ("_id", "_h"))
    at = table.column("start").to_numpy()[owner] + place
    w1, w2 = one.ranges(low, low + WINDOW), two.ranges(low, low + WINDOW)
    order = np.lexsort((at, text, ident, w2, w1))
    same = np.zeros(len(order), bool)
    same[1:] = (w1[order[1:]] == w1[order[:-1]]) & (w2[order[1:]] == w2[order[:-1]])
    later = (ident[order[1:]] != ident[order[:-1]]) | (text[order[1:]] != text[order[:-1]]) | (
        at[order[1:]] != at[order[:-1]])
    same[1:] &= later  # a window of the same place in a repeated row is the same window
    flags = np.zeros(len(order), bool)
    flags[order] = same
    return flags, owner, place


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   bucket_windows: int = BUCKET_WINDOWS) -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``n_removed``, ``kept`` (words joined by one space).

    A word goes if a window that covers it has the same words as a window that starts earlier:
    in a row of smaller id (null is smallest; rows of equal id order by a hash of their text), or
    earlier in the same row. Windows are judged on the input. Rows equal in id and text count as
    one document. A null or empty text has no words and keeps the empty text.
    """
    schema = arrow_schema("doc_id long, n_words long, n_removed long, kept string")

    def finish(stream):
        for piece in B.text_slices(stream):
            words = B.find_words(piece.data, piece.offsets)
            gone = covered(piece.rows.column(4), words.first, WINDOW)
            kept, borders = joined(piece, words, ~gone)
            texts = pa.Array.from_buffers(pa.string(), len(borders) - 1, [
                None, pa.py_buffer(borders.astype(np.int32)), pa.py_buffer(kept)])
            removed = np.concatenate([[0], np.cumsum(gone)])[words.first]
            yield B.batch_of(schema, piece.rows.column(2), words.counts, np.diff(removed), texts)

    marked = repeated_windows(keyed_texts(docs, id_col, text_col), cut, content, window_hashes,
                              resolve, keep_first=True, bucket_windows=bucket_windows)
    return marked.mapInArrow(finish, "doc_id long, n_words long, n_removed long, kept string")


def joined(piece: B.Slice, words: B.Words, keep: np.ndarray):
    """The kept words of each row joined by one space: content and borders."""
    row = np.repeat(np.arange(len(words.counts)), words.counts)[keep]
    start, end = words.start[keep], words.end[keep]
    more = np.zeros(len(row), np.int64)
    more[:-1] = row[1:] == row[:-1]          # another kept word of the row follows
    sizes = end - start + more
    content = piece.data[np.minimum(B.ragged(start, sizes), max(0, len(piece.data) - 1))].copy()
    ends = np.cumsum(sizes)
    content[ends[more == 1] - 1] = 0x20
    borders = np.concatenate([[0], ends])[np.searchsorted(row, np.arange(len(words.counts) + 1))]
    return content, borders

