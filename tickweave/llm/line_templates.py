"""Line dedup with a log-template tree.

A line is parsed to a fixed depth: its number of tokens, then its leading tokens, where a token that
holds a digit or an ``@`` is a variable field. That is a leaf of the tree. Inside a leaf, lines that
differ only inside one of their four quarters share a template: each template leaves one quarter
open (short lines have no open part). Lines that agree in three quarters of their tokens but differ
in two quarters do not meet. A template needs a constant token: a line of fields only is its own
template, and an open quarter beside fields only is none. A template that occurs in two documents or
more is dropped from all of them but the first.

Leaves are counted first, one small row per line; only lines of leaves that recur go on, so prose
leaves the plan early. Counts are summed before each shuffle, so a line that a third of all
documents share is one row per task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm import batches as B
from tickweave.llm.frames import NO_ID, arrow_schema, fresh, keyed_texts, materialize

DEPTH = 3          # leading tokens
OPEN_FROM = 8      # tokens a line needs for a template with an open quarter
MIN_DOCUMENTS = 2  # documents a template occurs in to be dropped
U64 = np.uint64
VARIABLE = B.byte_set((0x30, 0x39), (0x40, 0x40))
FIELD = U64(0x2545F4914F6CDD1D)  # the code of every variable field


def parse_lines(piece: B.Slice):
    """Row, line number, tokens, leaf and template codes (five per line) of the lines with tokens.

    Templates that a line does not have are 0.
    """
    data, offsets = piece.data, piece.offsets
    ends = np.flatnonzero(data == 0x0A)
    inner = ends + 1
    inner = inner[~np.isin(inner, offsets)]
    borders = np.unique(np.concatenate([offsets, inner]))
    row = np.searchsorted(offsets, borders[:-1], "right") - 1
    number = np.arange(len(row)) - np.searchsorted(borders[:-1], offsets)[row]
    words = B.find_words(data, borders)
    marks = np.concatenate([[0], np.cumsum(VARIABLE[data])])
    codes = np.where(marks[words.end] > marks[words.start], FIELD, words.code)
    roll = B.Rolling(codes)
    size = words.counts
    filled = size > 0
    low, size, row, number = words.first[:-1][filled], size[filled], row[filled], number[filled]
    count = size.astype(U64) * U64(0x9E3779B97F4A7C15)
    lead = low + np.minimum(size, DEPTH)
    fixed = np.concatenate([[0], np.cumsum(codes != FIELD)])   # constant tokens before each
    constants = fixed[low + size] - fixed[low]
    bare = np.flatnonzero(constants == 0)                      # fields only: the tokens as they are
    plain = B.Rolling(words.code) if len(bare) else None

    def key(end):
        hashed = roll.ranges(low, end) + count
        if plain:
            hashed[bare] = plain.ranges(low[bare], end[bare]) + count[bare]
        return B.mix(hashed)

    leaf = key(lead)
    templates = np.zeros((len(low), 5), U64)
    templates[:, 0] = key(low + size)
    cuts = [low + size * q // 4 for q in range(5)]
    long = size >= OPEN_FROM
    for q in range(4):   # quarter q is open
        rest = roll.ranges(low, cuts[q]) * U64(3) + roll.ranges(cuts[q + 1], cuts[4]) + U64(q)
        kept = constants - fixed[cuts[q + 1]] + fixed[cuts[q]] + fixed[lead] - fixed[low]
        templates[:, q + 1] = np.where(long & (kept > 0), B.mix(rest + leaf), U64(0))
    return row, number, size, leaf, templates


def line_rows(docs: DataFrame) -> DataFrame:
    """One row per line with tokens: keys, line number, tokens of line and text, leaf, templates."""
    ddl = "_id long, _h long, line int, tokens int, total int, leaf long, templates array<long>"
    schema = arrow_schema(ddl)

    def run(stream):
        for piece in B.text_slices(stream):
            row, number, size, leaf, templates = parse_lines(piece)
            total = np.bincount(row, size, minlength=piece.rows.num_rows).astype(np.int32)[row]
            kept = templates != 0
            borders = np.concatenate([[0], np.cumsum(kept.sum(axis=1))])
            at = pa.array(row)
            yield B.batch_of(
                schema, piece.rows.column(0).take(at), piece.rows.column(1).take(at),
                number.astype(np.int32), size.astype(np.int32), total, B.longs(leaf),
                pa.ListArray.from_arrays(pa.array(borders, pa.int32()),
                                         pa.array(B.longs(templates[kept]))))

    return docs.mapInArrow(run, ddl)


def leaf_rows(docs: DataFrame) -> DataFrame:
    """The distinct leaves of each document."""
    schema = arrow_schema("leaf long")

    def run(stream):
        for piece in B.text_slices(stream):
            row, _, _, leaf, _ = parse_lines(piece)
            order = np.lexsort((leaf, row))
            row, leaf = row[order], leaf[order]
            fresh = np.ones(len(row), bool)
            fresh[1:] = (row[1:] != row[:-1]) | (leaf[1:] != leaf[:-1])
            yield B.batch_of(schema, B.longs(leaf[fresh]))

    return docs.mapInArrow(run, "leaf long")


def recurring_lines(docs: DataFrame, min_documents: int, leave_copies: float | None) -> DataFrame:
    """``_id, _h, lines``: numbers of the lines to drop of each document that has some."""
    often = leaf_rows(docs).groupBy("leaf").count().filter(F.col("count") >= min_documents)
    lines = materialize(line_rows(docs).join(often.select("leaf"), "leaf", "left_semi"))
    key = ["_id", "_h"]
    uses = lines.select(*key, F.explode("templates").alias("template"), "line", "tokens", "total")
    # every document counts once
    templates = uses.select(*key, "template").distinct().groupBy("template").agg(
        F.count(F.lit(1)).alias("documents"), F.min(F.struct(*key)).alias("first"))
    # written, so that both sides of the next join are shuffled for it and a hot template is split
    templates = materialize(
        templates.filter(F.col("documents") >= min_documents).select("template", "first"))
    drops = uses.join(templates, "template").filter(F.struct(*key) != F.col("first")).select(
        *key, "first", "line", "tokens", "total").distinct()
    if leave_copies is not None:
        drops = materialize(drops)
    found = drops.select(*key, "line", "tokens").distinct().groupBy(*key).agg(
        F.array_sort(F.collect_set("line")).alias("lines"), F.sum("tokens").alias("lost"))
    if leave_copies is not None:
        found = materialize(found)
        copies = copies_of_one(drops, found, lines.select(*key, "total").distinct(), leave_copies)
        found = found.join(copies, key, "left_anti")
    return found.select(*key, "lines")


def copies_of_one(drops: DataFrame, found: DataFrame, totals: DataFrame, share: float) -> DataFrame:
    """``_id, _h`` of the documents that are copies of the one that has most of their lines first.

    Of two documents only what third ones do not have before counts. They are copies if the tokens
    that they share are at least ``share`` of the tokens of both together.
    """
    key = ["_id", "_h"]
    lost = found.select(*key, "lost")
    held = drops.groupBy(*key, "first").agg(F.sum("tokens").alias("held"), F.max("total").alias("total"))
    most = held.groupBy(*key).agg(F.min(F.struct(-F.col("held"), "first", "total")).alias("most")).select(
        *key, (-F.col("most.col1")).alias("held"), F.col("most.first").alias("first"), "most.total")
    pairs = most.join(lost, key).select(
        *key, "held", (F.col("total") - F.col("lost") + F.col("held")).alias("own"),
        F.col("first._id").alias("f_id"), F.col("first._h").alias("f_h"))
    firsts = totals.join(lost, key, "left").select(
        F.col("_id").alias("f_id"), F.col("_h").alias("f_h"),
        (F.col("total") - F.coalesce("lost", F.lit(0))).alias("f_own"))
    shared = F.least("held", "f_own")
    return pairs.join(firsts, ["f_id", "f_h"]).filter(
        shared >= share * (F.col("own") + F.col("f_own") - shared)).select(*key)


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         min_documents: int = MIN_DOCUMENTS,
                         leave_copies: float | None = None, lines_out: str = "n_lines",
                         dropped_out: str = "n_dropped") -> DataFrame:
    """``docs`` with ``text`` less its recurring lines, and ``n_lines`` and ``n_dropped`` appended.

    The document that has a template first (smallest id, null below all, then text hash) keeps it.
    Rows equal in id and text are one document. With ``leave_copies``, a document that shares that
    part of its tokens or more with the document that has its lines first (``copies_of_one``) is left
    whole, for a document-level dedup to judge. Lines without tokens stay. A null text stays null
    with no lines; an empty one has one empty line. Other columns are kept; columns with the names
    of the two counts (``lines_out``, ``dropped_out``) are replaced.
    """
    found = recurring_lines(keyed_texts(docs, id_col, text_col), min_documents, leave_copies)
    text = F.col(f"`{text_col}`").cast("string")
    ident = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID))
    key_id, key_h, drop = fresh(docs.columns, "_key_id", "_key_h", "_drop")
    found = found.select(F.col("_id").alias(key_id), F.col("_h").alias(key_h),
                         F.col("lines").alias(drop))
    joined = docs.drop(lines_out, dropped_out).join(
        found, (ident == F.col(key_id)) & (F.xxhash64(text) == F.col(key_h)), "left")
    parts = F.split(text, "\n", -1)
    kept = F.array_join(F.filter(
        parts, lambda _, i: ~F.array_contains(drop, i)), "\n")
    columns = [F.when(F.col(drop).isNull(), text).otherwise(kept).alias(c) if c == text_col
               else F.col(f"`{c}`") for c in docs.columns if c not in (lines_out, dropped_out)]
    return joined.select(
        *columns, F.when(text.isNull(), 0).otherwise(F.size(parts)).cast("long").alias(lines_out),
        F.when(F.col(drop).isNull(), 0).otherwise(F.size(drop)).cast("long").alias(dropped_out))
