"""Benchmark decontamination by winnowing.

Every window of 13 words keeps the smallest hash of its 5-word grams as its fingerprint. Two equal
windows have equal fingerprints, so a join on fingerprints meets every shared span of 13 words or
more; hits are then extended over all windows of the run and confirmed by a 128-bit hash of the
whole window. Items of fewer words are one window of their own length, fingerprinted by all their
words.

A bitmap of fixed size over the benchmark's fingerprints thins the documents' windows inside the
scan; what passes is joined by a shuffle, so the benchmark may have any size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickweave.llm import batches as B
from tickweave.llm.frames import keyed_texts, materialize, quoted

WINDOW = 13
GRAM = 5
SLOTS = 1 << 22  # bits of the bitmap: half a megabyte, whatever the benchmark holds
WIN = pa.struct([("start", pa.int32()), ("size", pa.int32()), ("fp", pa.int64()),
                 ("a", pa.int64()), ("b", pa.int64())])
WINS_DDL = "array<struct<start:int,size:int,fp:long,a:long,b:long>>"


def fingerprints(words: B.Words, rolls, rows: np.ndarray, size: int):
    """Starts, rows and fingerprints of the windows of ``size`` words in the given rows."""
    first = words.first
    starts, row = B.window_starts(first, size)
    chosen = rows[row]
    starts, row = starts[chosen], row[chosen]
    if size == WINDOW:
        least = B.sliding_min(rolls[0].grams(GRAM), WINDOW - GRAM + 1)
        return starts, row, least[starts]
    return starts, row, B.mix(rolls[0].ranges(starts, starts + size) + B.U64(size))


def windows_of(piece: B.Slice, sizes, keep, items: bool):
    """Row and window columns of one slice; ``keep`` filters by fingerprint."""
    words = B.find_words(piece.data, piece.offsets, B.ALPHANUMERIC, lower=True)
    rolls = B.Rolling(words.code, 0), B.Rolling(B.mix(words.code), 1)
    parts = []
    for size in sizes:
        rows = words.counts == size if items and size < WINDOW else words.counts >= size
        starts, row, fp = fingerprints(words, rolls, rows, size)
        hit = keep(fp)
        starts, row, fp = starts[hit], row[hit], fp[hit]
        parts.append((row, starts - words.first[row], np.full(len(row), size), fp,
                      rolls[0].ranges(starts, starts + size),
                      rolls[1].ranges(starts, starts + size)))
    columns = [np.concatenate(c) for c in zip(*parts)]
    order = np.argsort(columns[0], kind="stable")
    return words.counts, [c[order] for c in columns]


def benchmark_windows(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per distinct window and item. Items without id or words take no part."""
    schema = pa.schema([("item_id", pa.int64()), ("size", pa.int32()), ("fp", pa.int64()),
                        ("a", pa.int64()), ("b", pa.int64())])

    def run(stream):
        for piece in B.text_slices(stream):
            everything = lambda fp: np.ones(len(fp), bool)
            _, (row, _, size, fp, a, b) = windows_of(
                piece, range(1, WINDOW + 1), everything, items=True)
            ids = piece.rows.column(0).take(pa.array(row))
            yield B.batch_of(schema, ids, size, B.longs(fp), B.longs(a), B.longs(b))

    items = benchmark.select(quoted(id_col).cast("long").alias("item_id"),
                             quoted(text_col).cast("string").alias("text")).dropna()
    return items.mapInArrow(run, "item_id long, size int, fp long, a long, b long").distinct()


def bitmap(windows: DataFrame) -> np.ndarray:
    """Which of ``SLOTS`` slots some fingerprint falls into; at most ``SLOTS / 8`` rows come back."""
    slot = F.col("fp").bitwiseAND(SLOTS - 1)
    bits = windows.groupBy(F.shiftright(slot, 3).cast("int").alias("at")).agg(
        F.bit_or(F.expr(f"shiftleft(1, cast(fp & 7 as int))")).alias("bits")).toArrow()
    out = np.zeros(SLOTS // 8, np.uint8)
    out[bits.column("at").to_numpy()] = bits.column("bits").to_numpy()
    return out


def document_windows(docs: DataFrame, sizes: list[int], bits: np.ndarray) -> DataFrame:
    """Per document: number of words and the windows whose fingerprint may be the benchmark's."""
    schema = pa.schema([("_id", pa.int64()), ("_h", pa.int64()), ("doc_id", pa.int64()),
                        ("n_words", pa.int64()), ("wins", pa.list_(WIN))])

    def keep(fp):
        slot = (fp & B.U64(SLOTS - 1)).astype(np.int64)
        return (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1

    def run(stream):
        for piece in B.text_slices(stream):
            counts, (row, *columns) = windows_of(piece, sizes, keep, items=False)
            borders = np.searchsorted(row, np.arange(len(counts) + 1)).astype(np.int32)
            fields = [pa.array(c.astype(np.int32)) for c in columns[:2]]
            fields += [pa.array(B.longs(c)) for c in columns[2:]]
            wins = pa.ListArray.from_arrays(
                pa.array(borders), pa.StructArray.from_arrays(fields, fields=list(WIN)))
            yield B.batch_of(schema, *piece.rows.columns[:3], counts, wins)

    return docs.mapInArrow(
        run, f"_id long, _h long, doc_id long, n_words long, wins {WINS_DDL}")


def judged_rows(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """The rows of ``contamination`` with the keys ``_id, _h`` of ``keyed_texts``."""
    wins = materialize(benchmark_windows(benchmark, item_col, text_col))
    sizes = sorted(r["size"] for r in wins.select("size").distinct().collect())  # at most 13
    found = materialize(document_windows(
        keyed_texts(docs, id_col, text_col), sizes or [WINDOW], bitmap(wins)))

    key, sign = ["_id", "_h"], ["size", "fp", "a", "b"]
    marks = found.select(*key, F.explode("wins").alias("w")).select(*key, "w.*")
    hits = materialize(marks.join(wins.select(*sign).distinct(), sign, "left_semi"))

    # union of the hit windows of a document, in order of their starts
    ordered = Window.partitionBy(*key).orderBy("start", "size")
    end = F.col("start") + F.col("size")
    covered = hits.select(*key, "start", "size").distinct().withColumn(
        "before", F.max(end).over(ordered.rowsBetween(Window.unboundedPreceding, -1)))
    words = covered.groupBy(*key).agg(F.sum(F.greatest(
        F.lit(0), end - F.greatest("start", F.coalesce("before", F.lit(0))))).alias("n_hit"))
    items = hits.select(*key, *sign).distinct().join(wins, sign).select(
        *key, "item_id").distinct().groupBy(*key).agg(
        F.array_sort(F.collect_list(F.col("item_id").cast("string"))).alias("items"))

    no_items = F.expr("cast(array() as array<string>)")
    out = found.select(*key, "doc_id", "n_words").join(words, key, "left").join(items, key, "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select(
        *key, "doc_id", "n_words", n_hit.alias("n_hit"),
        F.coalesce("items", no_items).alias("items"),
        ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """Per document: words, words inside benchmark windows, items met, and the verdict.

    Words are maximal runs of ASCII letters and digits and all non-ASCII characters, A-Z lowered.
    ``n_hit`` counts document words inside any occurrence of an item's window, ``items`` lists the
    items with such a window (sorted as strings), ``contaminated`` is ``n_hit > 0`` and at least a
    twentieth of the words. A null or empty text has no words and is clean; rows with equal id and
    text get equal results, a null id is kept. Items without id, text or words match nothing.
    """
    return judged_rows(docs, benchmark, id_col, text_col, item_col).drop("_id", "_h")
