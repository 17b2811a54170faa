"""The shared plan of the two operators that look for repeated windows.

1. Each text is cut into runs of consecutive windows that share a minimiser. Equal windows have
   equal minimisers, so they meet in one bucket. A run carries a 128-bit hash of its content.
2. Only runs whose minimiser occurs more than once go on: minimisers are counted first, and a
   bitmap of fixed size thins the runs inside the second scan.
3. Equal runs become one string with a count and its first occurrence, so a hot text travels once.
4. Where a bucket holds different strings, their content is fetched from the first occurrence and
   travels as one packed string to the bucket, which finds the windows they share. A bucket too
   large for one task is split: its runs are cut again by a much longer gram, so that only runs
   which share that gram meet, again one string for equal ones; what is still too large, or has no
   second cut, is spread by the hash of each window.
5. What was found about a string holds for all its occurrences; runs of windows return to the
   documents.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm import batches as B
from tickweave.llm.bitmaps import bitmap_of
from tickweave.llm.frames import arrow_schema, materialize

RUN_DDL = "_id long, _h long, start int, size int, least long, s1 long, s2 long"
NAME = ["least", "s1", "s2"]
BUCKET_WINDOWS = 200_000   # beyond it a bucket's windows are spread by their own hash
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("size", pa.int32())]))
SPANS_DDL = "array<struct<start:int,size:int>>"
BUCKET_BYTES = 2 << 20     # the same for the packed strings of a second cut
#: a packed string has content; a part of a run of a large bucket has its place, windows, hash and
#: second minimiser too; a single window has a place and its hash and no content
SENT_DDL = f"{RUN_DDL}, content binary, place int, w1 long, w2 long, windows int, core long"
PART = ["core", "w1", "w2"]
MINIMISER_SLOTS = 1 << 27  # 16 MB
DOCUMENT_SLOTS = 1 << 24   # 2 MB
BUCKET_ROWS = 1024         # packed strings resolved together


def span_lists(owner: np.ndarray, start: np.ndarray, size: np.ndarray, count: int) -> pa.Array:
    """Spans grouped by owner 0..count-1 (owners ascending) as a list column."""
    borders = np.searchsorted(owner, np.arange(count + 1)).astype(np.int32)
    spans = pa.StructArray.from_arrays(
        [pa.array(start.astype(np.int32)), pa.array(size.astype(np.int32))], names=["start", "size"])
    return pa.ListArray.from_arrays(pa.array(borders), spans)


def marked_spans(flags: np.ndarray, owner: np.ndarray, place: np.ndarray):
    """Maximal runs of set flags inside each owner; all arrays in order of (owner, place)."""
    at = np.flatnonzero(flags)
    if not len(at):
        return at, at, at
    fresh = np.ones(len(at), bool)
    fresh[1:] = (owner[at[1:]] != owner[at[:-1]]) | (place[at[1:]] != place[at[:-1]] + 1)
    head = np.flatnonzero(fresh)
    return owner[at[head]], place[at[head]], np.diff(np.append(head, len(at)))


def covered(spans: pa.Array, offsets: np.ndarray, window: int) -> np.ndarray:
    """Which items lie inside a marked window; ``spans`` are per row, relative to its first item."""
    total = int(offsets[-1])
    lists = spans.combine_chunks() if isinstance(spans, pa.ChunkedArray) else spans
    if lists.null_count == len(lists):
        return np.zeros(total, bool)
    flat, sizes = lists.flatten(), np.nan_to_num(np.asarray(
        lists.value_lengths().to_numpy(zero_copy_only=False), float)).astype(np.int64)
    base = np.repeat(offsets[:-1], sizes)
    start = base + flat.field("start").to_numpy()
    end = start + flat.field("size").to_numpy() + window - 1
    steps = np.zeros(total + 1, np.int64)
    np.add.at(steps, start, 1)
    np.add.at(steps, end, -1)
    return np.cumsum(steps[:total]) > 0


def repeated_windows(
    docs: DataFrame,
    cut: Callable,
    content: Callable,
    window_hashes: Callable,
    resolve: Callable,
    keep_first: bool,
    bucket_windows: int = BUCKET_WINDOWS,
    recut: Callable | None = None,
) -> DataFrame:
    """``docs`` (``_id, _h, doc_id, text``) with ``spans``, the runs of repeated windows.

    With ``keep_first`` the first occurrence in order of (id, text hash, start) of each window is
    not counted as repeated; otherwise every window that occurs twice is.

    ``cut(slice)`` gives row, start, size, minimiser and two hashes of each run; ``content(slice,
    rows, starts, sizes)`` packs runs; ``window_hashes(slice, rows, starts)`` hashes windows;
    ``resolve(table)`` takes packed strings of whole buckets and gives flags, owners and places of
    their windows. ``recut(slice)`` cuts packed strings like ``cut``, by a longer gram; it is for
    ``keep_first=False`` only.
    """
    spark = docs.sparkSession
    often = docs.mapInArrow(minimisers(cut), "least long").groupBy("least").count().filter(
        "count > 1")
    shared = spark.sparkContext.broadcast(bitmap_of(often, "least", MINIMISER_SLOTS))
    runs = materialize(docs.mapInArrow(shared_runs(cut, shared), RUN_DDL))

    first = F.min(F.struct("_id", "_h", "start")).alias("first")
    strings = materialize(runs.groupBy(*NAME).agg(
        F.count(F.lit(1)).alias("times"), first, F.first("size").alias("size")))
    # written for the same reason as ``found`` below
    buckets = materialize(strings.groupBy("least").agg(
        F.count(F.lit(1)).alias("different"), F.sum("size").alias("windows")).filter("different > 1"))
    wanted = strings.join(buckets, "least").select(
        "first._id", "first._h", F.struct(
            F.col("first.start").alias("start"), "size", *NAME,
            (F.col("windows") > bucket_windows).alias("large")).alias("run"))
    wanted = materialize(wanted.groupBy("_id", "_h").agg(F.collect_list("run").alias("runs")))
    holders = spark.sparkContext.broadcast(bitmap_of(wanted, "_h", DOCUMENT_SLOTS))
    texts = docs.mapInArrow(rows_held(holders, "_h"), docs.schema)
    sent = materialize(texts.join(wanted, ["_id", "_h"]).mapInArrow(
        fetch(content, window_hashes, recut), SENT_DDL))

    packed = sent.filter("content is not null and core is null").drop("place", "windows", *PART)
    resolved_strings = packed.repartition("least").sortWithinPartitions(
        "least", "s1", "s2").mapInArrow(
        in_buckets(resolve), f"least long, s1 long, s2 long, spans {SPANS_DDL}")
    windows = sent.filter("content is null").drop("content", "windows", "core")
    if windows.take(1):
        resolved_strings = resolved_strings.unionByName(by_window_hash(windows, keep_first))
    parts = sent.filter("core is not null")
    if parts.take(1):
        resolved_strings = resolved_strings.unionByName(
            by_second_cut(parts, window_hashes, resolve, bucket_windows))

    # written, so that both sides of the next join are shuffled for it and a hot string is split
    found = materialize(strings.join(resolved_strings, NAME, "left").filter(
        "times > 1 or spans is not null"))
    marks = runs.join(found.select(*NAME, "times", "first", "spans"), NAME)
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("size").alias("size")))
    is_first = ((F.col("_id") == F.col("first._id")) & (F.col("_h") == F.col("first._h"))
                & (F.col("start") == F.col("first.start")))
    partial = F.coalesce("spans", F.expr(f"cast(array() as {SPANS_DDL})"))
    own = F.when(is_first if keep_first else F.col("times") == 1, partial).otherwise(whole)
    shifted = F.transform(own, lambda s: F.struct(
        (F.col("start") + s["start"]).alias("start"), s["size"].alias("size")))
    spans = marks.select("_id", "_h", shifted.alias("spans")).filter(
        F.size("spans") > 0).groupBy("_id", "_h").agg(
        F.flatten(F.collect_list("spans")).alias("spans"))
    return docs.join(spans, ["_id", "_h"], "left")


def minimisers(cut):
    schema = arrow_schema("least long")

    def run(stream):
        for piece in B.text_slices(stream):
            yield B.batch_of(schema, B.longs(cut(piece, hashes=False)[3]))

    return run


def shared_runs(cut, shared):
    schema = arrow_schema(RUN_DDL)

    def run(stream):
        for piece in B.text_slices(stream):
            row, start, size, least, s1, s2 = cut(piece)
            kept = shared.value.holds(least)
            row, start, size = row[kept], start[kept], size[kept]
            at = pa.array(row)
            yield B.batch_of(schema, piece.rows.column(0).take(at), piece.rows.column(1).take(at),
                             start.astype(np.int32), size.astype(np.int32), B.longs(least[kept]),
                             B.longs(s1[kept]), B.longs(s2[kept]))

    return run


def rows_held(holders, column: str):
    """Pass on the rows whose value in ``column`` may be in the bitmap."""
    def run(stream):
        for batch in stream:
            if batch.num_rows:
                values = batch.column(batch.schema.get_field_index(column)).to_numpy()
                yield batch.filter(pa.array(holders.value.holds(values)))

    return run


def wanted_runs(piece: B.Slice, large: bool):
    """Rows and fields of the wanted runs of one slice; large buckets or the others."""
    lists = piece.rows.column(piece.rows.schema.get_field_index("runs"))
    flat = lists.flatten()
    sizes = np.nan_to_num(np.asarray(
        lists.value_lengths().to_numpy(zero_copy_only=False), float)).astype(np.int64)
    row = np.repeat(np.arange(len(lists)), sizes)
    chosen = np.flatnonzero(flat.field("large").to_numpy(zero_copy_only=False).astype(bool) == large)
    flat = flat.take(pa.array(chosen))
    return row[chosen], flat


def fetch(content, window_hashes, recut=None):
    """Packed strings of the wanted runs; of large buckets their parts or the hashes of their windows."""
    schema = arrow_schema(SENT_DDL)

    def columns(piece, row, flat):
        at = pa.array(row)
        return [piece.rows.column(0).take(at), piece.rows.column(1).take(at),
                *[flat.field(n) for n in ("start", "size", *NAME)]]

    def run(stream):
        for piece in B.text_slices(stream):
            row, flat = wanted_runs(piece, large=False)
            if len(row):
                start, size = flat.field("start").to_numpy(), flat.field("size").to_numpy()
                nothing = [pa.nulls(len(row), f.type) for f in list(schema)[-5:]]
                yield B.batch_of(schema, *columns(piece, row, flat),
                                 content(piece, row, start, size), *nothing)
            row, flat = wanted_runs(piece, large=True)
            if len(row) and recut:
                start, size = flat.field("start").to_numpy(), flat.field("size").to_numpy()
                strings = B.Slice(None, *B.binary_values(content(piece, row, start, size)))
                own, place, count, core, w1, w2 = recut(strings)
                yield B.batch_of(schema, *columns(piece, row[own], flat.take(pa.array(own))),
                                 content(strings, own, place, count), place.astype(np.int32),
                                 B.longs(w1), B.longs(w2), count.astype(np.int32), B.longs(core))
            elif len(row):
                start, size = flat.field("start").to_numpy(), flat.field("size").to_numpy()
                each, place = np.repeat(np.arange(len(row)), size), B.ramp(size)
                w1, w2 = window_hashes(piece, row[each], start[each] + place)
                yield B.batch_of(schema, *columns(piece, row[each], flat.take(pa.array(each))),
                                 pa.nulls(len(each), pa.binary()), place.astype(np.int32),
                                 B.longs(w1), B.longs(w2), pa.nulls(len(each), pa.int32()),
                                 pa.nulls(len(each), pa.int64()))

    return run


def in_buckets(resolve, rows: int = BUCKET_ROWS):
    schema = pa.schema([("least", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()),
                        ("spans", SPANS)])

    def run(stream):
        for table in B.sorted_groups(stream, ["least"], rows):
            flags, owner, place = resolve(table)
            own, start, size = marked_spans(flags, owner, place)
            hit = np.unique(own)
            spans = span_lists(np.searchsorted(hit, own), start, size, len(hit))
            names = [table.column(n).combine_chunks().take(pa.array(hit)) for n in NAME]
            names = [pa.concat_arrays(n.chunks) if isinstance(n, pa.ChunkedArray) else n
                     for n in names]
            yield pa.RecordBatch.from_arrays([*names, spans.cast(SPANS)], schema=schema)

    return run


def by_window_hash(spread: DataFrame, keep_first: bool) -> DataFrame:
    """The repeated windows of large buckets, by a 128-bit hash of each window."""
    place = F.struct("_id", "_h", (F.col("start") + F.col("place")).alias("at"))
    seen = spread.groupBy("w1", "w2").agg(
        F.count(F.lit(1)).alias("times"), F.min(place).alias("lowest")).filter("times > 1")
    hits = spread.join(seen, ["w1", "w2"])
    if keep_first:
        hits = hits.filter(place != F.col("lowest"))
    return hits.groupBy(*NAME).agg(F.collect_list(F.struct(
        F.col("place").alias("start"), F.lit(1).alias("size"))).alias("spans"))


def by_second_cut(parts: DataFrame, window_hashes, resolve, bucket_windows: int) -> DataFrame:
    """The windows of large buckets that occur twice: the plan above again, for parts of runs."""
    strings = materialize(parts.groupBy(*PART).agg(
        F.count(F.lit(1)).alias("times"), F.first("windows").alias("windows"),
        F.first("content").alias("content")))
    buckets = strings.groupBy("core").agg(
        F.count(F.lit(1)).alias("different"),
        ((F.sum("windows") > bucket_windows)
         | (F.sum(F.length("content")) > BUCKET_BYTES)).alias("large")).filter("different > 1")
    several = strings.join(buckets, "core").select(
        F.col("core").alias("least"), F.col("w1").alias("s1"), F.col("w2").alias("s2"),
        "content", "windows", "large")
    found = several.filter("not large").select(*NAME, "content").repartition(
        "least").sortWithinPartitions(*NAME).mapInArrow(
        in_buckets(resolve), f"least long, s1 long, s2 long, spans {SPANS_DDL}")
    hashes = several.filter("large").select(*NAME, "content", "windows").mapInArrow(
        spread(window_hashes), "least long, s1 long, s2 long, place int, w1 long, w2 long")
    nowhere = [F.lit(0).alias(c) for c in ("_id", "_h", "start")]   # only the first one kept needs it
    found = found.unionByName(by_window_hash(hashes.select("*", *nowhere), keep_first=False))
    found = strings.drop("content", "windows").join(
        found.withColumnsRenamed(dict(zip(NAME, PART))), PART, "left").filter(
        "times > 1 or spans is not null")
    marks = parts.select(*NAME, "place", "windows", *PART).join(materialize(found), PART)
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("windows").alias("size")))
    shifted = F.transform(F.when(F.col("times") == 1, F.col("spans")).otherwise(whole),
                          lambda s: F.struct((F.col("place") + s["start"]).alias("start"),
                                             s["size"].alias("size")))
    return marks.select(*NAME, shifted.alias("spans")).groupBy(*NAME).agg(
        F.flatten(F.collect_list("spans")).alias("spans"))


def spread(window_hashes):
    """Every window of packed strings by its hash."""
    schema = arrow_schema("least long, s1 long, s2 long, place int, w1 long, w2 long")

    def run(stream):
        for piece in B.text_slices(stream, "content"):
            size = piece.rows.column(4).to_numpy()
            each, place = np.repeat(np.arange(len(size)), size), B.ramp(size)
            w1, w2 = window_hashes(piece, each, place)
            yield B.batch_of(schema, *[piece.rows.column(i).take(pa.array(each)) for i in range(3)],
                             place.astype(np.int32), B.longs(w1), B.longs(w2))

    return run
