"""Approximate nearest neighbours on shifted space-filling curves.

Each of several curves projects the vectors on a few random directions, shifts them and orders them
by their place on a Hilbert curve. The orderings are range-partitioned and sorted by Spark; ranks
are cut into blocks. A query looks at the blocks of a window around its own rank on every curve, and
the candidates of all curves are merged and ranked by their exact distance.

How wide a window has to be is measured, not assumed: for a bounded sample of queries the true
neighbours are found by brute force over all vectors, and the window is the smallest in which the
curves together hold the wanted share of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickweave.llm import batches as B
from tickweave.llm.frames import arrow_schema, materialize, quoted, ship_code

CURVES = 16
DIRECTIONS = 12
BITS = 5                 # per direction; DIRECTIONS * BITS must fit in a long
BLOCK = 2048             # ranks
FIT_SAMPLE = 4096        # vectors that set the range of each direction
RECALL_SAMPLE = 96       # queries whose true neighbours set the window
TARGET_RECALL = 0.96     # of them inside the window of some curve
NEIGHBOURS = 10


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of integer coordinates (below 2**bits) on a Hilbert curve.

    Skilling's transform, on whole columns at once.
    """
    x = np.ascontiguousarray(cells.T).astype(np.int64)
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for i in range(len(x)):
            inverted = (x[i] & bit) != 0
            swap = np.where(inverted, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(inverted, low, swap)
            x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip = np.where((x[-1] >> level) & 1 == 1, flip ^ ((1 << level) - 1), flip)
    x ^= flip
    key = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(len(x)):
            key = (key << 1) | ((x[i] >> level) & 1)
    return key


class Curve:
    """Random directions, their range in a sample, and a random shift."""

    def __init__(self, sample: np.ndarray, number: int, directions: int, bits: int):
        rng = np.random.default_rng(1000 + number)
        dims = sample.shape[1]
        directions = min(directions, dims)
        self.bits = bits
        self.axes = np.linalg.qr(rng.normal(size=(dims, directions)))[0]
        seen = sample @ self.axes
        low, high = np.quantile(seen, [0.001, 0.999], axis=0)
        width = np.where(high > low, high - low, 1.0)
        self.scale = (1 << bits) / (1.5 * width)
        self.base = low - rng.random(directions) * 0.5 * width

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        cells = np.floor((vectors @ self.axes - self.base) * self.scale)
        return hilbert_keys(np.clip(cells, 0, (1 << self.bits) - 1).astype(np.int64), self.bits)


def matrix(column) -> np.ndarray:
    """Rows of a list column of equal lengths."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(array, pa.ChunkedArray):
        array = pa.concat_arrays(array.chunks)
    flat = array.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(array), -1) if len(array) else flat.reshape(0, 0)


def nearest(queries: np.ndarray, vectors: np.ndarray, low: np.ndarray, count: int):
    """Query index, vector index and distance of the ``count`` nearest, ties to smaller ``low``.

    A matrix product picks a few more than needed; those are measured again by their differences.
    """
    rough = ((queries ** 2).sum(1)[:, None] + (vectors ** 2).sum(1)[None]
             - 2 * queries @ vectors.T)
    wide = min(len(vectors), count + 8)
    # everything as near as the last one picked, up to rounding, is measured
    limit = np.partition(rough, wide - 1, axis=1)[:, wide - 1]
    slack = 1e-9 * ((queries ** 2).sum(1) + (vectors ** 2).sum(1).max())
    q, v = np.nonzero(rough <= (limit + slack)[:, None])
    exact = np.sqrt(((queries[q] - vectors[v]) ** 2).sum(1))
    order = np.lexsort((low[v], exact, q))
    q, v, exact = q[order], v[order], exact[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    kept = place < count
    return q[kept], v[kept], exact[kept]


def distinct_vectors(embeddings: DataFrame, id_col: str, vec_col: str, keep: int):
    """One row per distinct valid vector: ``cls, vec, members`` (its ``keep`` smallest ids), and
    the valid rows ``vec_id, cls``."""
    vec = F.transform(quoted(vec_col), lambda x: x.cast("double") + F.lit(0.0))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.select(quoted(id_col).cast("long").alias("vec_id"), vec.alias("vec")).filter(
        F.col("vec_id").isNotNull() & F.col("vec").isNotNull()).filter(
        finite & F.exists("vec", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vec").alias("size")).count().orderBy(
        F.desc("count"), "size").limit(1).collect()
    if not sizes:
        return None, None
    rows = rows.filter(F.size("vec") == sizes[0]["size"]).withColumn(
        "cls", F.xxhash64("vec")).withColumn("cls2", F.xxhash64(F.lit(7), "vec"))
    ids = rows.select("vec_id", "cls", "cls2").distinct()
    place = F.row_number().over(Window.partitionBy("cls", "cls2").orderBy("vec_id"))
    members = ids.withColumn("place", place).filter(F.col("place") <= keep).groupBy(
        "cls", "cls2").agg(F.array_sort(F.collect_list("vec_id")).alias("members"))
    # the vector itself comes from the smallest id
    vectors = rows.groupBy("cls", "cls2").agg(F.min_by("vec", "vec_id").alias("vec"))
    classes = vectors.join(members, ["cls", "cls2"]).select(
        F.xxhash64("cls", "cls2").alias("cls"), "members", "vec")
    return materialize(classes), ids.select("vec_id", F.xxhash64("cls", "cls2").alias("cls"))


def ranked(classes: DataFrame, curves: list[Curve]) -> DataFrame:
    """``curve, rank, cls, low, vec``: every vector's rank on every curve."""
    keyed_ddl = "curve int, key long, cls long, low long, vec array<double>"
    keyed_schema = pa.schema([("curve", pa.int32()), ("key", pa.int64()), ("cls", pa.int64()),
                              ("low", pa.int64()), ("vec", pa.list_(pa.float64()))])

    def place(stream):
        for batch in stream:
            if not batch.num_rows:
                continue
            vectors = matrix(batch.column(2))
            for number, curve in enumerate(curves):
                yield B.batch_of(keyed_schema, np.full(len(vectors), number), curve.keys(vectors),
                                 *batch.columns)

    part_schema = pa.schema([("part", pa.int32()), ("at", pa.int64()), ("curve", pa.int32()),
                             ("cls", pa.int64()), ("low", pa.int64()),
                             ("vec", pa.list_(pa.float64()))])

    def count(stream):
        part, seen = TaskContext.get().partitionId(), 0
        for batch in stream:
            at = np.arange(seen, seen + batch.num_rows)
            seen += batch.num_rows
            yield B.batch_of(part_schema, np.full(len(at), part), at, batch.column(0),
                             *batch.columns[2:])

    keyed = classes.select("cls", F.col("members")[0].alias("low"), "vec").mapInArrow(
        place, keyed_ddl)
    order = ["curve", "key", "cls"]
    parted = materialize(keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        count, "part int, at long, curve int, cls long, low long, vec array<double>"))
    # a few rows per partition turn places in partitions into ranks
    starts = parted.groupBy("curve", "part").agg(
        F.count(F.lit(1)).alias("rows"), F.min("at").alias("begin"))
    before = F.sum("rows").over(Window.partitionBy("curve").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1))
    starts = starts.select("curve", "part", (F.coalesce(before, F.lit(0)) - F.col("begin")).alias("base"))
    return parted.join(starts, ["curve", "part"]).select(
        "curve", (F.col("at") + F.col("base")).alias("rank"), "cls", "low", "vec")


def true_neighbours(classes: DataFrame, queries: list, count: int) -> list:
    """Brute force over all vectors for a bounded list of query vectors: ``cls, other`` rows."""
    names = np.array([r["cls"] for r in queries])
    points = np.array([r["vec"] for r in queries], np.float64)
    schema = arrow_schema("cls long, other long, low long, score double")

    def run(stream):
        for batch in stream:
            if batch.num_rows:
                vectors, low = matrix(batch.column(2)), batch.column(1).to_numpy()
                q, v, score = nearest(points, vectors, low, count)
                yield B.batch_of(schema, names[q], batch.column(0).to_numpy()[v], low[v], score)

    found = classes.select("cls", F.col("members")[0].alias("low"), "vec").mapInArrow(
        run, "cls long, other long, low long, score double")
    place = F.row_number().over(Window.partitionBy("cls").orderBy("score", "low"))
    return found.filter("cls <> other").withColumn("place", place).filter(
        F.col("place") < count).select("cls", "other").collect()


def window_for(ranks: DataFrame, pairs: list, recall: float) -> int:
    """Smallest window (ranks to each side) that holds ``recall`` of the pairs on some curve."""
    if not pairs:
        return 1
    names = sorted({x for r in pairs for x in (r["cls"], r["other"])})  # bounded by the sample
    rows = ranks.filter(F.col("cls").isin(names)).select("curve", "cls", "rank").collect()
    spot = {(r["curve"], r["cls"]): r["rank"] for r in rows}
    numbers = sorted({r["curve"] for r in rows})
    gaps = sorted(min(abs(spot[c, r["cls"]] - spot[c, r["other"]]) for c in numbers) for r in pairs)
    return int(gaps[min(len(gaps) - 1, int(np.ceil(recall * len(gaps))) - 1)]) + 1


def search_blocks(count: int):
    schema = arrow_schema("query long, cls long, low long, score double")

    def run(stream):
        for table in B.sorted_groups(stream, ["curve", "block"], BLOCK):
            starts = B.group_starts(table, ["curve", "block"])
            asks = table.column("asks").to_numpy()
            name, low = table.column("cls").to_numpy(), table.column("low").to_numpy()
            vectors = matrix(table.column("vec"))
            for begin, end in zip(starts, np.append(starts[1:], table.num_rows)):
                rows = np.arange(begin, end)
                ask, held = rows[asks[begin:end] == 1], rows[asks[begin:end] == 0]
                if not len(ask) or not len(held):
                    continue
                q, v, score = nearest(vectors[ask], vectors[held], low[held], count)
                yield B.batch_of(schema, name[ask[q]], name[held[v]], low[held[v]], score)

    return run


def nearest_neighbours(embeddings: DataFrame, queries: DataFrame, id_col: str = "vec_id",
                       vec_col: str = "embedding", count: int = NEIGHBOURS,
                       curves: int = CURVES, block: int = BLOCK,
                       recall: float = TARGET_RECALL) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``count`` nearest rows found for each query id.

    ``queries`` has the column ``query_id``; their vectors are those of ``embeddings``. Rows with
    the query's own id are no candidates. Vectors that are null, zero, of another than the most
    common length or hold null or non-finite components take no part, nor do rows without id.
    Equal vectors are searched once and expanded to ids after it, so ties go to the smaller id
    however many copies there are. Fewer rows come back where there are fewer candidates.
    """
    spark = embeddings.sparkSession
    ship_code(spark)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    keep = count + 1
    classes, ids = distinct_vectors(embeddings, id_col, vec_col, keep)
    if classes is None:
        return empty
    asked = ids.join(queries.select("query_id").distinct(),
                     F.col("vec_id") == F.col("query_id"), "left_semi")
    asked = materialize(asked.withColumnRenamed("vec_id", "query_id"))
    chosen = asked.select("cls").distinct()

    # bounded by the two sample sizes
    sample = classes.select("cls", "vec").orderBy("cls").limit(FIT_SAMPLE).collect()
    points = np.array([r["vec"] for r in sample], np.float64)
    ranks = ranked(classes, [Curve(points, i, DIRECTIONS, BITS) for i in range(curves)])
    trial = classes.select("cls", "vec").join(chosen, "cls", "left_semi").orderBy(
        F.xxhash64("cls")).limit(RECALL_SAMPLE).collect()
    if not trial:
        return empty
    window = window_for(ranks, true_neighbours(classes, trial, keep), recall)

    number = F.floor(F.col("rank") / block).cast("long")
    held = ranks.select("curve", number.alias("block"), F.lit(0).alias("asks"), "cls", "low", "vec")
    spans = F.sequence(F.floor(F.greatest(F.lit(0), F.col("rank") - window) / block).cast("long"),
                       F.floor((F.col("rank") + window) / block).cast("long"))
    asks = ranks.join(chosen, "cls", "left_semi").select(
        "curve", F.explode(spans).alias("block"), F.lit(1).alias("asks"), "cls", "low", "vec")
    found = held.unionByName(asks).repartition("curve", "block").sortWithinPartitions(
        "curve", "block").mapInArrow(
        search_blocks(keep), "query long, cls long, low long, score double")
    best = found.groupBy("query", "cls", "low").agg(F.min("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query").orderBy("score", "low"))
    best = best.withColumn("place", place).filter(F.col("place") <= keep)
    pairs = best.join(classes.select("cls", "members"), "cls").select(
        F.col("query").alias("cls"), "score", F.explode("members").alias("vec_id"))
    rows = asked.join(pairs, "cls").filter("vec_id <> query_id")
    final = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return rows.withColumn("rank", final).filter(F.col("rank") <= count).select(
        "query_id", "rank", "vec_id", "score")
