"""The graph at an instant and over a period."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.functions.cells import MAX_CELLS, Cells, micros
from tickweave.functions.ordered import explode_range
from tickweave.functions.sizing import BROADCAST_ROWS
from tickweave.functions.text import format_instant
from tickweave.session import materialize

POINTS_PER_CELL = 1
EDGES_PER_PART = 100_000


def points_in_spans(
    points: DataFrame, at: Column, spans: DataFrame, low: Column, high: Column
) -> DataFrame:
    """Join points to the half-open spans ``[low, high)`` that hold them (null high = open).

    Cells are cut at the quantiles of the points, so each holds about the same number of them (one
    instant, while there are no more instants than cells); a span goes to the cells it reaches and
    meets the points there by an equi-join. Few points are broadcast, after the count that fitted
    the cells.
    """
    cells = Cells.fit(points, at, rows_per_cell=POINTS_PER_CELL)
    if cells.single:
        first = points.agg(F.min(at).alias("at")).first()["at"]
        cells = Cells((first or 0,), cells.rows)
    placed = points.withColumns({"_at": at, "_cell": cells.of(at).cast("bigint")})
    if cells.rows <= BROADCAST_ROWS:
        placed = F.broadcast(placed)
    reached = explode_range(
        spans.withColumns({"_low": low, "_high": high}),
        cells.of(F.col("_low")).cast("bigint"),
        F.when(F.col("_high").isNull(), F.lit(cells.count - 1))
        .otherwise(cells.of(F.col("_high") - 1)).cast("bigint"),
        "_cell")
    return (
        reached.join(placed, "_cell")
        .filter("_low <= _at AND (_high IS NULL OR _at < _high)")
        .drop("_cell", "_low", "_high", "_at")
    )


def snapshot_at(edge_intervals: DataFrame, queries: DataFrame, at: str = "start_ts") -> DataFrame:
    """Edges alive at each query's instant: ``(query columns, v0, v1)``.

    A query whose graph is empty has one row with null ids; so has one without an instant. Other
    columns of a query may be null.
    """
    asked = list(queries.columns)
    alive = materialize(points_in_spans(
        queries, micros(at), edge_intervals, micros("valid_from"), micros("valid_to")
    ).select(*asked, "v0", "v1"))
    nothing = [F.lit(None).cast(alive.schema[v].dataType).alias(v) for v in ("v0", "v1")]
    answered = alive.select(*asked).distinct().alias("a")
    same = reduce(and_, [F.col(f"q.`{c}`").eqNullSafe(F.col(f"a.`{c}`")) for c in asked])
    empty = queries.alias("q").join(answered, same, "left_anti")
    return alive.unionByName(empty.select(*asked, *nothing))


def snapshots_between(edge_intervals: DataFrame, queries: DataFrame) -> DataFrame:
    """All distinct graph states within ``[start_ts, end_ts)``: ``(query_id, ts, v0, v1)``.

    A state starts at the query's start and at every change inside it. A state without edges has
    one row with null ids.
    """
    changes = edge_intervals.select(
        F.explode(F.array("valid_from", "valid_to")).alias("ts")).filter("ts IS NOT NULL").distinct()
    within = points_in_spans(
        changes, micros("ts"), queries.select("query_id", "start_ts", "end_ts"),
        micros("start_ts"), micros("end_ts")).select("query_id", "ts")
    states = materialize(within.unionByName(
        queries.select("query_id", F.col("start_ts").alias("ts"))).distinct())
    return snapshot_at(edge_intervals, states, "ts").select("query_id", "ts", "v0", "v1")


def snapshot_json(
    snapshots: DataFrame, keys: list[str], at: str, edges_per_part: int = EDGES_PER_PART
) -> DataFrame:
    """One ``snapshots:[{...}]`` text per state, in parts when it has many edges.

    Every line says which part of how many it is, so a reader can join them. A state of up to
    ``edges_per_part`` edges is one part; larger ones are split by a hash of the edge, so no row has
    to hold a whole large graph. The parts of a state list disjoint edges.
    """
    group = [*keys, at]
    sizes = snapshots.groupBy(*group).agg(F.count("v0").alias("_n")).withColumn(
        "parts", F.greatest(F.ceil(F.col("_n") / edges_per_part), F.lit(1)))
    parted = snapshots.join(sizes, group).withColumn(
        "part", F.pmod(F.xxhash64("v0", "v1"), F.col("parts")))
    edge = F.when(F.col("v0").isNotNull(), F.struct("v0", "v1"))
    return parted.groupBy(*group, "parts", "part").agg(
        F.array_sort(F.collect_list(edge)).alias("edges")).select(
        *group, "part", "parts",
        F.concat(
            F.lit("snapshots:["),
            F.to_json(F.struct(format_instant(F.col(at)).alias("time"), F.col("edges"))),
            F.lit("]")).alias("snapshot"))
