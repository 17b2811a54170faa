"""Edge changes, edge lifetimes and vertices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.functions.cells import Cells, micros
from tickweave.functions.ordered import following, previous
from tickweave.session import materialize


def canonical_edge(a: str | Column, b: str | Column) -> tuple[Column, Column]:
    """The lexicographically smaller id first."""
    return F.least(a, b), F.greatest(a, b)


def edge_changes(
    results: DataFrame,
    threshold: float | str = 0.7,
    time: str = "window_end",
    cells: Cells | None = None,
) -> DataFrame:
    """Pairwise results -> ``(v0, v1, ts, is_add)`` events when abs(value) crosses the threshold.

    ``threshold`` is a number or the name of a column (see ``with_parameter``). A pair without a
    result keeps its state. Several results of a pair at one time (both directions of a directed
    measure) count in the order of ``seq`` when there is one, else as one: above if any is.
    """
    limit = F.col(threshold) if isinstance(threshold, str) else F.lit(threshold)
    v0, v1 = canonical_edge("id0", "id1")
    order = ["ts", "seq"] if "seq" in results.columns else ["ts"]
    flags = results.filter(F.col("value").isNotNull()).select(
        v0.alias("v0"), v1.alias("v1"), F.col(time).alias("ts"), *order[1:],
        (F.abs("value") >= limit).alias("is_add"))
    flags = flags.groupBy("v0", "v1", *order).agg(F.bool_or("is_add").alias("is_add"))
    flags = materialize(flags)  # the results behind it are computed once, not per consumer
    position = micros("ts")
    cells = cells or Cells.fit(flags, position)
    marked = previous(flags, ["v0", "v1"], order, ["is_add"], position, cells)
    return marked.filter(
        F.col("is_add") != F.coalesce(F.col("prev.is_add"), F.lit(False))
    ).select("v0", "v1", "ts", "is_add")


def edge_intervals(events: DataFrame, cells: Cells | None = None) -> DataFrame:
    """Add/delete events -> ``(v0, v1, valid_from, valid_to)``; open edges have a null end.

    Repeated adds and deletes change nothing. ``seq`` breaks ties in time when present; without it
    an edge that is both added and deleted at one time is deleted.
    """
    order = ["ts", "seq"] if "seq" in events.columns else ["ts"]
    edge = ["v0", "v1"]
    events = materialize(events.groupBy(*edge, *order).agg(F.bool_and("is_add").alias("is_add")))
    position = micros("ts")
    cells = cells or Cells.fit(events, position)
    marked = previous(events, edge, order, ["is_add"], position, cells)
    turns = marked.filter(
        F.col("is_add") != F.coalesce(F.col("prev.is_add"), F.lit(False))
    ).select(*edge, *order, "is_add")
    spans = following(turns, edge, order, ["ts"], position, cells)
    return (
        spans.filter("is_add")
        .select(*edge, F.col("ts").alias("valid_from"), F.col("next.ts").alias("valid_to"))
        .filter("valid_to IS NULL OR valid_from < valid_to")
    )


def vertex_first_seen(events: DataFrame) -> DataFrame:
    """``(v, first_seen)``: the time of the first edge added at a vertex."""
    return (
        events.filter("is_add")
        .select(F.explode(F.array("v0", "v1")).alias("v"), "ts")
        .groupBy("v").agg(F.min("ts").alias("first_seen"))
    )


def symmetrize(edges: DataFrame) -> DataFrame:
    """Both directions of every undirected edge, in one pass."""
    rest = [c for c in edges.columns if c not in ("v0", "v1")]
    return edges.select(
        F.explode(F.array(
            F.struct(F.col("v0").alias("src"), F.col("v1").alias("dst")),
            F.struct(F.col("v1").alias("src"), F.col("v0").alias("dst")),
        )).alias("_e"), *rest,
    ).select("_e.src", "_e.dst", *rest)
