"""Paths over the history of a graph.

The lifespan of a path is the intersection of its edges' validity with the query's [start, end);
the path exists when that is not empty. SHORTEST: fewest hops, then earliest lifespan start, then
lexicographic. EARLIEST: earliest start, then fewest hops, then lexicographic. CONTINUOUS: alive
over all of [start, end), then as SHORTEST. REACHABILITY reports SHORTEST's path.

Two passes. The first spreads lifespans only, never paths: a row at a node is dropped when
another one got there in no more hops with a lifespan around it. That yields the instant at which
the wanted path starts to exist. At a fixed instant (or over all of [start, end)) the graph is
static, and the second pass keeps the smallest path per query and node while it walks it.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickweave.functions.cells import from_micros, micros
from tickweave.operators.graph import symmetrize
from tickweave.operators.hubs import every_salt, salted_adjacency
from tickweave.session import materialize


def _expand(front: DataFrame, adjacency: DataFrame) -> DataFrame:
    """Join rows at ``node`` with its edges, salt by salt."""
    spread = front.withColumn("salt", every_salt())
    return spread.drop("salts").join(adjacency.withColumnRenamed("src", "node"), ["node", "salt"])


def _undominated(rows: DataFrame) -> DataFrame:
    """Per query and node, drop lifespans inside one reached in no more hops."""
    best = rows.groupBy("query_id", "node", "lo", "hi").agg(
        F.min("hops").alias("hops"), F.max("salts").alias("salts"))
    # rows before a row in this order start no later; the widest of them decides
    order = Window.partitionBy("query_id", "node").orderBy("lo", F.desc("hi"))
    ahead = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return best.withColumn("_ahead", ahead).filter("_ahead IS NULL OR _ahead < hi").drop("_ahead")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def _hops(max_hops: int | None):
    return count(1) if max_hops is None else range(1, max_hops + 1)


def _first_instants(asked: DataFrame, adjacency: DataFrame, max_hops: int | None) -> DataFrame:
    """``(query_id, at)``: when the wanted path starts to exist.

    A query leaves the front when more hops cannot better its answer: at its first hit, or for
    EARLIEST as far as its lifespans start no earlier than the best hit. The loop ends when the
    front is empty; dominated lifespans are dropped, so it does on any graph.
    """
    reached = asked.select(
        "query_id", "node", "salts", F.col("lo0").alias("lo"), F.col("hi0").alias("hi"), F.lit(0).alias("hops"))
    front = reached
    goals = asked.select("query_id", "target", "type")
    hits: list[DataFrame] = []
    for hop in _hops(max_hops):
        stepped = _expand(front.drop("hops"), adjacency).select(
            "query_id", F.col("dst").alias("node"), F.col("dst_salts").alias("salts"),
            F.greatest("lo", "from_us").alias("lo"), F.least("hi", "to_us").alias("hi"),
            F.lit(hop).alias("hops"),
        ).filter("lo < hi")
        reached = materialize(_undominated(reached.unionByName(stepped)))
        fresh = reached.filter(F.col("hops") == hop)
        hits.append(materialize(fresh.join(goals, "query_id").filter("node = target").select(
            "query_id", "type", "hops", "lo")))
        settled = _union(hits).groupBy("query_id", "type").agg(F.min("lo").alias("_best"))
        front = fresh.join(settled, "query_id", "left").filter(
            "_best IS NULL OR (type = 'EARLIEST' AND lo < _best)").select(*reached.columns)
        if front.isEmpty():
            break
    rank = F.when(F.col("type") == "EARLIEST", F.struct(F.col("lo").alias("a"), F.col("hops").cast("bigint").alias("b"))) \
        .otherwise(F.struct(F.col("hops").cast("bigint").alias("a"), F.col("lo").alias("b")))
    return _union(hits).groupBy("query_id").agg(F.min_by("lo", rank).alias("at"))


def _smallest_paths(asked: DataFrame, adjacency: DataFrame, max_hops: int | None) -> DataFrame:
    """Fewest-hop, then smallest path per query among edges alive over ``[need_lo, need_hi)``."""
    front = asked.select(
        "query_id", "node", "salts", "need_lo", "need_hi", F.col("lo0").alias("lo"),
        F.col("hi0").alias("hi"), F.array("node").alias("path"))
    visited = front.select("query_id", "node")
    goals = asked.select("query_id", "target")
    hits: list[DataFrame] = []
    for _ in _hops(max_hops):
        stepped = (
            _expand(front, adjacency)
            .filter("from_us <= need_lo AND to_us >= need_hi")
            .select(
                "query_id", F.col("dst").alias("node"), F.col("dst_salts").alias("salts"),
                "need_lo", "need_hi", F.greatest("lo", "from_us").alias("lo"),
                F.least("hi", "to_us").alias("hi"),
                F.concat("path", F.array("dst")).alias("path"))
        )
        smallest = stepped.groupBy("query_id", "node").agg(
            F.min(F.struct("path", "lo", "hi", "need_lo", "need_hi", "salts")).alias("s")
        ).select("query_id", "node", "s.*")
        fresh = materialize(smallest.join(visited, ["query_id", "node"], "left_anti"))
        visited = materialize(visited.unionByName(fresh.select("query_id", "node")))
        hits.append(materialize(fresh.join(goals, "query_id").filter("node = target").select(
            "query_id", "path", "lo", "hi")))
        front = fresh.join(hits[-1].select("query_id"), "query_id", "left_anti")
        if front.isEmpty():
            break
    return _union(hits)


def paths(edge_intervals: DataFrame, queries: DataFrame, max_hops: int | None = None, **salting) -> DataFrame:
    """Answer path queries ``(query_id, start_ts, end_ts, source, target, type)`` in one job.

    Returns ``(query_id, path_found, path, start_ts, end_ts)``; a query without an answer keeps a
    row with ``path_found = 0``. ``start_ts = end_ts`` asks for an instant. Paths have any length
    unless ``max_hops`` is given.
    """
    directed = symmetrize(edge_intervals).filter("src != dst")
    adjacency, nodes = salted_adjacency(directed, **salting)
    far = F.lit((1 << 63) - 1)
    adjacency = materialize(adjacency.select(
        "src", "salt", "dst", "dst_salts", micros("valid_from").alias("from_us"),
        F.coalesce(micros("valid_to"), far).alias("to_us")))
    lo, hi = micros("start_ts"), micros("end_ts")
    asked = materialize(
        queries.select(
            "query_id", "type", "target", F.col("source").alias("node"), lo.alias("lo0"),
            F.when(lo == hi, hi + 1).otherwise(hi).alias("hi0"))
        .filter("lo0 < hi0 AND node != target")
        .join(nodes.select("node", "salts"), "node"))

    timed = asked.filter("type != 'CONTINUOUS'")
    instants = _first_instants(timed, adjacency, max_hops)
    at_instant = timed.join(instants, "query_id").withColumns(
        {"need_lo": F.col("at"), "need_hi": F.col("at") + 1}).drop("at")
    whole = asked.filter("type = 'CONTINUOUS'").withColumns(
        {"need_lo": F.col("lo0"), "need_hi": F.col("hi0")})
    found = _smallest_paths(materialize(at_instant.unionByName(whole)), adjacency, max_hops)
    instant = F.col("start_ts") == F.col("end_ts")
    return queries.join(found, "query_id", "left").select(
        "query_id",
        F.col("path").isNotNull().cast("int").alias("path_found"),
        "path",
        from_micros("lo").alias("from_ts"),
        F.when(instant & F.col("path").isNotNull(), from_micros("lo")).otherwise(from_micros("hi")).alias("to_ts"),
    ).withColumnsRenamed({"from_ts": "start_ts", "to_ts": "end_ts"})
