"""Stored random walks that follow a changing graph at the cost of what changes.

``update_walks`` rewrites its whole table. Here the visits of all walks lie in an inverted index, a
table partitioned by a hash of the node, so the visits of the nodes that a change touches are read
without the rest, and every update is a delta:

* ``edges``: added and removed edges, partitioned by a hash of the source;
* ``visits``: ``(node, walk_id, gen, step, next_node, ending)``, partitioned by a hash of the node;
* ``dead``: tombstones ``(walk_id, from_step)``, which end what earlier versions hold of a walk from
  that step on.

A version writes folders of its own and reads older ones only, so an update that is run again, or
whose executors are lost, starts from the same state. ``compact`` folds the versions into a new store.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickweave.operators.hubs import EDGES_PER_SALT, _nodes, _uniform, walk_table
from tickweave.session import materialize

BUCKETS = 64            # partitions of the index; at most so many numbers reach the driver
FILES_PER_BUCKET = 4    # writers that share one bucket, for a hub's bucket
SCHEMAS = {
    "edges": "src string, dst string, is_add boolean, version int, bucket int",
    "visits": "node string, walk_id string, gen int, step int, next_node string, ending string, version int, bucket int",
    "dead": "walk_id string, from_step int, version int",
}


def numbered_edges(edges: DataFrame, edges_per_salt: int = EDGES_PER_SALT) -> DataFrame:
    """``(src, i, dst, degree)`` as ``indexed_adjacency`` numbers them, in one plan."""
    degrees = edges.groupBy("src").agg(F.count(F.lit(1)).alias("degree"))
    salts = F.greatest(F.ceil(F.col("degree") / edges_per_salt), F.lit(1)).cast("int")
    salted = edges.join(degrees, "src").withColumn("salt", F.pmod(F.xxhash64("dst"), salts).cast("int"))
    sizes = salted.groupBy("src", "salt").count()
    before = Window.partitionBy("src").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("src", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy("src", "salt").orderBy("dst")) - 1
    return salted.withColumn("place", place).join(offsets, ["src", "salt"]).select(
        "src", (F.col("place") + F.col("offset")).alias("i"), "dst", "degree")


@dataclass(frozen=True)
class WalkStore:
    """A folder with walks. Draws of version v use the seed ``seed + v`` and generation v."""

    spark: SparkSession
    folder: str
    walks: int = 10
    stop: float = 0.2
    seed: int = 7
    buckets: int = BUCKETS

    # ------------------------------------------------------------------------------ tables
    def bucket(self, node: str | Column) -> Column:
        return F.pmod(F.xxhash64(node), F.lit(self.buckets)).cast("int")

    def read(self, name: str, below: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """Rows of versions below ``below`` in the given buckets; other folders are not opened."""
        rows = self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}")
        if below is not None:
            rows = rows.filter(F.col("version") < below)
        return rows if buckets is None else rows.filter(F.col("bucket").isin(buckets))

    def write(self, name: str, version: int, rows: DataFrame, by: str | None = None, spread: str | None = None) -> None:
        path = f"{self.folder}/{name}/version={version}"
        if by is None:
            rows.write.mode("overwrite").parquet(path)
            return
        rows = rows.withColumn("bucket", self.bucket(by)).repartition(
            "bucket", F.pmod(F.xxhash64(spread), F.lit(FILES_PER_BUCKET)))
        rows.write.mode("overwrite").partitionBy("bucket").parquet(path)

    def buckets_of(self, nodes: DataFrame) -> list[int]:
        found = nodes.select(self.bucket("node").alias("bucket")).distinct().collect()
        return sorted(r["bucket"] for r in found)

    # ------------------------------------------------------------------------------ state
    def edges(self, below: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """Live edges ``(src, dst)``: the newest version decides."""
        return self.read("edges", below, buckets).groupBy("src", "dst").agg(
            F.max_by("is_add", "version").alias("is_add")).filter("is_add").select("src", "dst")

    def visits(self, below: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """Live rows ``(node, walk_id, gen, step, next_node, ending)``."""
        rows = self.read("visits", below, buckets).alias("r")
        dead = self.read("dead", below).alias("d")
        gone = (F.col("r.walk_id") == F.col("d.walk_id")) & (F.col("d.version") > F.col("r.version")) & (
            F.col("r.step") >= F.col("d.from_step"))
        return rows.join(dead, gone, "left_anti").select("node", "walk_id", "gen", "step", "next_node", "ending")

    def visit_counts(self) -> DataFrame:
        return self.visits().groupBy("node").agg(F.count(F.lit(1)).alias("visits"))

    # ------------------------------------------------------------------------------ changes
    def create(self, edges: DataFrame) -> "WalkStore":
        """Version 0: simulate all walks of ``edges(src, dst)``."""
        edges = materialize(edges.select("src", "dst").distinct())
        rows = materialize(walk_table(edges, self.walks, self.stop, self.seed))
        following = rows.select("walk_id", (F.col("step") - 1).alias("step"), F.col("node").alias("next_node"))
        self.write("edges", 0, edges.withColumn("is_add", F.lit(True)), "src", "dst")
        self.write("visits", 0, rows.join(following, ["walk_id", "step"], "left").select(
            "node", "walk_id", "gen", "step", "next_node", "ending"), "node", "walk_id")
        self.write("dead", 0, self.spark.createDataFrame([], "walk_id string, from_step int"))
        return self

    def compact(self, folder: str, version: int | None = None) -> "WalkStore":
        """The live state as version 0 of a new store, without deltas and tombstones.

        The seed moves on by ``version``, the newest version of this store, so draws do not repeat.
        """
        newest = self.read("edges").agg(F.max("version")).first()[0] if version is None else version
        other = replace(self, folder=folder, seed=self.seed + (newest or 0))
        other.write("edges", 0, self.edges().withColumn("is_add", F.lit(True)), "src", "dst")
        other.write("visits", 0, self.visits(), "node", "walk_id")
        other.write("dead", 0, self.spark.createDataFrame([], "walk_id string, from_step int"))
        return other

    def update(self, changes: DataFrame, version: int) -> None:
        """Apply ``changes(src, dst, is_add)`` as ``version``; numbers rise from 1.

        The rules are those of ``update_walks``. Read are the buckets of the nodes in ``changes`` and
        of the nodes that walks pass anew; written are the changed edges, the tombstones of cut walks
        and the steps walked anew.
        """
        seed = self.seed + version
        wanted = materialize(changes.select("src", "dst", "is_add").distinct())
        nodes = materialize(_nodes(wanted))
        buckets = self.buckets_of(nodes)
        sources = nodes.withColumnRenamed("node", "src")
        before = materialize(self.edges(version, buckets).join(sources, "src", "left_semi"))
        adds = wanted.filter("is_add").select("src", "dst")
        drops = wanted.filter("NOT is_add").select("src", "dst").distinct()
        added = adds.distinct().join(before, ["src", "dst"], "left_anti")
        # an edge that is added and removed at once is as if it had not been there
        removed = materialize(drops.join(before, ["src", "dst"], "left_semi"))
        added = materialize(added.join(removed, ["src", "dst"], "left_anti"))
        after = materialize(before.unionByName(added).join(removed, ["src", "dst"], "left_anti"))
        self.write("edges", version, added.withColumn("is_add", F.lit(True)).unionByName(
            removed.withColumn("is_add", F.lit(False))), "src", "dst")

        gained = added.groupBy("src").agg(F.count(F.lit(1)).alias("gained"))
        lost = removed.select("src").distinct()
        degree = after.groupBy("src").agg(F.count(F.lit(1)).alias("degree"))
        touched = materialize(gained.join(lost, "src", "full").join(degree, "src", "left").select(
            F.col("src").alias("node"), F.coalesce("gained", F.lit(0)).alias("gained"),
            F.coalesce("degree", F.lit(0)).alias("new_degree")))

        stored = materialize(self.visits(version, buckets).join(nodes, "node", "left_semi"))
        broken = removed.select(F.col("src").alias("node"), F.col("dst").alias("next_node"), F.lit(True).alias("broken"))
        met = stored.join(touched, "node").join(broken, ["node", "next_node"], "left")
        through_new = _uniform(seed, F.lit("reroute"), "walk_id", "gen", "step") * F.col("new_degree") < F.col("gained")
        reason = (
            F.when(F.col("broken"), F.lit("redraw"))
            .when(F.col("next_node").isNotNull() & through_new, F.lit("reroute"))
            .when((F.col("ending") == "dangling") & (F.col("gained") > 0), F.lit("reroute")))
        row = F.struct("step", "node", "gen", "reason", "gained", "new_degree")
        heads = materialize(met.withColumn("reason", reason).filter("reason IS NOT NULL").groupBy("walk_id").agg(
            F.min_by(row, "step").alias("at")).select("walk_id", "at.*"))
        self.write("dead", version, heads.select("walk_id", F.col("step").alias("from_step")))

        number = _uniform(seed, F.lit("edge"), "walk_id", F.lit(version), "step")
        every, new = (numbered_edges(e).select(F.col("src").alias("node"), "i", F.col("dst").alias("to"))
                      for e in (after, added))
        redrawn = heads.filter("reason = 'redraw'").withColumn(
            "i", F.floor(number * F.col("new_degree"))).join(every, ["node", "i"], "left")
        rerouted = heads.filter("reason = 'reroute'").withColumn(
            "i", F.floor(number * F.col("gained"))).join(new, ["node", "i"], "left")
        turned = materialize(redrawn.unionByName(rerouted).select(
            "node", "walk_id", "gen", "step", F.col("to").alias("next_node"),
            F.when(F.col("to").isNull(), F.lit("dangling")).alias("ending")))

        started = stored.filter("step = 0").select("node").distinct()
        fresh = _nodes(added).join(started, "node", "left_anti").select(
            "node", F.explode(F.sequence(F.lit(0), F.lit(self.walks - 1))).alias("_r")).select(
            F.concat_ws("#", "node", "_r").alias("walk_id"), F.lit(0).alias("gen"), F.lit(0).alias("step"), "node")
        frontier = turned.filter("next_node IS NOT NULL").select(
            "walk_id", F.lit(version).alias("gen"), (F.col("step") + 1).alias("step"),
            F.col("next_node").alias("node")).unionByName(fresh)
        walked = self.walk_on(materialize(frontier), version, seed)
        self.write("visits", version, turned.unionByName(walked) if walked else turned, "node", "walk_id")

    def walk_on(self, frontier: DataFrame, version: int, seed: int) -> DataFrame | None:
        """All steps from ``frontier(walk_id, gen, step, node)`` until every walk has ended.

        Each step reads the edges of the nodes that walks stand on, in their buckets only.
        """
        rows = None
        key = ["walk_id", "gen"]
        while buckets := self.buckets_of(frontier):
            nodes = frontier.select(F.col("node").alias("src")).distinct()
            known = numbered_edges(self.edges(version + 1, buckets).join(nodes, "src", "left_semi"))
            degrees = known.select(F.col("src").alias("node"), "degree").distinct()
            stopped = _uniform(seed, F.lit("stop"), *key, "step") < self.stop
            pick = F.floor(_uniform(seed, F.lit("edge"), *key, "step") * F.col("degree"))
            judged = frontier.join(degrees, "node", "left").withColumn(
                "ending", F.when(stopped, F.lit("stopped")).when(F.col("degree").isNull(), F.lit("dangling"))).withColumn(
                "i", F.when(F.col("ending").isNull(), F.least(pick, F.col("degree") - 1)).otherwise(
                    -1 - F.pmod(F.xxhash64("walk_id"), F.lit(1024))))
            hops = known.select(F.col("src").alias("node"), "i", F.col("dst").alias("next_node"))
            taken = materialize(judged.join(hops, ["node", "i"], "left").select(
                "node", "walk_id", "gen", "step", "next_node", "ending"))
            rows = taken if rows is None else rows.unionByName(taken)
            frontier = taken.filter("next_node IS NOT NULL").select(
                *key, (F.col("step") + 1).alias("step"), F.col("next_node").alias("node"))
        return rows
