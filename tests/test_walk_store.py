"""Stored walks against the operator that rewrites them all, and what an update reads and writes."""

import os

from pyspark.sql import functions as F

from tickweave.operators import hubs
from tickweave.operators.walk_store import WalkStore, numbered_edges

CHANGES = "src string, dst string, is_add boolean"


def both_ways(pairs):
    return [(a, b) for a, b in pairs] + [(b, a) for a, b in pairs]


def changed(spark, added=(), removed=()):
    rows = [(a, b, True) for a, b in both_ways(added)] + [(a, b, False) for a, b in both_ways(removed)]
    return spark.createDataFrame(rows, CHANGES)


def ring(spark, count=24):
    pairs = [(f"n{i}", f"n{(i + 1) % count}") for i in range(count)] + [("n0", f"n{i}") for i in range(5, 12)]
    return pairs, spark.createDataFrame(both_ways(pairs), "src string, dst string")


def rows_of(df):
    return sorted(tuple(r) for r in df.select("walk_id", "gen", "step", "node", F.coalesce("ending", F.lit("-"))).collect())


def test_updates_equal_the_full_rewrite(spark, tmp_path):
    pairs, edges = ring(spark)
    store = WalkStore(spark, str(tmp_path / "walks"), walks=4, stop=0.5, buckets=16).create(edges)
    walks = hubs.walk_table(edges, walks=4, stop=0.5)
    assert rows_of(store.visits()) == rows_of(walks)
    steps = [
        ([("n3", "n9"), ("new", "n3")], [("n0", "n7")]),
        ([("n0", "n7")], [("n20", "n21"), ("n21", "n22"), ("new", "n3")]),     # n21 loses all its edges
    ]
    for version, (added, removed) in enumerate(steps, 1):
        change = changed(spark, added, removed)
        walks = hubs.update_walks(walks, edges, change, walks=4, stop=0.5, seed=7 + version, gen=version)
        gone = set(both_ways(removed))
        kept = [tuple(r) for r in edges.collect() if tuple(r) not in gone]
        edges = spark.createDataFrame(sorted(set(kept) | set(both_ways(added))), "src string, dst string")
        store.update(change, version)
        assert rows_of(store.visits()) == rows_of(walks)
        assert sorted(map(tuple, store.edges().collect())) == sorted(map(tuple, edges.collect()))
        if version == 1:
            # a version that runs again, say after a lost driver, gives the same
            store.update(change, version)
            assert rows_of(store.visits()) == rows_of(walks)
    checks = hubs.walk_checks(store.visits(), store.edges()).collect()
    assert all(r["starts"] == 4 and r["duplicates"] == r["dead_hops"] == 0 for r in checks)
    new = store.compact(str(tmp_path / "compact"))
    assert new.seed == 9 and rows_of(new.visits()) == rows_of(walks)
    assert new.read("visits").agg(F.max("version")).first()[0] == 0 and new.read("dead").count() == 0


def test_a_change_reads_and_writes_little(spark, tmp_path):
    _, edges = ring(spark, 120)
    store = WalkStore(spark, str(tmp_path / "walks"), walks=3, stop=0.5, buckets=32).create(edges)
    total = store.read("visits").count()
    store.update(changed(spark, [("n60", "n70")]), 1)
    written = store.read("visits").filter("version = 1")
    cut = store.read("dead").filter("version = 1")
    touched = store.visits(1).filter("node IN ('n60', 'n70')").select("walk_id").distinct().count()
    assert 0 < cut.count() <= touched
    assert written.select("walk_id").distinct().count() == cut.count() < total / 20
    assert written.count() < total / 5
    # the read of the touched nodes opens their buckets only
    nodes = spark.createDataFrame([("n60",), ("n70",)], "node string")
    buckets = store.buckets_of(nodes)
    pruned = store.read("visits", 1, buckets)
    assert {f.split("bucket=")[1].split("/")[0] for f in pruned.inputFiles()} <= {str(b) for b in range(32)}
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    scanned = [f for f in store.read("visits", 1).inputFiles()]
    assert 0 < sum(f"bucket={b}/" in f for f in scanned for b in buckets) < len(scanned) / 4
    sizes = {v: sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(tmp_path / "walks" / "visits" / f"version={v}")
                    for f in files if f.endswith(".parquet")) for v in (0, 1)}
    assert sizes[1] < sizes[0] / 2


def test_numbers_of_edges_are_those_of_the_simulation(spark):
    _, edges = ring(spark)
    for salt in (100_000, 3):
        want = hubs.indexed_adjacency(edges, salt).select("src", "i", "dst").collect()
        assert sorted(want) == sorted(numbered_edges(edges, salt).select("src", "i", "dst").collect())
