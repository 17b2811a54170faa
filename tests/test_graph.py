import math
import random

import pytest

from helpers import at, secs
from tickweave.functions.cells import Cells, micros
from tickweave.operators import change, entropy, graph, hubs, results, snapshots
from tickweave.operators import paths as P

RESULTS = "id0 string, id1 string, window_end timestamp_ntz, value double"
SPANS = "v0 string, v1 string, valid_from timestamp_ntz, valid_to timestamp_ntz"


def spans(spark, rows):
    return spark.createDataFrame([(a, b, at(f), None if t is None else at(t)) for a, b, f, t in rows], SPANS)


def test_transfer_entropy_golden(spark):
    y, x = [0, 1, 1, 0, 1, 0, 0, 1, 0, 1], [0, 0, 1, 1, 0, 1, 0, 0, 1, 0]
    binned = spark.createDataFrame([("x", "y", g, x[g], y[g]) for g in range(10)],
                                   "id0 string, id1 string, g bigint, x int, y int")
    got = {(r["id0"], r["id1"]): r["value"] for r in
           entropy.transfer_entropy_of_bins(binned, 10, 30, 1_000_000).collect()}
    assert got["y", "x"] == pytest.approx(0.899985, abs=1e-6)
    assert got["x", "y"] == pytest.approx(0.149442, abs=1e-6)
    assert entropy.transfer_entropy_of_bins(binned, 11, 30, 1_000_000).count() == 0


def test_change_filter_golden_and_split(spark):
    vs = [0.0, 0.5, 0.504, 0.506, 0.4, 0.4]
    df = spark.createDataFrame([("k", at(i), v) for i, v in enumerate(vs)], "k string, ts timestamp_ntz, value double")
    assert [r["value"] for r in change.emit_on_change(df, ["k"], "ts").orderBy("ts").collect()] == [0.5, 0.506, 0.4]
    rng, walk, rows = random.Random(4), 1.0, []
    for i in range(400):
        walk *= 1 + rng.uniform(-.006, .006)
        rows.append(("hot" if i % 4 else "cold", at(i), walk))
    df = spark.createDataFrame(rows, df.schema)
    whole = change.emit_on_change(df, ["k"], "ts").collect()
    split = change.emit_on_change(df, ["k"], "ts", cells=Cells.fit(df, micros("ts"), 30)).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, split)) and len(whole) > 20


def test_edge_changes_golden(spark):
    vs = [0.2, 0.7, -0.9, 0.69, 0.1, -0.8]
    df = spark.createDataFrame([("b", "a", at(i), v) for i, v in enumerate(vs)], RESULTS)
    for cells in (None, Cells.fit(df, micros("window_end"), 2)):
        got = graph.edge_changes(df, 0.7, cells=cells).orderBy("ts").collect()
        assert [(secs(r["ts"]), r["is_add"]) for r in got] == [(1, True), (3, False), (5, True)]
        assert got[0]["v0"] == "a"


def test_edge_intervals_ignore_repeats(spark):
    rows = [("a", "b", at(t), add) for t, add in
            [(0, False), (1, True), (2, True), (3, False), (4, False), (5, True)]]
    df = spark.createDataFrame(rows, "v0 string, v1 string, ts timestamp_ntz, is_add boolean")
    got = graph.edge_intervals(df).orderBy("valid_from").collect()
    assert [(secs(r["valid_from"]), r["valid_to"] and secs(r["valid_to"])) for r in got] == [(1, 3), (5, None)]
    assert {r["v"]: secs(r["first_seen"]) for r in graph.vertex_first_seen(df).collect()} == {"a": 1, "b": 1}


def undirected(spark, pairs):
    return graph.symmetrize(spark.createDataFrame(pairs, "v0 string, v1 string")).select("src", "dst")


def test_expected_visits_golden_with_salts(spark):
    for per_salt in (100_000, 1):
        got = hubs.expected_visits(undirected(spark, [("a", "b"), ("b", "c")]), edges_per_salt=per_salt)
        got = {r["node"]: r["visits"] for r in got.collect()}
        assert got["a"] == pytest.approx(38.8889, abs=2e-3) and got["b"] == pytest.approx(72.2222, abs=2e-3)


def test_indexed_adjacency_numbers_every_edge(spark):
    edges = undirected(spark, [("hub", f"n{i}") for i in range(23)])
    got = hubs.indexed_adjacency(edges, edges_per_salt=4).filter("src = 'hub'").collect()
    assert sorted(r["i"] for r in got) == list(range(23))
    assert {r["dst"] for r in got} == {f"n{i}" for i in range(23)} and all(r["dst_degree"] == 1 for r in got)


def walk_paths(rows):
    out = {}
    for r in rows:
        out.setdefault(r["walk_id"], []).append(r)
    return {w: sorted(rs, key=lambda r: r["step"]) for w, rs in out.items()}


def check_walks(walks, pairs, starts):
    adjacency = {}
    for a, b in pairs:
        adjacency.setdefault(a, set()).add(b)
        adjacency.setdefault(b, set()).add(a)
    assert {w.split("#")[0] for w in walks} == starts
    for w, rows in walks.items():
        assert [r["step"] for r in rows] == list(range(len(rows)))
        assert rows[0]["node"] == w.split("#")[0]
        for here, there in zip(rows, rows[1:]):
            assert there["node"] in adjacency.get(here["node"], set())
            assert here["ending"] is None
        assert rows[-1]["ending"] in ("stopped", "dangling")
        assert (rows[-1]["ending"] == "dangling") <= (rows[-1]["node"] not in adjacency)


def test_simulated_visits_approach_the_expected_ones_and_survive_updates(spark):
    old = [("a", "b"), ("b", "c"), ("c", "d"), ("b", "e")]
    table = hubs.walk_table(undirected(spark, old), walks=400, seed=3)
    check_walks(walk_paths(table.collect()), old, set("abcde"))

    def close(rows, pairs):
        n = {r["node"]: r["visits"] for r in hubs.visit_counts(rows).collect()}
        want = {r["node"]: r["visits"] for r in
                hubs.expected_visits(undirected(spark, pairs), walks=400).collect()}
        return all(abs(n[v] - want[v]) / want[v] < .1 for v in want)

    assert close(table, old)
    changes = spark.createDataFrame(
        [("b", "d", True), ("d", "b", True), ("a", "f", True), ("f", "a", True),
         ("b", "e", False), ("e", "b", False)], "src string, dst string, is_add boolean")
    new = [("a", "b"), ("b", "c"), ("c", "d"), ("b", "d"), ("a", "f")]
    updated = hubs.update_walks(table, undirected(spark, old), changes, walks=400, seed=4)
    rows = updated.collect()
    check_walks(walk_paths(rows), new, set("abcdef"))
    assert close(updated.filter("walk_id NOT LIKE 'e#%' AND node != 'e'"), new)


def test_top_hubs_golden(spark):
    visits = spark.createDataFrame([("a", 5), ("b", 9), ("c", 9)], "node string, visits bigint")
    assert [r["node"] for r in hubs.top_hubs(visits, 2).orderBy("rank").collect()] == ["b", "c"]


PATH_EDGES = [("a", "b", 0, 10), ("b", "c", 5, 20), ("a", "d", 0, 20), ("d", "e", 0, 20), ("e", "c", 0, 20)]
QUERIES = "query_id bigint, start_ts timestamp_ntz, end_ts timestamp_ntz, source string, target string, type string"


def test_paths_golden(spark):
    asked = [(1, 0, 20, "SHORTEST"), (2, 0, 20, "EARLIEST"), (3, 0, 20, "CONTINUOUS"),
             (4, 0, 20, "REACHABILITY"), (5, 0, 4, "SHORTEST"), (6, 6, 6, "SHORTEST")]
    q = spark.createDataFrame(
        [(i, at(s), at(e), "a", "c", t) for i, s, e, t in asked] + [(7, at(0), at(20), "a", "zz", "SHORTEST")], QUERIES)
    got = {r["query_id"]: r for r in P.paths(spans(spark, PATH_EDGES), q).collect()}
    assert {i: "".join(r["path"] or []) for i, r in got.items()} == {
        1: "abc", 2: "adec", 3: "adec", 4: "abc", 5: "adec", 6: "abc", 7: ""}
    assert (secs(got[1]["start_ts"]), secs(got[1]["end_ts"])) == (5, 10)
    assert (secs(got[6]["start_ts"]), secs(got[6]["end_ts"])) == (6, 6)
    assert got[7]["path_found"] == 0


def brute_paths(edges, start, end, source, target, kind, hops):
    stop, best = end + 1e-6 if start == end else end, None
    both = edges + [(b, a, f, t) for a, b, f, t in edges]

    def walk(path, lo, hi):
        nonlocal best
        if path[-1] == target:
            if kind != "CONTINUOUS" or (lo == start and hi == stop):
                rank = (lo, len(path), path) if kind == "EARLIEST" else (len(path), lo, path)
                if best is None or rank < best[0]:
                    best = (rank, path, lo)
            return
        if len(path) > hops:
            return
        for a, b, f, t in both:
            if a == path[-1] and b not in path:
                low, high = max(lo, f), min(hi, math.inf if t is None else t)
                if low < high:
                    walk(path + [b], low, high)

    walk([source], start, stop)
    return best and ("".join(best[1]), best[2])


def test_paths_match_brute_force(spark):
    rng = random.Random(11)
    names, edges = "abcdefgh", []
    for x, a in enumerate(names):
        for b in names[x + 1:]:
            now = 0
            while now < 40 and rng.random() < .55:
                now += rng.randrange(1, 15)
                end = now + rng.randrange(2, 20)
                edges.append((a, b, now, None if rng.random() < .1 else end))
                if edges[-1][3] is None:
                    break
                now = end
    asked = []
    for i in range(60):
        start = rng.randrange(0, 40)
        a, b = rng.sample(names, 2)
        asked.append((i, start, start + rng.choice([0, 3, 10, 30]), a, b, P_TYPES[i % 4]))
    q = spark.createDataFrame([(i, at(s), at(e), a, b, t) for i, s, e, a, b, t in asked], QUERIES)
    got = {r["query_id"]: (("".join(r["path"]), secs(r["start_ts"])) if r["path_found"] else None)
           for r in P.paths(spans(spark, edges), q, max_hops=4, edges_per_salt=2).collect()}
    assert got == {i: brute_paths(edges, s, e, a, b, t, 4) for i, s, e, a, b, t in asked}


P_TYPES = ("SHORTEST", "CONTINUOUS", "EARLIEST", "REACHABILITY")


def test_snapshots_with_many_points(spark, monkeypatch):
    monkeypatch.setattr(snapshots, "BROADCAST_ROWS", 0)
    rng = random.Random(5)
    rows = [(f"n{i}", "z", f, f + rng.randrange(1, 30)) for i in range(30) for f in [rng.randrange(50)]]
    q = spark.createDataFrame([(i, at(i)) for i in range(60)], "query_id bigint, start_ts timestamp_ntz")
    rows = [(n, z, f, None if i % 5 == 0 else e) for i, (n, z, f, e) in enumerate(rows)]
    want = {(t, n) for n, _, f, e in rows for t in range(60) if f <= t and (e is None or t < e)}
    for per_cell in (3, 1, 1000):
        monkeypatch.setattr(snapshots, "POINTS_PER_CELL", per_cell)
        got = [(r["query_id"], r["v0"]) for r in snapshots.snapshot_at(spans(spark, rows), q).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_snapshot_states_and_json_parts(spark):
    edges = spans(spark, [("a", "b", 0, 10), ("b", "c", 4, None)])
    q = spark.createDataFrame([("q", at(2), at(12)), ("none", at(-5), at(-1))],
                              "query_id string, start_ts timestamp_ntz, end_ts timestamp_ntz")
    states = snapshots.snapshots_between(edges, q)
    got = sorted((r["query_id"], secs(r["ts"]), r["v0"] or "") for r in states.collect())
    assert got == [("none", -5, ""), ("q", 2, "a"), ("q", 4, "a"), ("q", 4, "b"), ("q", 10, "b")]
    texts = snapshots.snapshot_json(states.filter("query_id = 'q'"), ["query_id"], "ts").orderBy("ts").collect()
    assert texts[1]["snapshot"] == (
        'snapshots:[{"time":"01/01/2024,00:00:04","edges":[{"v0":"a","v1":"b"},{"v0":"b","v1":"c"}]}]')
    parted = snapshots.snapshot_json(states.filter("query_id = 'q'"), ["query_id"], "ts", edges_per_part=1)
    assert parted.filter("parts = 2").count() >= 1


def test_result_lines(spark):
    df = spark.createDataFrame(
        [("a", "b", v) for v in (0.5, 0.1234565, 1.0, -0.25)], "id0 string, id1 string, value double"
    ).selectExpr("*", "TIMESTAMP_NTZ '2016-02-15 12:52:50' AS window_end")
    got = [r["line"] for r in results.format_correlation(df).collect()]
    assert got == [f"f,a,b,02/15/2016,12:52:50,{v}" for v in ("0.5", "0.123456", "1", "-0.25")]
    assert results.format_transfer(df.selectExpr("*", "3 AS ticket")).first()["line"].startswith(
        "te,te_replay_response,3,a,b,")


def test_replay_of_stored_results_reads_what_is_asked_for(spark, tmp_path):
    rows = [(f"a{i % 7}", f"b{i % 5}", at(3600 * i), float(i)) for i in range(24 * 20)]
    df = spark.createDataFrame(rows, RESULTS)
    path = str(tmp_path / "stored")
    results.store_results(df, path, buckets=8)
    asked = spark.createDataFrame(
        [(1, at(3600 * 30), at(3600 * 90), ["a1", "b2", "a1"]), (2, at(3600 * 50), at(3600 * 52), ["b0"]),
         (1, at(0), at(3600 * 3), ["a0"]), (3, at(3600 * 60), at(3600 * 40), ["a2"]), (4, at(0), at(9), [])],
        "ticket int, start_ts timestamp_ntz, end_ts timestamp_ntz, players array<string>")
    want = sorted((t, r[0], r[1], r[2], r[3]) for t, lo, hi, names in map(tuple, asked.collect())
                  for r in rows if lo <= r[2] <= hi and {r[0], r[1]} & set(names))
    found = results.replay_stored(spark, path, asked, buckets=8)
    assert sorted(map(tuple, found.collect())) == want and len(want) > 20
    assert sorted(map(tuple, results.replay_selection(df, asked).collect())) == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "players" not in plan


def test_replay_of_many_long_requests_broadcasts_no_days(spark, tmp_path):
    """400 requests of a year make far more days than the bytes of their table tell."""
    df = spark.createDataFrame([(f"a{i % 3}", "b", at(86400 * 30 * i), float(i)) for i in range(12)], RESULTS)
    path = str(tmp_path / "stored")
    results.store_results(df, path, buckets=2)
    asked = spark.range(400).selectExpr(
        "id AS ticket", "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS start_ts",
        "TIMESTAMP_NTZ '2024-12-31 00:00:00' AS end_ts", "array('a1', 'b', concat('x', id)) AS players")
    made = []
    keep = results.materialize
    results.materialize = lambda rows: made.append(keep(rows)) or made[-1]
    try:
        found = results.replay_stored(spark, path, asked, buckets=2)
    finally:
        results.materialize = keep
    assert found.count() == 400 * 12
    assert max(rows.count() for rows in made) <= 400 * 3 * 12


def test_a_side_that_is_not_small_is_shuffled(spark):
    from tickweave.functions.sizing import broadcast_if_small

    side = spark.range(20).withColumnRenamed("id", "k")
    for rows, broadcast in ((20, True), (19, False)):
        plan = spark.range(9).selectExpr("id AS k").join(broadcast_if_small(side, rows), "k")
        assert ("BroadcastHashJoin" in plan._jdf.queryExecution().executedPlan().toString()) == broadcast


def test_replay_lists_a_result_once_per_ticket(spark):
    df = spark.createDataFrame([("a", "b", at(5), 1.0), ("a", "c", at(50), 1.0)], RESULTS)
    asked = spark.createDataFrame([(1, at(0), at(10), ["b", "a"]), (2, at(0), at(99), ["c"])],
                                  "ticket int, start_ts timestamp_ntz, end_ts timestamp_ntz, players array<string>")
    got = sorted((r["ticket"], r["id1"]) for r in results.replay_selection(df, asked).collect())
    assert got == [(1, "b"), (2, "c")]


def test_ties_do_not_depend_on_row_order(spark):
    rows = [("a", "b", at(1), 0.9), ("b", "a", at(1), 0.1), ("a", "b", at(2), 0.2), ("b", "a", at(2), 0.1)]
    seen = set()
    for order in (rows, rows[::-1], rows[1::-1] + rows[:1:-1]):
        frame = spark.createDataFrame(order, "id0 string, id1 string, window_end timestamp_ntz, value double")
        seen.add(tuple(map(tuple, graph.edge_changes(frame, 0.7).orderBy("ts").collect())))
    assert seen == {(("a", "b", at(1), True), ("a", "b", at(2), False))}
    events = [("a", "b", at(1), True), ("a", "b", at(3), False), ("a", "b", at(3), True), ("a", "b", at(5), True)]
    for order in (events, events[::-1]):
        frame = spark.createDataFrame(order, "v0 string, v1 string, ts timestamp_ntz, is_add boolean")
        got = sorted((r["valid_from"], r["valid_to"] or at(99)) for r in graph.edge_intervals(frame).collect())
        assert got == [(at(1), at(3)), (at(5), at(99))]


def test_paths_of_any_length(spark):
    edges = [(f"n{i}", f"n{i + 1}", 0, None) for i in range(9)]
    q = spark.createDataFrame(
        [(1, at(1), at(9), "n0", "n9", "REACHABILITY"), (2, at(1), at(9), "n0", "n9", "EARLIEST"),
         (3, at(1), at(9), "n0", "x", "SHORTEST")],
        "query_id int, start_ts timestamp_ntz, end_ts timestamp_ntz, source string, target string, type string")
    got = {r["query_id"]: r["path"] for r in P.paths(spans(spark, edges), q).collect()}
    assert got == {1: [f"n{i}" for i in range(10)], 2: [f"n{i}" for i in range(10)], 3: None}


def test_returning_node_starts_no_second_walks(spark):
    edges = undirected(spark, [("a", "b"), ("b", "c"), ("c", "d")])
    walks = hubs.walk_table(edges, walks=10)
    log = "src string, dst string, is_add boolean"
    both = lambda x, y, add: spark.createDataFrame([(x, y, add), (y, x, add)], log)
    walks = hubs.update_walks(walks, edges, both("a", "b", False), seed=21)
    walks = hubs.update_walks(walks, undirected(spark, [("b", "c"), ("c", "d")]), both("a", "b", True), seed=22)
    walks = hubs.update_walks(walks, edges, both("e", "a", True), seed=23)
    now = undirected(spark, [("a", "b"), ("b", "c"), ("c", "d"), ("a", "e")])
    got = {r["node"]: tuple(r)[1:] for r in hubs.walk_checks(walks, now).collect()}
    assert got == {n: (10, 0, 0) for n in "abcde"}


def test_empty_snapshot_has_an_answer(spark):
    q = spark.createDataFrame([("early", at(1)), ("late", at(6))], "query_id string, start_ts timestamp_ntz")
    found = snapshots.snapshot_at(spans(spark, [("a", "b", 5, None)]), q)
    texts = snapshots.snapshot_json(found, ["query_id"], "start_ts").collect()
    assert {r["query_id"]: r["snapshot"].count("v0") for r in texts} == {"early": 0, "late": 1}


def test_null_parameter_is_no_change(spark):
    from tickweave.operators import params
    rows = spark.createDataFrame([(at(t),) for t in (0, 2, 4)], "ts timestamp_ntz")
    log = spark.createDataFrame([("k", 5.0, at(1)), ("k", None, at(3))], "name string, value double, ts timestamp_ntz")
    for steps in (4096, 0):
        got = params.with_parameter(rows, log, "k", 1.0, step_changes=steps).orderBy("ts").collect()
        assert [r["k"] for r in got] == [1.0, 5.0, 5.0]


def test_list_size_at_the_end_of_the_period(spark):
    updates = spark.createDataFrame(
        [(f"n{i}", 10 - i, at(t), t * 10 + i) for t in (1, 11) for i in range(4)],
        "node string, visits bigint, ts timestamp_ntz, seq bigint")
    log = spark.createDataFrame([("hubListSize", 3.0, at(2)), ("hubListSize", 1.0, at(5)),
                                 ("hubListSize", 2.0, at(19))], "name string, value double, ts timestamp_ntz")
    got = hubs.top_hubs_windowed(updates, 4, "10 seconds", log).groupBy("window_start").count()
    assert [r["count"] for r in got.orderBy("window_start").collect()] == [1, 2]
