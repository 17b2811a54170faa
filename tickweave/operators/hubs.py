"""Hub ranking by random-walk visits.

Every node starts ``walks`` walks; each step goes on with probability ``1 - stop`` to a uniform
neighbour, and a walk at a node without neighbours ends. Visits count every arrival, the start
included. ``edges`` is a directed adjacency ``(src, dst)``; symmetrize an undirected graph first.
"""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickweave.functions.cells import Cells, from_micros, interval_micros, micros
from tickweave.functions.ordered import as_of, last_known
from tickweave.functions.sizing import BROADCAST_ROWS, broadcast_if_small
from tickweave.operators.params import STEP_CHANGES, with_parameter
from tickweave.session import materialize

EDGES_PER_SALT = 100_000


def _nodes(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct()


def salted_adjacency(edges: DataFrame, edges_per_salt: int = EDGES_PER_SALT) -> tuple[DataFrame, DataFrame]:
    """``(adjacency, nodes)`` with the edges of a large node spread over several salts.

    ``nodes(node, degree, salts)`` lists every node; adjacency rows carry the salt of their
    source, its degree, and the ``salts`` of their target. Other edge columns are kept.
    """
    edges = materialize(edges)
    degrees = edges.groupBy("src").agg(F.count(F.lit(1)).alias("degree"))
    nodes = materialize(
        _nodes(edges)
        .join(degrees.withColumnRenamed("src", "node"), "node", "left")
        .select(
            "node",
            F.coalesce("degree", F.lit(0)).alias("degree"),
            F.greatest(F.ceil(F.coalesce("degree", F.lit(0)) / edges_per_salt), F.lit(1))
            .cast("int").alias("salts"),
        ))
    sources = nodes.select(F.col("node").alias("src"), "degree", F.col("salts").alias("src_salts"))
    targets = nodes.select(F.col("node").alias("dst"), F.col("salts").alias("dst_salts"))
    adjacency = (
        edges.join(sources, "src").join(targets, "dst")
        .withColumn("salt", F.pmod(F.xxhash64("dst"), F.col("src_salts")).cast("int"))
        .drop("src_salts")
    )
    return adjacency, nodes


def every_salt(salts: str = "salts") -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(salts) - 1))


def expected_visits(
    edges: DataFrame,
    walks: int = 10,
    stop: float = 0.2,
    iters: int = 50,
    cut_every: int = 10,
    edges_per_salt: int = EDGES_PER_SALT,
) -> DataFrame:
    """Expected visits ``(node, visits)``: iterate x <- 1 + (1-stop) * P'x and scale by ``walks``.

    The adjacency is partitioned by (src, salt) once and stays so for the loop. Each round moves
    one row per node and salt; contributions are summed before the shuffle to their target.
    """
    adjacency, nodes = salted_adjacency(edges.select("src", "dst").distinct(), edges_per_salt)
    weighted = (
        adjacency.select("src", "salt", "dst", (F.lit(1.0 - stop) / F.col("degree")).alias("w"))
        .repartition("src", "salt").persist(StorageLevel.MEMORY_AND_DISK)
    )
    small = nodes.agg(F.sum("salts").alias("n")).first()["n"] or 0
    base = nodes.select(F.col("node").alias("dst"), F.lit(1.0).alias("v"), "salts")
    x = nodes.select("node", "salts", F.lit(1.0).alias("x"))
    for i in range(1, iters + 1):
        spread = x.select(F.col("node").alias("src"), "x", every_salt().alias("salt"))
        if small <= BROADCAST_ROWS:
            spread = F.broadcast(spread)
        moved = weighted.join(spread, ["src", "salt"]).select(
            "dst", (F.col("x") * F.col("w")).alias("v"), F.lit(None).cast("int").alias("salts"))
        x = (
            base.unionByName(moved).groupBy("dst")
            .agg(F.sum("v").alias("x"), F.max("salts").alias("salts"))
            .select(F.col("dst").alias("node"), "salts", "x")
        )
        if i % cut_every == 0 or i == iters:
            x = materialize(x)
    weighted.unpersist()
    return x.select("node", (F.col("x") * walks).alias("visits"))


def indexed_adjacency(edges: DataFrame, edges_per_salt: int = EDGES_PER_SALT) -> DataFrame:
    """``(src, i, dst, dst_degree)`` with i = 0..degree-1 per source.

    Numbers are given per (src, salt) and offset by the sizes of the salts before, so no task
    holds all edges of a hub. Carrying the target's degree lets a walk draw its next edge without
    looking the node up.
    """
    adjacency, nodes = salted_adjacency(edges.select("src", "dst").distinct(), edges_per_salt)
    adjacency = materialize(adjacency.select("src", "dst", "salt"))
    sizes = adjacency.groupBy("src", "salt").count()
    before = Window.partitionBy("src").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("src", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy("src", "salt").orderBy("dst")) - 1
    numbered = adjacency.withColumn("place", place).join(offsets, ["src", "salt"])
    degrees = nodes.select(F.col("node").alias("dst"), F.col("degree").alias("dst_degree"))
    return numbered.join(degrees, "dst").select(
        "src", (F.col("place") + F.col("offset")).alias("i"), "dst", "dst_degree")


def _uniform(seed: int, *parts) -> Column:
    """A uniform draw in [0, 1) that depends on the key only, not on the partitioning.

    The first 52 bits of the MD5 of the comma-joined key, which any SQL engine can compute too.
    """
    names = [p if isinstance(p, Column) else F.col(p) for p in parts]
    text = F.concat_ws(",", F.lit(str(seed)), *[n.cast("string") for n in names])
    digits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10)
    return digits.cast("bigint") / F.lit(float(1 << 52))


def _extend(frontier: DataFrame, indexed: DataFrame, stop: float, seed: int, cut_every: int) -> DataFrame:
    """Walk on from ``frontier(walk_id, gen, step, node, degree)`` until every walk ended.

    Returns all rows reached, the frontier's own included, with ``ending`` set on each walk's last
    row: ``stopped`` by the draw or ``dangling`` for lack of neighbours. A walk carries the rows of
    the current segment in ``trail``; every ``cut_every`` steps the segment is written once.
    """
    key = ["walk_id", "gen"]

    def judged(step: Column, degree: Column) -> Column:
        draw = _uniform(seed, F.lit("stop"), *key, step)
        return F.when(draw < stop, F.lit("stopped")).when(degree == 0, F.lit("dangling"))

    def row(step, node, ending):
        return F.struct(step.alias("step"), node.alias("node"), ending.alias("ending"))

    state = frontier.withColumn("ending", judged(F.col("step"), F.col("degree")))
    state = state.withColumn("trail", F.array(row(F.col("step"), F.col("node"), F.col("ending"))))
    # dealt once by (node, i), the key of every step's join
    hops = indexed.withColumnRenamed("src", "node").repartition("node", "i").persist(
        StorageLevel.DISK_ONLY)
    segments: list[DataFrame] = []
    while True:
        for _ in range(cut_every):
            pick = F.floor(_uniform(seed, F.lit("edge"), *key, "step") * F.col("degree"))
            # (node, i) spreads the walks of a hub over its edges; ended walks match no edge
            place = F.when(F.col("ending").isNull(), F.least(pick, F.col("degree") - 1)).otherwise(
                -1 - F.pmod(F.xxhash64("walk_id"), F.lit(1024)))
            moved = F.col("dst").isNotNull()
            state = (
                state.withColumn("i", place).join(hops, ["node", "i"], "left")
                .select(
                    *key, "trail", moved.alias("moved"), "ending",
                    F.when(moved, F.col("step") + 1).otherwise(F.col("step")).alias("step"),
                    F.coalesce("dst", "node").alias("node"),
                    F.when(moved, F.col("dst_degree")).otherwise(F.col("degree")).alias("degree"))
                .withColumn("ending", F.when(
                    F.col("moved"), judged(F.col("step"), F.col("degree"))).otherwise(F.col("ending")))
                .withColumn("trail", F.when(F.col("moved"), F.array_append(
                    "trail", row(F.col("step"), F.col("node"), F.col("ending")))).otherwise(F.col("trail")))
                .drop("moved")
            )
        saved = materialize(state)
        segments.append(saved.select(*key, F.explode("trail").alias("t")).select(*key, "t.*"))
        alive = saved.filter("ending IS NULL")
        if alive.isEmpty():
            break
        state = alive.withColumn("trail", F.slice("trail", 1, 0))
    hops.unpersist()
    out = segments[0]
    for segment in segments[1:]:
        out = out.unionByName(segment)
    return out


def walk_table(
    edges: DataFrame, walks: int = 10, stop: float = 0.2, seed: int = 7, cut_every: int = 8
) -> DataFrame:
    """Simulated walks ``(walk_id, gen, step, node, ending)``; ``gen`` counts re-draws."""
    edges = materialize(edges.select("src", "dst").distinct())
    indexed = materialize(indexed_adjacency(edges))
    degrees = indexed.groupBy("src").agg(F.count(F.lit(1)).alias("degree"))
    starts = (
        _nodes(edges).join(degrees.withColumnRenamed("src", "node"), "node", "left")
        .select("node", F.coalesce("degree", F.lit(0)).alias("degree"),
                F.explode(F.sequence(F.lit(0), F.lit(walks - 1))).alias("_r"))
        .select(F.concat_ws("#", "node", "_r").alias("walk_id"), F.lit(0).alias("gen"),
                F.lit(0).alias("step"), "node", "degree")
    )
    return _extend(starts, indexed, stop, seed, cut_every)


def visit_counts(walk_rows: DataFrame) -> DataFrame:
    return walk_rows.groupBy("node").agg(F.count(F.lit(1)).alias("visits"))


def visit_counts_mc(edges: DataFrame, walks: int = 10, stop: float = 0.2, seed: int = 7) -> DataFrame:
    """Monte-Carlo visits per node."""
    return visit_counts(walk_table(edges, walks, stop, seed))


def update_walks(
    walk_rows: DataFrame,
    edges_before: DataFrame,
    changes: DataFrame,
    walks: int = 10,
    stop: float = 0.2,
    seed: int = 7,
    cut_every: int = 8,
    gen: int | None = None,
) -> DataFrame:
    """Keep stored walks valid after ``changes(src, dst, is_add)`` without starting over.

    A stored hop from a node that gained g of its now d edges is rerouted with probability g/d
    through one of the new edges; a hop over a removed edge is redrawn among the edges that are
    left; a walk that dangled at a node with new edges resumes. Each walk is cut at its first
    such step and walked on from there. Walks that meet no changed node are only copied. A node
    without live edges keeps its ``walks`` starts, each a walk of one visit. Give every update its
    own ``seed``, or its draws repeat those of the one before. What is walked anew is of generation
    ``gen``, by default one more than the walk's last. ``WalkStore`` does the same at the cost of the
    walks that change; this rewrites them all.
    """
    before = materialize(edges_before.select("src", "dst").distinct())
    wanted = materialize(changes.select("src", "dst", "is_add"))
    added = wanted.filter("is_add").select("src", "dst").distinct().join(before, ["src", "dst"], "left_anti")
    removed = wanted.filter(~F.col("is_add")).select("src", "dst").distinct().join(
        before, ["src", "dst"], "left_semi")
    after = materialize(before.unionByName(added).join(removed, ["src", "dst"], "left_anti"))
    added = materialize(added.join(removed, ["src", "dst"], "left_anti"))
    removed = materialize(removed)
    indexed = materialize(indexed_adjacency(after))

    gained = added.groupBy("src").agg(F.count(F.lit(1)).alias("gained"))
    lost = removed.select("src").distinct().withColumn("lost", F.lit(True))
    degree = after.groupBy("src").agg(F.count(F.lit(1)).alias("degree"))
    touched = (
        gained.join(lost, "src", "full").join(degree, "src", "left")
        .select(F.col("src").alias("node"), F.coalesce("gained", F.lit(0)).alias("gained"),
                F.coalesce("degree", F.lit(0)).alias("new_degree"))
    )

    by_step = Window.partitionBy("walk_id").orderBy("step")
    hops = walk_rows.withColumns({
        "next_node": F.lead("node").over(by_step),
        "last_gen": F.max("gen").over(Window.partitionBy("walk_id")),
    })
    met = hops.join(touched, "node").join(
        removed.select(F.col("src").alias("node"), F.col("dst").alias("next_node"),
                       F.lit(True).alias("broken")),
        ["node", "next_node"], "left")
    through_new = _uniform(seed, F.lit("reroute"), "walk_id", "gen", "step") * F.col("new_degree") < F.col("gained")
    reason = (
        F.when(F.col("broken"), F.lit("redraw"))
        .when(F.col("next_node").isNotNull() & through_new, F.lit("reroute"))
        .when((F.col("ending") == "dangling") & (F.col("gained") > 0), F.lit("reroute"))
    )
    cuts = materialize(
        met.withColumn("reason", reason).filter("reason IS NOT NULL")
        .groupBy("walk_id").agg(F.min("step").alias("cut"), F.min_by("reason", "step").alias("reason"),
             (F.lit(gen) if gen is not None else F.max("last_gen") + 1).alias("next_gen")))

    marked = walk_rows.join(cuts, "walk_id", "left")
    kept = marked.filter("cut IS NULL OR step <= cut")
    heads = marked.filter("step = cut").select(
        "walk_id", F.col("next_gen").alias("gen"), "step", "node", "reason")
    kept = kept.withColumn("ending", F.when(F.col("step") == F.col("cut"), F.lit(None)).otherwise(F.col("ending")))

    # a redraw picks among all edges left, a reroute among the new ones
    new_edges = indexed_adjacency(added).select("src", F.col("i").alias("j"), "dst")
    sized = heads.join(touched, "node")
    any_edge = F.floor(_uniform(seed, F.lit("edge"), "walk_id", "gen", "step") * F.col("new_degree"))
    new_edge = F.floor(_uniform(seed, F.lit("edge"), "walk_id", "gen", "step") * F.col("gained"))
    degree_of = degree.select(F.col("src").alias("dst"), F.col("degree").alias("dst_degree"))
    redrawn = sized.filter("reason = 'redraw' AND new_degree > 0").withColumn("i", any_edge).join(
        indexed.withColumnRenamed("src", "node"), ["node", "i"]).select(
        "walk_id", "gen", "step", "dst", "dst_degree")
    rerouted = sized.filter("reason = 'reroute'").withColumn("j", new_edge).join(
        new_edges.withColumnRenamed("src", "node"), ["node", "j"]).join(
        degree_of, "dst", "left").select(
        "walk_id", "gen", "step", "dst", F.coalesce("dst_degree", F.lit(0)).alias("dst_degree"))
    stranded = sized.filter("reason = 'redraw' AND new_degree = 0").select(
        "walk_id", "step", F.lit("dangling").alias("now"))
    frontier = redrawn.unionByName(rerouted).select(
        "walk_id", "gen", (F.col("step") + 1).alias("step"),
        F.col("dst").alias("node"), F.col("dst_degree").alias("degree"))

    # nodes that appear with the change start their own walks
    # a node that lost all its edges keeps its walks and starts none when it comes back
    started = walk_rows.filter("step = 0").select("node").distinct()
    newcomers = _nodes(added).join(started, "node", "left_anti").join(
        degree.withColumnRenamed("src", "node"), "node", "left").select(
        "node", F.coalesce("degree", F.lit(0)).alias("degree"),
        F.explode(F.sequence(F.lit(0), F.lit(walks - 1))).alias("_r")).select(
        F.concat_ws("#", "node", "_r").alias("walk_id"), F.lit(0).alias("gen"),
        F.lit(0).alias("step"), "node", "degree")

    tail = _extend(materialize(frontier.unionByName(newcomers)), indexed, stop, seed, cut_every)
    columns = ["walk_id", "gen", "step", "node", "ending"]
    settled = kept.join(stranded, ["walk_id", "step"], "left").withColumn(
        "ending", F.coalesce("now", "ending"))
    return materialize(settled.select(*columns).unionByName(tail.select(*columns)))


def walk_checks(walk_rows: DataFrame, edges: DataFrame) -> DataFrame:
    """Per node: ``starts`` of its own walks, ``duplicates`` of a step and ``dead_hops``, hops from
    it over an edge that is not in ``edges``. Sound walks have the same starts and zeros."""
    steps = walk_rows.groupBy("walk_id", "step").agg(
        F.count(F.lit(1)).alias("rows"), F.min("node").alias("node"))
    following = steps.select("walk_id", (F.col("step") - 1).alias("step"), F.col("node").alias("dst"))
    live = edges.select(F.col("src").alias("node"), "dst", F.lit(0).alias("dead")).distinct()
    hops = steps.join(following, ["walk_id", "step"], "left").join(live, ["node", "dst"], "left")
    dead = F.col("dst").isNotNull() & F.col("dead").isNull()
    return hops.groupBy("node").agg(
        F.sum((F.col("step") == 0).cast("bigint")).alias("starts"),
        F.sum(F.col("rows") - 1).alias("duplicates"), F.sum(dead.cast("bigint")).alias("dead_hops"))


def latest_visits(updates: DataFrame) -> DataFrame:
    """Updates overwrite: the newest count of every node."""
    return updates.groupBy("node").agg(F.max_by("visits", "seq").alias("visits"))


def top_hubs(visits: DataFrame, k: int = 10) -> DataFrame:
    """The k most visited nodes, best first, ties by node id: ``(rank, node, visits)``."""
    best = visits.orderBy(F.desc("visits"), "node").limit(k)
    return best.select(
        F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("visits"), "node")).alias("rank"),
        "node", "visits")


def top_hubs_windowed(
    updates: DataFrame, k: int = 10, every: str = "10 seconds", k_log: DataFrame | None = None,
    name: str = "hubListSize", period_log: DataFrame | None = None, period_name: str = "windowSize",
) -> DataFrame:
    """The k best nodes per period among the nodes updated in it.

    With a parameter log ``k_log(name, value, ts)`` a list has the size in force at the end of its
    period, and ``k`` holds before the first change. With ``period_log`` the length of the periods,
    in seconds, changes as ``change_periods`` says.
    """
    timed = updates.withColumn("w", F.window("ts", every)) if period_log is None else in_periods(
        updates, change_periods(updates.sparkSession, period_log, every, period_name))
    latest = timed.groupBy("w", "node").agg(F.max_by("visits", "seq").alias("visits"))
    most = k
    if k_log is not None:
        latest = materialize(latest)
        ends = latest.select("w", F.col("w.end").alias("ts")).distinct()
        sizes = materialize(with_parameter(ends, k_log, name, k).select("w", F.col(name).alias("_k")))
        most = sizes.agg(F.max("_k")).first()[0]
    # a constant limit on the rank is applied before the shuffle as well
    order = Window.partitionBy("w").orderBy(F.desc("visits"), "node")
    ranked = latest.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= F.lit(int(most or 0)))
    if k_log is not None:
        ranked = ranked.join(sizes, "w").filter(F.col("rank") <= F.col("_k"))
    return ranked.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "rank", "node", "visits")


PERIODS = "at long, prior long, first long, length long, until long"
BEFORE_ALL = -(1 << 62)


def period_stretch(at: int | None, prior: int, length: int, until: int | None) -> tuple[tuple, int]:
    """One row of PERIODS and the last signal before ``until``.

    ``prior`` is the last signal before ``at``. A signal comes at the first instant that is one
    period in force after the last signal, so a shorter period can make it come at the change.
    ``first`` is the next signal if no later change moves it; before any change signals lie on
    multiples of the period, so there 0 stands for all of them.
    """
    first = 0 if at is None else max(at, prior + length)
    last = prior
    if until is not None and (at is None or first < until):
        last = first + (until - 1 - first) // length * length
    return (at, prior, first, length, until), last


def change_periods(
    spark, period_log: DataFrame, every: str, name: str = "windowSize", step_changes: int = STEP_CHANGES,
) -> DataFrame:
    """Stretches of equal period: ``at`` (null in the first), the last signal ``prior`` before it,
    the ``first`` one from it on, the ``length`` of its periods and ``until``, all in microseconds.

    Signals begin at the epoch with period ``every``. The log ``(name, value, ts)`` gives seconds and
    holds from its time on; values that are null or not above 0 are no change. Where a signal lies
    depends on all changes before, so the log is gone through in order, ``step_changes`` at a time
    with one signal carried on; a log with more changes takes more steps, not more memory.
    """
    newest = F.max_by("value", "seq") if "seq" in period_log.columns else F.max("value")
    changes = materialize(period_log.filter((F.col("name") == name) & (F.col("value") > 0)).groupBy(
        micros("ts").alias("at")).agg(newest.alias("value")).select(
        "at", F.round(F.col("value") * 1_000_000).cast("bigint").alias("length")).filter("length > 0"))
    cells = Cells.fit(changes, F.col("at"), step_changes)
    at, prior, length, tables = None, 0, interval_micros(every), []
    for cell in range(cells.count):
        rows = []
        for change in changes.filter(cells.of(F.col("at")) == cell).orderBy("at").collect():
            row, prior = period_stretch(at, prior, length, change["at"])
            rows.append(row)
            at, length = change["at"], change["length"]
        tables.append(spark.createDataFrame(rows, PERIODS))
    tables.append(spark.createDataFrame([period_stretch(at, prior, length, None)[0]], PERIODS))
    stretches = materialize(reduce(DataFrame.unionByName, tables)).withColumn(
        "order", F.coalesce("at", F.lit(BEFORE_ALL)))
    # a change may come before the signal: then the next one is that of a later stretch
    comes = F.when(F.col("at").isNull() | F.col("until").isNull() | (F.col("first") < F.col("until")), F.col("first"))
    marked = stretches.withColumns({"comes": comes, "up": -F.col("order")})
    return last_known(marked, [], ["up"], "comes", F.col("up"), Cells.fit(marked, F.col("up")), "next").select(
        "order", "at", "prior", F.col("next").alias("first"), "length", "until")


def in_periods(updates: DataFrame, stretches: DataFrame) -> DataFrame:
    """Updates with the period ``w`` (start and end) they fall into."""
    stretches = materialize(stretches)
    following = stretches.select(F.col("at").alias("until"), F.col("first").alias("then"))
    known = stretches.join(following, "until", "left").select(
        F.col("order").alias("_stretch"), "at", "prior", "first", "length", "until", "then")
    placed = as_of(updates.withColumn("order", micros("ts")), stretches.select("order", F.col("order").alias("_stretch")),
                   [], ["order"], "_stretch", F.col("order"))
    now = F.col("order")
    early = F.col("at").isNotNull() & (now < F.col("first"))
    start = F.col("first") + F.floor((now - F.col("first")) / F.col("length")).cast("bigint") * F.col("length")
    whole = F.col("until").isNull() | (start + F.col("length") < F.col("until"))
    end = F.when(early, F.col("first")).when(whole, start + F.col("length")).otherwise(F.col("then"))
    period = F.struct(from_micros(F.when(early, F.col("prior")).otherwise(start)).alias("start"),
                      from_micros(end).alias("end"))
    kept = [F.col(f"l.{c}") for c in updates.columns]
    return placed.alias("l").join(broadcast_if_small(known).alias("r"), "_stretch").select(*kept, period.alias("w"))


def hub_list(ranked: DataFrame, keys: list[str]) -> DataFrame:
    """Ranked rows as one ``hubs`` array per key, best first (k entries at most)."""
    entries = F.array_sort(F.collect_list(F.struct("rank", "node")))
    return ranked.groupBy(*keys).agg(F.transform(entries, lambda e: e["node"]).alias("hubs"))
