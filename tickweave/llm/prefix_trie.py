"""Trie of the common beginnings of conversations, by time-forward processing.

A node is a distinct sequence of first turns. Its key is a sum of position-dependent turn hashes, so
keys of all prefixes are running sums that split inside a long conversation. A node is named by its
smallest member and its depth; the nodes that one conversation names form a chain that hangs below a
node of a smaller conversation, and a chain's nodes get their subtree totals as running sums from
its end once every chain that hangs below it has its own.

Chains form the tree that is processed time-forward: they are sorted in reverse level order of their
tops, and each sends its totals to its parent through a priority queue ordered by the receiver's
turn, which spills sorted runs to disk. Chains are sharded: a chain's level is the magnitude of the
rows below it (powers of SHARD_ROWS), and a shard is a maximal subtree of chains of one level, so a
shard holds a bounded number of rows of that magnitude, however many conversations share a first
turn. Shards of one level run in parallel; their roots' totals, summed by receiver, are what the
next level begins with. There are as many levels as SHARD_ROWS-fold steps in the number of turns.

Defined cases: turns are ordered by turn (null first), then role, then text; null role and text are
empty; repeated rows are turns of their own; rows without an id belong to no conversation and are
left out; an empty table has no node, not even the root.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import pickle
import tempfile

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.functions import ordered
from tickweave.functions.cells import Cells
from tickweave.llm import batches as B
from tickweave.llm.frames import arrow_schema, materialize, quoted, ship_code

FAMILY = 20             # conversations that share the base they are rebuilt on
HEADS = 4               # a rebuilt conversation takes less than so many turns of its base
SHARD_ROWS = 1024       # rows below a shard root, times powers of itself on higher levels
QUEUE_MESSAGES = 200_000  # messages a task keeps in memory; more go to sorted runs on disk
IDS_PER_PIECE = 8192    # ids of one node hashed as one piece
ROWS_PER_CELL = 1_000_000


# ---------------------------------------------------------------------------------- turns
def numbered_turns(conversations: DataFrame, rows_per_cell: int = ROWS_PER_CELL) -> DataFrame:
    """``conv, idx`` (from 1), hashes ``t1, t2`` of role and text, and ``words`` of each turn."""
    role, text = (F.coalesce(quoted(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter(quoted("conv_id").isNotNull()).select(
        quoted("conv_id").cast("long").alias("conv"), quoted("turn").cast("long").alias("turn"),
        role.alias("role"), text.alias("text"))
    cells = Cells.fit(turns, F.col("turn"), rows_per_cell)
    numbered = ordered.row_numbers(turns, ["conv"], ["turn", "role", "text"], F.col("turn"), cells, "idx")
    return numbered.select("conv", "idx", F.xxhash64("role", "text").alias("t1"),
                           F.xxhash64(F.lit("turn"), "text", "role").alias("t2"), words("text").alias("words"))


def words(text: str) -> Column:
    """The number of runs of anything but ASCII blanks; no list of them is built."""
    marks = F.regexp_replace(text, r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+", "x")
    return F.when(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.length(marks)).otherwise(0).cast("long")


def rebuilt_turns(numbered: DataFrame) -> DataFrame:
    """``conv, depth, total`` and the turn's columns of every rebuilt conversation, depth 0 included.

    Conversation c begins with the first h turns of c - c % FAMILY (h from c's checksum) and goes on
    with its own turns after its first h.
    """
    counts = numbered.groupBy("conv").agg(F.max("idx").alias("own"))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS).alias("h")
    base = counts.select(F.col("conv").alias("base"), F.col("own").alias("base_turns"))
    plans = counts.select("conv", "own", h, (F.col("conv") - F.col("conv") % FAMILY).alias("base")).join(
        base, "base", "left").withColumn(
        "taken", F.least("h", F.coalesce("base_turns", F.lit(0)))).withColumn(
        "total", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    plans = materialize(plans.select("conv", "base", "h", "taken", "total"))
    turn = ["t1", "t2", "words"]
    heads = numbered.filter(F.col("idx") < HEADS).select(F.col("conv").alias("base"), "idx", *turn)
    first = plans.filter("taken > 0").join(heads, "base").filter("idx <= taken").select(
        "conv", F.col("idx").alias("depth"), "total", *turn)
    rest = numbered.join(plans.drop("base"), "conv").filter("idx > h").select(
        "conv", (F.col("idx") - F.col("h") + F.col("taken")).alias("depth"), "total", *turn)
    root = plans.select("conv", F.lit(0).cast("long").alias("depth"), "total",
                        *[F.lit(None).cast("long").alias(c) for c in turn])
    return first.union(rest).union(root)


def prefix_paths(rebuilt: DataFrame, rows_per_cell: int = ROWS_PER_CELL) -> DataFrame:
    """Key ``(k1, k2)`` of every prefix and ``(p1, p2)`` of the prefix one turn shorter."""
    mask, nothing = F.lit(0xFFFFFFFF), F.lit(0)
    parts = []
    for i, seed in enumerate((3, 7)):
        mixed = F.xxhash64(F.lit(seed), "depth", "t1", "t2")
        parts += [F.when(F.col("depth") == 0, nothing).otherwise(mixed.bitwiseAND(mask)).alias(f"a{2 * i}"),
                  F.when(F.col("depth") == 0, nothing).otherwise(
                      F.shiftrightunsigned(mixed, 32)).alias(f"a{2 * i + 1}")]
    names = ["a0", "a1", "a2", "a3"]
    rows = rebuilt.select("conv", "depth", "total", F.coalesce("words", nothing).alias("words"),
                          *parts)
    cells = Cells.fit(rows, F.col("depth"), rows_per_cell)
    summed = ordered.running_sums(rows, ["conv"], ["depth"], names, F.col("depth"), cells, "upto")

    def key(depth, values):
        return [F.xxhash64(F.lit(s), depth, *values) for s in (11, 13)]

    here = key(F.col("depth"), [F.col(f"upto.{n}") for n in names])
    above = key(F.col("depth") - 1, [F.col(f"upto.{n}") - F.col(n) for n in names])
    top = F.col("depth") == 0
    return summed.select(
        "conv", "depth", "total", "words", here[0].alias("k1"), here[1].alias("k2"),
        F.when(~top, above[0]).alias("p1"), F.when(~top, above[1]).alias("p2"))


# ---------------------------------------------------------------------------------- nodes and chains
def trie_nodes(paths: DataFrame) -> DataFrame:
    """One row a node: key, ``conv_id`` (smallest member), depth, parent, members and row weight."""
    nodes = materialize(paths.groupBy("k1", "k2").agg(
        F.min("conv").alias("conv_id"), F.min("depth").alias("depth"), F.min("p1").alias("p1"),
        F.min("p2").alias("p2"), F.count(F.lit(1)).alias("n_convs"), F.min("words").alias("words"),
        F.sum(F.col("total") - F.col("depth") + 1).alias("weight")))
    above = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                         F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(above, ["p1", "p2"], "left").select(
        "k1", "k2", "conv_id", "depth", "parent_conv_id", "n_convs", "weight",
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))


def attached(nodes: DataFrame) -> DataFrame:
    """The number of chains that hang below each node that has any."""
    tops = nodes.filter("parent_conv_id <> conv_id")
    return tops.groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_attached"))


def chains_of(nodes: DataFrame, shard_rows: int) -> DataFrame:
    """One row a chain: its top, key, own totals, parent and level.

    Level l holds chains with ``shard_rows ** l <= weight < shard_rows ** (l + 1)``.
    """
    hung = F.coalesce("n_attached", F.lit(0))
    rows = nodes.join(attached(nodes), ["conv_id", "depth"], "left")
    ends = F.max(F.struct("depth", F.when(hung == 0, 1).otherwise(0).cast("long").alias("leaf")))
    top = F.min(F.struct("depth", "parent_conv_id", "weight", "k1", "k2"))
    chains = rows.groupBy("conv_id").agg(top.alias("top"), ends.alias("end"), F.sum("saved").alias("saved"))
    level = F.lit(0)
    size = shard_rows
    while size < 1 << 62:
        level = level + (F.col("top.weight") >= F.lit(size)).cast("int")
        size *= shard_rows
    chains = materialize(chains.select(
        "conv_id", F.col("top.depth").alias("depth"), F.col("top.parent_conv_id").alias("parent"),
        F.col("top.k1").alias("k1"), F.col("top.k2").alias("k2"), F.col("end.leaf").alias("leaves"),
        "saved", level.alias("level")))
    above = chains.select(F.col("conv_id").alias("parent"), F.col("depth").alias("parent_depth"),
                          F.col("level").alias("parent_level"))
    return chains.join(above, "parent", "left")


def with_shards(chains: DataFrame, paths: DataFrame) -> DataFrame:
    """Each chain with its shard: the chain of its level that hangs below a higher level.

    Levels fall along a path, so a conversation passes at most one such chain of each level.
    """
    roots = chains.filter("parent is null or parent_level > level").select(
        "k1", "k2", "level", F.col("conv_id").alias("shard"))
    of = paths.select("conv", "k1", "k2").join(roots, ["k1", "k2"]).select(
        F.col("conv").alias("conv_id"), "level", "shard")
    return chains.drop("k1", "k2").join(of, ["conv_id", "level"])


# ---------------------------------------------------------------------------------- time-forward
class SpillingQueue:
    """Messages ``(order, leaves, saved)``, smallest order first.

    At most ``limit`` are held in memory; when they are exceeded they are summed by receiver and
    written as a sorted run to an unnamed file in Spark's scratch folder, which the task alone reads.
    """

    def __init__(self, limit: int = QUEUE_MESSAGES):
        self.limit = limit
        self.heap: list[tuple] = []
        self.runs: list = []
        self.fronts: list[tuple] = []   # next message of each run

    def push(self, order: tuple, leaves: int, saved: int) -> None:
        heapq.heappush(self.heap, (order, leaves, saved))
        if len(self.heap) > self.limit:
            self.spill()

    def spill(self) -> None:
        folders = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")
        run = tempfile.TemporaryFile(dir=folders[0] if os.path.isdir(folders[0]) else None)
        order, leaves, saved = heapq.heappop(self.heap)
        while self.heap:
            following = heapq.heappop(self.heap)
            if following[0] == order:
                leaves, saved = leaves + following[1], saved + following[2]
                continue
            pickle.dump((order, leaves, saved), run)
            order, leaves, saved = following
        pickle.dump((order, leaves, saved), run)
        run.seek(0)
        self.runs.append(run)
        self.advance(len(self.runs) - 1)

    def advance(self, number: int) -> None:
        try:
            heapq.heappush(self.fronts, (pickle.load(self.runs[number]), number))
        except EOFError:
            self.runs[number].close()

    def take(self, order: tuple) -> tuple[int, int]:
        """The sums of all messages for one receiver; they leave the queue."""
        leaves = saved = 0
        while self.heap and self.heap[0][0] == order:
            _, a, b = heapq.heappop(self.heap)
            leaves, saved = leaves + a, saved + b
        while self.fronts and self.fronts[0][0][0] == order:
            (_, a, b), number = heapq.heappop(self.fronts)
            leaves, saved = leaves + a, saved + b
            self.advance(number)
        return leaves, saved


TOTALS = "conv_id long, depth long, parent long, all_leaves long, all_saved long"


def forward_totals(rows: DataFrame, queue_messages: int = QUEUE_MESSAGES) -> DataFrame:
    """Subtree totals of chains whose ``leaves`` and ``saved`` hold all that came from other shards."""
    schema = arrow_schema(TOTALS)

    def run(stream):
        queue = SpillingQueue(queue_messages)
        for batch in stream:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            out_leaves, out_saved = [], []
            for conv, depth, parent, parent_depth, inside, leaves, saved in zip(*columns):
                more_leaves, more_saved = queue.take((-depth, conv))
                leaves, saved = leaves + more_leaves, saved + more_saved
                if inside:
                    queue.push((-parent_depth, parent), leaves, saved)
                out_leaves.append(leaves)
                out_saved.append(saved)
            yield B.batch_of(schema, *[batch.column(i) for i in range(3)], out_leaves, out_saved)

    inside = F.coalesce(F.col("parent_level") == F.col("level"), F.lit(False))
    return rows.repartition("shard").select(
        "conv_id", "depth", "parent", "parent_depth", inside.alias("inside"), "leaves", "saved"
    ).sortWithinPartitions(F.desc("depth"), "conv_id").mapInArrow(run, TOTALS)


def chain_totals(sharded: DataFrame, queue_messages: int = QUEUE_MESSAGES) -> DataFrame:
    """Subtree totals of every chain, shards level by level, each begun with its roots' sums."""
    levels = [r["level"] for r in sharded.select("level").distinct().collect()]
    done = None
    for level in sorted(levels):
        rows = sharded.filter(F.col("level") == level)
        if done is not None:
            sent = done.groupBy(F.col("parent").alias("conv_id")).agg(
                F.sum("all_leaves").alias("in_leaves"), F.sum("all_saved").alias("in_saved"))
            rows = rows.join(sent, "conv_id", "left").withColumn(
                "leaves", F.col("leaves") + F.coalesce("in_leaves", F.lit(0))).withColumn(
                "saved", F.col("saved") + F.coalesce("in_saved", F.lit(0)))
        found = materialize(forward_totals(rows, queue_messages))
        done = found if done is None else done.unionByName(found)
    return done


def node_totals(nodes: DataFrame, totals: DataFrame, rows_per_cell: int = ROWS_PER_CELL) -> DataFrame:
    """Children and subtree totals of every node, as running sums from the end of its chain."""
    sent = totals.filter("parent is not null").groupBy(
        F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_attached"), F.sum("all_leaves").alias("in_leaves"),
        F.sum("all_saved").alias("in_saved"))
    ends = nodes.groupBy("conv_id").agg(F.max("depth").alias("end"))
    last = F.col("depth") == F.col("end")
    hung = F.coalesce("n_attached", F.lit(0))
    own = nodes.join(sent, ["conv_id", "depth"], "left").join(ends, "conv_id").select(
        "k1", "k2", "conv_id", "depth", "parent_conv_id", "n_convs",
        (hung + F.when(last, 0).otherwise(1)).cast("long").alias("n_children"),
        (F.coalesce("in_leaves", F.lit(0)) + F.when(last & (hung == 0), 1).otherwise(0)).alias("leaves"),
        (F.col("saved") + F.coalesce("in_saved", F.lit(0))).alias("below"), (-F.col("depth")).alias("up"))
    own = materialize(own)
    cells = Cells.fit(own, F.col("up"), rows_per_cell)
    summed = ordered.running_sums(own, ["conv_id"], ["up"], ["leaves", "below"], F.col("up"), cells, "upto")
    return summed.select("k1", "k2", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
                         F.col("upto.leaves").alias("n_leaves"), F.col("upto.below").alias("saved_tokens"))


# ---------------------------------------------------------------------------------- ends
PIECES = "k1 long, k2 long, first long, ids string"
DIGESTS = "k1 long, k2 long, ends_sha256 string"


def ends_digest(paths: DataFrame, ids_per_piece: int = IDS_PER_PIECE) -> DataFrame:
    """SHA-256 of the ids of the conversations that end at each node, in order, comma-joined.

    Ids are sorted over all tasks and joined in pieces there; a node's pieces then pass one hash.
    """
    pieces, digests = arrow_schema(PIECES), arrow_schema(DIGESTS)

    def join(stream):
        key, held = None, []
        for batch in stream:
            out = []
            for a, b, conv in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                if (a, b) != key or len(held) >= ids_per_piece:
                    if held:
                        out.append((*key, held[0], ",".join(map(str, held))))
                    key, held = (a, b), []
                held.append(conv)
            if out:
                yield B.batch_of(pieces, *zip(*out))
        if held:
            yield B.batch_of(pieces, *([x] for x in (*key, held[0], ",".join(map(str, held)))))

    def digest(stream):
        key, state = None, None
        for batch in stream:
            out = []
            for a, b, ids in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                if (a, b) == key:
                    state.update(b"," + ids.encode())
                    continue
                if key:
                    out.append((*key, state.hexdigest()))
                key, state = (a, b), hashlib.sha256(ids.encode())
            if out:
                yield B.batch_of(digests, *zip(*out))
        if key:
            yield B.batch_of(digests, *([x] for x in (*key, state.hexdigest())))

    ends = paths.filter("depth = total").select("k1", "k2", "conv")
    joined = ends.repartitionByRange("k1", "k2", "conv").sortWithinPartitions("k1", "k2", "conv").mapInArrow(
        join, PIECES)
    return joined.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first").select(
        "k1", "k2", "ids").mapInArrow(digest, DIGESTS)


NO_ENDS = hashlib.sha256(b"").hexdigest()


def prefix_trie(conversations: DataFrame, shard_rows: int = SHARD_ROWS, rows_per_cell: int = ROWS_PER_CELL,
                queue_messages: int = QUEUE_MESSAGES) -> DataFrame:
    """Every node of the trie of rebuilt conversations.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null at the root), ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``. The sizes of shards, cells
    and queues change how the work is dealt, never the result.
    """
    ship_code(conversations.sparkSession)
    numbered = materialize(numbered_turns(conversations, rows_per_cell))
    rebuilt = materialize(rebuilt_turns(numbered))
    paths = materialize(prefix_paths(rebuilt, rows_per_cell))
    nodes = materialize(trie_nodes(paths))
    chains = materialize(chains_of(nodes, shard_rows))
    sharded = materialize(with_shards(chains, paths))
    totals = chain_totals(sharded, queue_messages)
    if totals is None:
        totals = sharded.sparkSession.createDataFrame([], TOTALS)
    found = node_totals(nodes, totals, rows_per_cell)
    return found.join(ends_digest(paths), ["k1", "k2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))
