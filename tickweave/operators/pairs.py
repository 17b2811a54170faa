"""Unordered pairs of rows that share keys, built by an equi-join on block pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_MEMBERS = 256
BLOCK_NAMES = 1024
PAIRS_PER_TASK = 20_000_000
WORTH_A_TASK = 100_000
MAX_PAIR_TASKS = 50_000


def blocks_for(members: int) -> int:
    """Blocks so that one block pair holds a bounded number of member pairs."""
    return max(1, -(-members // BLOCK_MEMBERS))


def pair_tasks(spark, rows: int, symbols: int) -> int:
    """Tasks for work that grows with rows * symbols."""
    pairs = rows * symbols
    spread = min(int(spark.conf.get("spark.sql.shuffle.partitions")), pairs // WORTH_A_TASK + 1)
    return min(MAX_PAIR_TASKS, max(spread, pairs // PAIRS_PER_TASK))


def block_sides(df: DataFrame, member: Column, blocks: int) -> tuple[DataFrame, DataFrame]:
    """The left and right inputs of a block-pair join.

    A member of block i goes left to every (i, j>=i) and right to every (j<=i, i). Each
    unordered block pair thus has one home, spread over ``blocks*(blocks+1)/2`` join keys.
    """
    if blocks == 1:
        return df.withColumns({"_bl": F.lit(0), "_br": F.lit(0)}), df.withColumns(
            {"_bl": F.lit(0), "_br": F.lit(0)})
    own = F.pmod(F.xxhash64(member), F.lit(blocks)).cast("int")
    left = df.withColumn("_bl", own).withColumn(
        "_br", F.explode(F.sequence(F.col("_bl"), F.lit(blocks - 1))))
    right = df.withColumn("_br", own).withColumn(
        "_bl", F.explode(F.sequence(F.lit(0), F.col("_br"))))
    return left, right


def member_pairs(
    df: DataFrame, keys: Sequence[str], member: str, carry: Sequence[str], blocks: int, rows: int = 0
) -> DataFrame:
    """Every unordered pair of members with equal keys, once.

    Columns: keys, ``id0 < id1``, and ``carry`` suffixed 0 and 1 in the same order. ``rows`` is the
    input size when the pairs are many more than the rows; it sizes the tasks.
    """
    left, right = block_sides(df.select(*keys, member, *carry), F.col(member), blocks)
    if rows:
        home = ["_bl", "_br", *keys]
        tasks = pair_tasks(df.sparkSession, rows, min(rows, blocks * BLOCK_MEMBERS))
        left, right = left.repartition(tasks, *home), right.repartition(tasks, *home)
    left, right = left.alias("l"), right.alias("r")
    a, b = F.col(f"l.{member}"), F.col(f"r.{member}")
    condition = (F.col("l._bl") == F.col("r._bl")) & (F.col("l._br") == F.col("r._br"))
    for key in keys:
        condition &= F.col(f"l.{key}") == F.col(f"r.{key}")
    condition &= F.when(F.col("l._bl") == F.col("l._br"), a < b).otherwise(a != b)
    joined = left.join(right, condition)
    ordered = a < b
    return joined.select(
        *[F.col(f"l.{key}").alias(key) for key in keys],
        F.least(a, b).alias("id0"),
        F.greatest(a, b).alias("id1"),
        *[
            F.when(ordered, F.col(f"{x}.{c}")).otherwise(F.col(f"{y}.{c}")).alias(f"{c}{i}")
            for c in carry
            for i, x, y in ((0, "l", "r"), (1, "r", "l"))
        ],
    )


def symbol_pairs(symbols: DataFrame, blocks: int | None = None) -> DataFrame:
    """Every unordered pair of distinct symbols exactly once (within a kind, if there is one).

    The pairs grow with the square of the symbols. Blocks of names meet as arrays, and tasks are sized
    by the pairs that they unfold, row by row.
    """
    keys = ["kind"] if "kind" in symbols.columns else []
    names = symbols.select(*keys, "symbol").dropna().distinct()
    members = names.count()
    blocks = blocks or max(1, -(-members // BLOCK_NAMES))
    packed = names.groupBy(*keys, F.pmod(F.xxhash64("symbol"), F.lit(blocks)).cast("int").alias("_own")).agg(
        F.collect_list("symbol").alias("_names"))
    left = packed.withColumns({"_bl": F.col("_own"), "_br": F.explode(F.sequence(F.col("_own"), F.lit(blocks - 1)))})
    right = packed.withColumns({"_br": F.col("_own"), "_bl": F.explode(F.sequence(F.lit(0), F.col("_own")))})
    home, tasks = [*keys, "_bl", "_br"], pair_tasks(symbols.sparkSession, members, members)
    met = left.select(*home, F.col("_names").alias("_left")).repartition(tasks, *home).hint("merge").join(
        right.select(*home, F.col("_names").alias("_right")).repartition(tasks, *home), home)
    unfolded = met.select(*home, "_right", F.explode("_left").alias("_a")).select(
        *home, "_a", F.explode("_right").alias("_b"))
    return unfolded.filter("_bl != _br OR _a < _b").select(
        *keys, F.least("_a", "_b").alias("id0"), F.greatest("_a", "_b").alias("id1"))
