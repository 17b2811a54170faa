"""Arrival order, duplicates and row filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.functions.cells import Cells, from_micros, micros
from tickweave.functions.ordered import as_of, following, previous, running_max
from tickweave.functions.sizing import BROADCAST_ROWS, at_most, broadcast_if_small


def clamp_out_of_order(
    ticks: DataFrame, cells: Cells | None = None, floor_micros: int | None = None
) -> DataFrame:
    """Lift late ticks to the newest timestamp seen before them in arrival order (``seq``).

    ``cells`` are over ``seq``; ``floor_micros`` is the newest timestamp of an earlier batch.
    """
    cells = cells or Cells.fit(ticks, F.col("seq"))
    marked = ticks.withColumn("_ts", micros("ts"))
    lifted = running_max(marked, [], ["seq"], "_ts", F.col("seq"), cells, "_newest")
    newest = F.col("_newest")
    if floor_micros is not None:
        newest = F.greatest(newest, F.lit(floor_micros))
    return lifted.withColumn("ts", from_micros(newest)).select(*ticks.columns)


def dedup_same_timestamp(ticks: DataFrame) -> DataFrame:
    """Keep the first arrival of each (symbol, ts).

    ``min_by`` combines on the map side, so a burst of copies never meets in one task.
    """
    keys = [c for c in ("kind", "symbol", "ts") if c in ticks.columns]
    rest = [c for c in ticks.columns if c not in (*keys, "seq")]
    return (
        ticks.groupBy(*keys)
        .agg(*[F.min_by(c, "seq").alias(c) for c in rest], F.min("seq").alias("seq"))
        .select(*ticks.columns)
    )


def filter_known_symbols(ticks: DataFrame, symbols: DataFrame) -> DataFrame:
    """Drop ticks of symbols outside the list.

    A list with the time ``ts`` of its arrival also drops all ticks before the first arrival.
    """
    if "ts" in symbols.columns:
        first = symbols.agg(F.min("ts").alias("first")).first()["first"]
        ticks = ticks.filter(F.col("ts") >= F.lit(first).cast("timestamp_ntz"))
        symbols = symbols.select("symbol").distinct()
    return ticks.join(broadcast_if_small(symbols.select("symbol")), "symbol", "left_semi")


def settled_commands(commands: DataFrame, keys: list[str]) -> DataFrame:
    """One command per key and instant: the last by ``seq``, or a removal when there is no order."""
    newest = F.max_by("is_add", "seq") if "seq" in commands.columns else F.bool_and("is_add")
    return commands.groupBy(*keys, "ts").agg(newest.alias("is_add"))


def membership_ranges(commands: DataFrame, keys: list[str]) -> DataFrame:
    """Add/remove commands as half-open ranges ``[from_ts, to_ts)`` of membership."""
    changes = settled_commands(commands, keys)
    position = micros("ts")
    cells = Cells.fit(changes, position)
    return following(changes, keys, ["ts"], ["ts"], position, cells).filter("is_add").select(
        *keys, F.col("ts").alias("from_ts"), F.col("next.ts").alias("to_ts"))


def filter_members(
    rows: DataFrame, commands: DataFrame, keys: list[str], broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Rows whose key is a member at their time; nobody is a member before the first add.

    A short command log becomes broadcast ranges; a long one is merged with the rows in time
    order instead.
    """
    if at_most(commands, broadcast_rows):
        ranges = F.broadcast(membership_ranges(commands, keys)).alias("r")
        left = rows.alias("l")
        condition = F.col("l.ts") >= F.col("r.from_ts")
        condition &= F.col("r.to_ts").isNull() | (F.col("l.ts") < F.col("r.to_ts"))
        for key in keys:
            condition &= F.col(f"l.{key}") == F.col(f"r.{key}")
        return left.join(ranges, condition, "left_semi")
    known = as_of(rows, settled_commands(commands, keys), keys, ["ts"], "is_add", micros("ts"), out="_member")
    return known.filter("_member").select(*rows.columns)


def filter_focus_players(ticks: DataFrame, commands: DataFrame, **options) -> DataFrame:
    """Ticks of the players in focus at the tick's time."""
    return filter_members(ticks, commands.withColumnRenamed("player", "symbol"), ["symbol"], **options)


def attach_symbol_names(df: DataFrame, names: DataFrame) -> DataFrame:
    """Add the display name of ``symbol``; null when unknown."""
    return df.join(broadcast_if_small(names.select("symbol", "name")), "symbol", "left")


def drop_repeated_records(records: DataFrame, cells: Cells | None = None) -> DataFrame:
    """Drop a record equal to the one that arrived just before it (order by ``seq``)."""
    values = [c for c in records.columns if c != "seq"]
    cells = cells or Cells.fit(records, F.col("seq"))
    paired = previous(records, [], ["seq"], values, F.col("seq"), cells)
    same = F.struct(*values).eqNullSafe(F.col("prev"))
    return paired.filter(~same).select(*records.columns)


def limit_symbols(ticks: DataFrame, n: int = 500) -> DataFrame:
    """Ticks of the first ``n`` distinct symbols in arrival order."""
    first = ticks.groupBy("symbol").agg(F.min("seq").alias("_first"))
    chosen = first.orderBy("_first").limit(n).select("symbol")
    return ticks.join(F.broadcast(chosen) if n <= BROADCAST_ROWS else chosen, "symbol", "left_semi")


def canonical_pairs(df: DataFrame) -> DataFrame:
    """Order ``id0``/``id1`` lexicographically."""
    return df.withColumns({"id0": F.least("id0", "id1"), "id1": F.greatest("id0", "id1")})


def subscribe_pairs(results: DataFrame, pairs: DataFrame, time: str = "window_end") -> DataFrame:
    """Results of the subscribed pairs.

    ``pairs`` is a plain pair list, or a subscribe/unsubscribe log with ``ts`` and ``is_add``.
    """
    wanted = canonical_pairs(pairs)
    tagged = results.withColumns({"_a": F.least("id0", "id1"), "_b": F.greatest("id0", "id1")})
    wanted = wanted.withColumnsRenamed({"id0": "_a", "id1": "_b"})
    if "is_add" in wanted.columns:
        timed = tagged.withColumn("ts", F.col(time))
        return filter_members(timed, wanted, ["_a", "_b"]).select(*results.columns)
    chosen = broadcast_if_small(wanted.select("_a", "_b").distinct())
    return tagged.join(chosen, ["_a", "_b"], "left_semi").select(*results.columns)


def tag_kind(ticks: DataFrame, kind: str) -> DataFrame:
    """Mark the stream a tick belongs to, e.g. ``f`` financial or ``w`` web."""
    return ticks.withColumn("kind", F.lit(kind))


def union_kinds(*streams: DataFrame) -> DataFrame:
    """One table of differently tagged ticks; missing columns become null."""
    merged = streams[0]
    for stream in streams[1:]:
        merged = merged.unionByName(stream, allowMissingColumns=True)
    return merged
