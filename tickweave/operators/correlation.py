"""Hayashi-Yoshida correlation of irregularly sampled series, over all data and in windows.

The numerator of a pair is the sum of delta products over overlapping intervals. The overlap join
never compares on a bare range predicate: ticks are numbered in time order, consecutive numbers
form buckets of about as many ticks as there are symbols, and intervals meet on equal buckets.
A bucket then holds a bounded number of intervals whatever bursts the data has, and the number of
candidate pairs stays proportional to the number of real overlaps.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.functions.cells import Cells, from_micros, interval_micros, micros
from tickweave.functions.ordered import explode_range, previous, row_numbers, running_max
from tickweave.operators.block_sums import PACKED, block_pair_sums, pack
from tickweave.operators.pairs import MAX_PAIR_TASKS, block_sides, blocks_for, member_pairs, pair_tasks
from tickweave.operators.params import with_parameter
from tickweave.session import materialize, ship_code

SERIES_PER_BLOCK = 1024
INTERVALS_PER_GROUP = 500_000
MOST_PER_GROUP = 8_000_000  # even where all of a span's ticks fall into one block
MOST_SIDES = 220  # partitions on either side where tasks are their pairs


def kind_keys(df: DataFrame) -> list[str]:
    """Streams of different kinds never pair; without the column there is one kind."""
    return ["kind"] if "kind" in df.columns else []


def scaled_value(scale: int | None):
    """Prices as whole units (e.g. cents with ``scale=100``) keep sums exact in any order."""
    if scale is None:
        return F.col("value")
    return F.round(F.col("value") * scale).cast("double")


def tick_intervals(
    ticks: DataFrame, cells: Cells | None = None, scale: int | None = None, numbered: bool = False
) -> DataFrame:
    """Consecutive ticks of one symbol as ``(begin_ts, end_ts, delta)``.

    ``numbered`` also gives both ends their place in the time order of all ticks.
    """
    position = micros("ts")
    cells = cells or Cells.fit(ticks, position)
    keys = [*kind_keys(ticks), "symbol"]
    rows = ticks.select(*keys, "ts", scaled_value(scale).alias("value"))
    values = ["ts", "value"]
    if numbered:
        rows = row_numbers(rows, [], ["ts", *keys], position, cells, "ord")
        values.append("ord")
    paired = previous(rows, keys, ["ts"], values, position, cells).filter("prev IS NOT NULL")
    extra = [F.col("prev.ord").alias("begin_ord"), F.col("ord").alias("end_ord")] if numbered else []
    return paired.select(
        *keys,
        F.col("prev.ts").alias("begin_ts"),
        F.col("ts").alias("end_ts"),
        (F.col("value") - F.col("prev.value")).alias("delta"),
        *extra,
    )


def number_interval_ends(intervals: DataFrame) -> DataFrame:
    """Add ``begin_ord``/``end_ord`` to intervals that come without ticks.

    Written once: both sides of the overlap join read it.
    """
    intervals = materialize(intervals)
    instants = intervals.select(F.explode(F.array("begin_ts", "end_ts")).alias("ts")).distinct()
    position = micros("ts")
    numbered = row_numbers(instants, [], ["ts"], position, Cells.fit(instants, position), "ord")
    begins = numbered.select(F.col("ts").alias("begin_ts"), F.col("ord").alias("begin_ord"))
    ends = numbered.select(F.col("ts").alias("end_ts"), F.col("ord").alias("end_ord"))
    return materialize(intervals.join(begins, "begin_ts").join(ends, "end_ts"))


def overlap_join(
    intervals: DataFrame,
    symbols: int | None = None,
    carry: tuple[str, ...] = (),
    rows: int | None = None,
    member: str = "symbol",
) -> DataFrame:
    """Pairs of intervals of different symbols whose open spans intersect.

    Columns: ``id0 < id1``, and ``delta``, ``begin_ts``, ``end_ts`` and ``carry`` suffixed 0 and 1.
    Every overlap appears once, in the bucket where the later of the two intervals begins.
    """
    keys = kind_keys(intervals)
    if "begin_ord" not in intervals.columns:
        intervals = number_interval_ends(intervals)
    if symbols is None:
        symbols = intervals.select(*keys, member).distinct().count()
    depth = max(8, symbols)
    values = list(dict.fromkeys(["delta", "begin_ts", "end_ts", *carry]))
    spans = intervals.select(
        *keys, member, *values,
        F.expr(f"begin_ord div {depth}").alias("_first"),
        F.expr(f"(end_ord - 1) div {depth}").alias("_last"),
    )
    placed = explode_range(spans, F.col("_first"), F.col("_last"), "_bucket").drop("_last")
    left, right = block_sides(placed, F.col(member), blocks_for(symbols))
    # the join emits about rows * symbols candidates from few bytes: size its tasks by that work,
    # since coalescing by bytes would put all of it into one
    # blocks lead the key, so that a task sums one block's pairs at a time
    home = ["_bl", "_br", "_bucket", *keys]
    tasks = pair_tasks(intervals.sparkSession, rows if rows is not None else intervals.count(), symbols)
    left, right = left.repartition(tasks, *home).alias("l"), right.repartition(tasks, *home).alias("r")
    a, b = F.col(f"l.{member}"), F.col(f"r.{member}")
    condition = (
        (F.col("l._bl") == F.col("r._bl"))
        & (F.col("l._br") == F.col("r._br"))
        & (F.col("l._bucket") == F.col("r._bucket"))
    )
    for key in keys:
        condition &= F.col(f"l.{key}") == F.col(f"r.{key}")
    condition &= (F.col("l.begin_ts") < F.col("r.end_ts")) & (F.col("r.begin_ts") < F.col("l.end_ts"))
    condition &= F.col("l._bucket") == F.greatest("l._first", "r._first")
    condition &= F.when(F.col("l._bl") == F.col("l._br"), a < b).otherwise(a != b)
    ordered = a < b
    return left.join(right, condition).select(
        *[F.col(f"l.{key}").alias(key) for key in keys],
        F.least(a, b).alias("id0"),
        F.greatest(a, b).alias("id1"),
        *[
            F.when(ordered, F.col(f"{x}.{v}")).otherwise(F.col(f"{y}.{v}")).alias(f"{v}{i}")
            for v in values
            for i, x, y in ((0, "l", "r"), (1, "r", "l"))
        ],
    )


def _correlation(num, norm):
    return F.greatest(F.least(num / norm, F.lit(1.0)), F.lit(-1.0))


def _numbered_intervals(
    ticks: DataFrame, cells: Cells | None, scale: int | None
) -> tuple[DataFrame, DataFrame, int, int]:
    """``(intervals, symbols, interval count, symbol count)``.

    Both tables are written once because several consumers read them. The symbol table numbers the
    symbols: pair sums then group by two integers instead of two strings.
    """
    intervals = materialize(tick_intervals(ticks, cells, scale, numbered=True))
    keys = kind_keys(intervals)
    per_symbol = intervals.groupBy(*keys, "symbol").agg(F.count(F.lit(1)).alias("n"))
    # all kinds share one numbering; its cells split a large symbol list over tasks
    per_symbol = materialize(per_symbol.withColumn("_at", F.xxhash64("symbol")))
    symbols = materialize(row_numbers(
        per_symbol, [], ["_at", "symbol", *keys], F.col("_at"),
        Cells.fit(per_symbol, F.col("_at")), "sid").drop("_at"))
    size = symbols.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("symbols")).first()
    return (
        intervals.join(symbols.drop("n"), [*keys, "symbol"]),
        symbols.select(*keys, "sid", "symbol"),
        size["rows"] or 0,
        size["symbols"],
    )


def _named(df: DataFrame, symbols: DataFrame) -> DataFrame:
    """Replace the symbol numbers ``s0``/``s1`` by the names ``id0 < id1``."""
    keys = kind_keys(df)
    for i in (0, 1):
        names = symbols.withColumnsRenamed({"sid": f"s{i}", "symbol": f"id{i}"})
        df = df.join(names, [*keys, f"s{i}"])
    return df.withColumns({"id0": F.least("id0", "id1"), "id1": F.greatest("id0", "id1")})


def hy_correlation(
    ticks: DataFrame, scale: int | None = None, cells: Cells | None = None
) -> DataFrame:
    """Correlation over all data: ``(id0, id1, value)`` for every pair that moves on both sides.

    ``ticks`` are clamped and de-duplicated. Pairs without any overlap get 0.
    """
    spark, keys = ticks.sparkSession, kind_keys(ticks)
    ship_code(spark)
    series = [*keys, "symbol"]
    ticks = materialize(ticks.select(*series, "ts", "value"))
    intervals = materialize(tick_intervals(ticks, cells, scale).dropna(subset=series))
    squares = materialize(intervals.groupBy(*series).agg(
        F.sum(F.col("delta") * F.col("delta")).alias("ss"), F.count(F.lit(1)).alias("n")).filter("ss > 0"))
    blocks = max(1, -(-squares.count() // SERIES_PER_BLOCK))
    block = F.pmod(F.xxhash64("symbol"), F.lit(blocks)).cast("int")
    heaviest = squares.groupBy(*keys, block).agg(F.sum("n").alias("n")).agg(F.max("n").alias("n")).first()["n"] or 0
    begin, end = micros("begin_ts"), micros("end_ts")
    timed = intervals.filter("begin_ts IS NOT NULL")
    spans = -(-2 * heaviest // INTERVALS_PER_GROUP)
    cut = Cells.fit(timed, begin, min(MOST_PER_GROUP, -(-timed.count() // max(1, spans)) or 1))

    # two whole blocks of series meet over a span of time; one span is enough unless blocks are heavy,
    # and then a pair's sum never leaves its task
    placed = explode_range(
        timed.select(*series, begin.alias("begin"), end.alias("end"), "delta"),
        cut.of(F.col("begin")).cast("bigint"), F.greatest(cut.of(F.col("begin")), cut.of(F.col("end") - 1)).cast("bigint"),
        "span").select(*series, F.col("span").cast("int").alias("span"), F.struct("begin", "end", "delta").alias("interval"))
    nothing = F.lit(None).cast(placed.schema["interval"].dataType)
    listed = placed.unionByName(squares.select(*series, F.lit(0).alias("span"), nothing.alias("interval"))).groupBy(
        *series, "span").agg(F.collect_list("interval").alias("intervals")).join(squares.drop("n"), series)
    kind = "kind string, " if keys else ""
    home = [*keys, "block", "span"]
    packed = materialize(listed.withColumn("block", block).groupBy(*home).applyInArrow(
        pack, f"{kind}block int, span int, {PACKED}"))
    # every block is shuffled once, not once for each block that it meets: tasks read the partitions of two
    # blocks, or where there are more spans than blocks, all blocks of a span
    many = blocks >= cut.count
    tasks = min(blocks, MOST_SIDES) if many else min(cut.count, MAX_PAIR_TASKS)
    dealt = packed.repartition(tasks, *keys, "block" if many else "span")
    left, right = (dealt.select(*[F.col(c).alias(c if x == "l" and c in keys else f"{x}_{c}") for c in packed.columns])
                   for x in "lr")
    meet = (F.col("l_span") == F.col("r_span")) & (F.col("l_block") <= F.col("r_block"))
    for key in keys:
        meet &= F.col(key).eqNullSafe(F.col(f"r_{key}"))
    met = left.join(right.hint("shuffle_replicate_nl" if many else "merge"), meet).drop(
        "r_span", *[f"r_{key}" for key in keys]).withColumnRenamed("l_span", "span")
    summed = met.mapInArrow(
        block_pair_sums(cut.cuts, len(keys)), f"{kind}id0 string, id1 string, num double, norm double")
    if not cut.single:
        summed = summed.groupBy(*keys, "id0", "id1").agg(F.sum("num").alias("num"), F.max("norm").alias("norm"))
    return summed.select(*keys, "id0", "id1", _correlation(F.col("num"), F.col("norm")).alias("value"))


def window_grid(ticks: DataFrame, size: str, advance: str) -> tuple[int, int, int, int]:
    """``(t0, size, advance, windows)`` in microseconds; window k starts at t0 + k*advance.

    t0 is the first timestamp; a window is complete once a tick at or past its end exists.
    """
    span = ticks.agg(F.min(micros("ts")).alias("lo"), F.max(micros("ts")).alias("hi")).first()
    size_us, advance_us = interval_micros(size), interval_micros(advance)
    if span["lo"] is None or span["lo"] + size_us > span["hi"]:
        return span["lo"] or 0, size_us, advance_us, 0
    return span["lo"], size_us, advance_us, (span["hi"] - size_us - span["lo"]) // advance_us + 1


def hy_correlation_sliding(
    ticks: DataFrame,
    size: str = "30 seconds",
    advance: str = "1 second",
    scale: int | None = None,
    cells: Cells | None = None,
    first_window: int = 0,
    grid: tuple[int, int, int, int] | None = None,
    size_log: DataFrame | None = None,
    name: str = "windowSize",
) -> DataFrame:
    """Correlation per sliding window: ``(id0, id1, window_start, window_end, value)``.

    Window W uses the intervals with ``W <= end < W + size``. The windows that hold an overlap are
    a range; its product goes to the aligned parts of that range, and a window adds up the parts
    that hold it.

    With a parameter log ``size_log(name, value, ts)`` the size, in seconds, changes while ticks
    flow, and ``size`` holds before the first change. A window is closed, after all earlier ones, by
    the first tick at or past its start plus the size in force at that tick, and holds every
    interval from its start that ended before that tick. ``window_end`` uses that size.
    """
    keys = kind_keys(ticks)
    ticks = materialize(ticks.select(*keys, "symbol", "ts", "value"))
    if size_log is not None:
        closings = window_closings(ticks, size, advance, size_log, name)
        t0, advance_us, windows = closings.t0, interval_micros(advance), closings.windows
    else:
        t0, size_us, advance_us, windows = grid or window_grid(ticks, size, advance)
    intervals, symbols, rows, members = _numbered_intervals(ticks, cells, scale)

    offset = micros("end_ts") - t0
    if size_log is not None:
        # windows that the tick at an interval's end, or one before it, has closed do not hold it
        ends = closings.times.select(F.col("ts").alias("end_ts"), F.col("closed").alias("k_lo"))
        held = intervals.join(ends, "end_ts")
    else:
        held = intervals.withColumn("k_lo", F.greatest(
            F.floor((offset - size_us) / advance_us) + 1, F.lit(first_window)).cast("bigint"))
    held = held.withColumn(
        "k_hi", F.least(F.floor(offset / advance_us), F.lit(windows - 1)).cast("bigint")).filter("k_lo <= k_hi")
    if size_log is not None:
        held = materialize(held)
        most = held.agg(F.max(F.col("k_hi") - F.col("k_lo")).alias("n")).first()["n"] or 0
        levels = (most + 2).bit_length()
    else:
        levels = (size_us // advance_us + 2).bit_length()

    pair = [*keys, "s0", "s1"]
    squares = per_window(
        held.filter("delta != 0").select(
            *keys, "sid", "k_lo", "k_hi", (F.col("delta") * F.col("delta")).alias("ss")),
        [*keys, "sid"], "k_lo", "k_hi", "ss", levels).groupBy(*keys, "sid", "k").agg(
        F.sum("ss").alias("ss")).filter("ss > 0")
    grid_rows = member_pairs(
        squares, [*keys, "k"], "sid", ["ss"], blocks_for(members), rows=members * windows).select(
        *keys, F.col("id0").alias("s0"), F.col("id1").alias("s1"), "k",
        F.lit(0.0).alias("num"), (F.sqrt("ss0") * F.sqrt("ss1")).alias("norm"))

    overlaps = overlap_join(held, members, carry=("k_lo", "k_hi"), rows=rows, member="sid").select(
        *keys, F.col("id0").alias("s0"), F.col("id1").alias("s1"),
        (F.col("delta0") * F.col("delta1")).alias("num"),
        F.greatest("k_lo0", "k_lo1").alias("lo"), F.least("k_hi0", "k_hi1").alias("hi"))
    products = per_window(overlaps.filter("lo <= hi AND num != 0"), pair, "lo", "hi", "num", levels)
    summed = products.withColumn("norm", F.lit(None).cast("double")).unionByName(grid_rows).groupBy(
        *pair, "k").agg(F.sum("num").alias("num"), F.max("norm").alias("norm"))
    found = _named(summed.filter("norm IS NOT NULL"), symbols)
    start = F.lit(t0) + F.col("k") * advance_us
    if size_log is not None:
        found = found.join(closings.sizes, "k")
        end = start + F.col("size")
    else:
        end = F.lit(t0 + size_us) + F.col("k") * advance_us
    return found.select(
        *keys, "id0", "id1", from_micros(start).alias("window_start"), from_micros(end).alias("window_end"),
        _correlation(F.col("num"), F.col("norm")).alias("value"))


@dataclass(frozen=True)
class Closings:
    """When windows of changing size close.

    ``times(ts, closed)`` has the number of windows closed at or before every tick time, and
    ``sizes(k, size)`` the size in force at the tick that closed window k, in microseconds.
    """

    t0: int
    windows: int
    times: DataFrame
    sizes: DataFrame


def window_closings(
    ticks: DataFrame, size: str, advance: str, size_log: DataFrame, name: str = "windowSize",
    cells: Cells | None = None,
) -> Closings:
    """The piecewise window grid of a parameter log.

    A tick at t with size s in force can close the windows that start by t - s. Windows close in
    order, so as many are closed by t as any tick up to t could: a running maximum, split by cells.
    """
    advance_us = interval_micros(advance)
    instants = materialize(ticks.select("ts").distinct())
    t0 = instants.agg(F.min(micros("ts")).alias("lo")).first()["lo"] or 0
    sized = with_parameter(instants, size_log, name, interval_micros(size) / 1_000_000)
    reached = sized.select("ts", micros("ts").alias("at"), F.round(F.col(name) * 1_000_000).cast("bigint").alias(
        "size")).withColumn("reach", F.greatest(
            F.floor((F.col("at") - F.col("size") - t0) / advance_us).cast("bigint") + 1, F.lit(0)))
    cells = cells or Cells.fit(instants, micros("ts"))
    closed = running_max(reached, [], ["at"], "reach", F.col("at"), cells, "closed")
    times = materialize(previous(closed, [], ["at"], ["closed"], F.col("at"), cells))
    windows = times.agg(F.max("closed").alias("n")).first()["n"] or 0
    before = F.coalesce(F.col("prev.closed"), F.lit(0))
    sizes = explode_range(times.select("size", before.alias("first"), (F.col("closed") - 1).alias("last")),
                          F.col("first"), F.col("last"), "k").select("k", "size")
    return Closings(t0, windows, times.select("ts", "closed"), sizes)


def aligned_ranges(low: str, high: str, levels: int):
    """``[low, high]`` as disjoint ranges ``node * 2**level`` to ``(node + 1) * 2**level - 1``.

    At most two for each level, so a row costs two per doubling of the windows it lives in.
    """
    nodes = []
    for level in range(levels):
        left = F.shiftright(F.col(low) + ((1 << level) - 1), level)
        right = F.shiftright(F.col(high) + 1, level)
        for odd, node in ((left, left), (right, right - 1)):
            nodes.append(F.when((left < right) & (odd % 2 == 1), F.struct(
                F.lit(level).alias("level"), node.alias("node"))))
    return F.array_compact(F.array(*nodes))


def per_window(rows: DataFrame, keys: list[str], low: str, high: str, amount: str, levels: int):
    """Partial sums of ``amount`` by ``(keys, k)`` for every window k in ``[low, high]`` of a row.

    Amounts are only ever added, never taken back, so a large one leaves no rounding error in the
    windows after it.
    """
    nodes = rows.select(*keys, amount, F.explode(aligned_ranges(low, high, levels)).alias("_at")).select(
        *keys, amount, "_at.level", "_at.node").groupBy(*keys, "level", "node").agg(
        F.sum(amount).alias(amount))
    first = F.expr("shiftleft(node, level)")
    return explode_range(nodes, first, first + F.expr("shiftleft(1L, level)") - 1, "k").select(
        *keys, "k", amount)


def pairwise_measure(ticks: DataFrame, method: str, **options) -> DataFrame:
    """Any pairwise measure as ``(id0, id1, window_start, window_end, value)``."""
    from tickweave.operators.entropy import transfer_entropy, transfer_entropy_sliding

    measures = {
        "correlation": hy_correlation_sliding,
        "transfer_entropy": transfer_entropy,
        "transfer_entropy_sliding": transfer_entropy_sliding,
    }
    if method not in measures:
        raise ValueError(f"unknown measure {method!r}; known: {', '.join(measures)}")
    return measures[method](ticks, **options)
