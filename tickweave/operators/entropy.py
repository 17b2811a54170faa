"""Directed transfer entropy between symbols on a regular grid.

The transfer entropy of m transitions is the mean of ``log2(n(x',x,y) n(x) / (n(x,y) n(x',x)))`` over
them, n being counts. It is zero only where every such quotient is one, so zeros are found exactly.

Over sliding windows the counts change by single steps, and the sum of ``c*log2(c)`` that follows
from them is kept as whole numbers: with ``log2(c)`` split over the primes of c, a window has one
integer a prime, which running sums carry without rounding. Logarithms of primes are independent
over the rationals, so a window is zero exactly when all its integers are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickweave.functions.cells import Cells, from_micros, interval_micros, micros
from tickweave.functions.ordered import as_of, explode_range, following, previous, running_sums
from tickweave.operators.correlation import kind_keys
from tickweave.operators.pairs import blocks_for, member_pairs
from tickweave.session import materialize

GRID_PER_CELL = 1_000_000


def grid_number(ts: str, step: int) -> Column:
    return F.floor(micros(ts) / step).cast("bigint")


def sample_basic_windows(ticks: DataFrame, interval: str = "10 seconds") -> DataFrame:
    """The last value of every basic window, carried forward over windows without a tick.

    Columns ``(symbol, g, value)``; grid point g covers ``[g, g+1) * interval`` since the epoch.
    A symbol's samples run from its first tick to the last tick of the table.
    """
    return _samples(ticks, interval).drop("before", "first")


def _samples(ticks: DataFrame, interval: str) -> DataFrame:
    """Samples with the one ``before`` (null at the symbol's ``first`` grid point)."""
    step = interval_micros(interval)
    keys = [*kind_keys(ticks), "symbol"]
    closing = ticks.groupBy(*keys, grid_number("ts", step).alias("g")).agg(
        F.max_by("value", F.struct("ts", "seq")).alias("value"))
    span = ticks.agg(F.min(micros("ts")).alias("lo"), F.max(micros("ts")).alias("hi")).first()
    if span["hi"] is None:
        return closing.select(*keys, "g", "value", F.col("value").alias("before"), F.col("g").alias("first"))
    last = span["hi"] // step
    cells = Cells.uniform(GRID_PER_CELL, last - span["lo"] // step)
    starts = closing.groupBy(*keys).agg(F.min("g").alias("first"))
    held = previous(following(closing, keys, ["g"], ["g"], F.col("g"), cells), keys, ["g"], ["value"], F.col("g"), cells)
    spread = explode_range(
        held.join(starts, keys).select(
            *keys, "value", F.col("prev.value").alias("_before"), "first", F.col("g").alias("_g0"),
            F.coalesce(F.col("next.g") - 1, F.lit(last)).alias("_g1")),
        F.col("_g0"), F.col("_g1"), "g")
    return spread.select(*keys, "g", "value", F.when(
        F.col("g") == F.col("_g0"), F.col("_before")).otherwise(F.col("value")).alias("before"), "first")


def pair_ranges(ticks: DataFrame, multiplier: float = 1.2) -> DataFrame:
    """The value range of both members of every pair, fixed when the pair is created.

    A pair is created by the first tick of its newer symbol: that symbol's range comes from its
    first value, the other one's from its last value at that moment (arrival order ``seq``).
    """
    keys = kind_keys(ticks)
    firsts = ticks.groupBy(*keys, "symbol").agg(
        F.min("seq").alias("seq"), F.min_by("value", "seq").alias("value"))
    members = firsts.count()
    pairs = member_pairs(firsts, keys, "symbol", ["seq", "value"], max(8, blocks_for(members)))
    newer_is_0 = F.col("seq0") > F.col("seq1")
    asked = pairs.select(
        *keys, "id0", "id1", newer_is_0.alias("newer_is_0"),
        F.when(newer_is_0, F.col("id1")).otherwise(F.col("id0")).alias("symbol"),
        F.greatest("seq0", "seq1").alias("seq"),
        F.when(newer_is_0, F.col("value0")).otherwise(F.col("value1")).alias("newer_value"),
    )
    known = as_of(asked, ticks.select(*keys, "symbol", "seq", "value"), [*keys, "symbol"], ["seq"],
                  "value", F.col("seq"), out="older_value")
    v0 = F.when(F.col("newer_is_0"), F.col("newer_value")).otherwise(F.col("older_value"))
    v1 = F.when(F.col("newer_is_0"), F.col("older_value")).otherwise(F.col("newer_value"))
    return known.select(
        *keys, "id0", "id1",
        *[
            bound(v / multiplier, v * multiplier).alias(f"{name}{i}")
            for i, v in ((0, v0), (1, v1))
            for name, bound in (("lo", F.least), ("hi", F.greatest))
        ],
    )


def bin_of(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bin, clamped to the range; a range without width has one bin."""
    raw = F.floor((value - low) / F.when(high > low, high - low) * bins)
    return F.coalesce(F.greatest(F.least(raw, F.lit(bins - 1)), F.lit(0)), F.lit(0)).cast("int")


def discretize(
    ticks: DataFrame, interval: str = "10 seconds", bins: int = 30, multiplier: float = 1.2
) -> DataFrame:
    """Bins of both members of every pair at every grid point they share.

    Columns ``(id0, id1, g, x, y)``, x for id0 and y for id1.
    """
    return _binned(ticks, interval, bins, multiplier).drop("px", "py", "g0")


def _binned(ticks: DataFrame, interval: str, bins: int, multiplier: float) -> DataFrame:
    """``discretize`` with the bins ``px, py`` one grid point before (null at the pair's first, ``g0``).

    Samples are regular, so a symbol's value before is known before the pairs are made.
    """
    keys = kind_keys(ticks)
    ticks = materialize(ticks.select(*keys, "symbol", "ts", "seq", "value"))
    samples = materialize(_samples(ticks, interval))
    ranges = pair_ranges(ticks, multiplier)
    size = samples.groupBy(*keys, "symbol").count().agg(
        F.sum("count").alias("rows"), F.count(F.lit(1)).alias("members")).first()
    paired = member_pairs(samples, [*keys, "g"], "symbol", ["value", "before", "first"], blocks_for(size["members"]),
                          rows=size["rows"] or 0)
    shared = F.col("before0").isNotNull() & F.col("before1").isNotNull()

    def binned(name, i):
        return bin_of(F.col(f"{name}{i}"), F.col(f"lo{i}"), F.col(f"hi{i}"), bins)

    return paired.join(ranges, [*keys, "id0", "id1"]).select(
        *keys, "id0", "id1", "g", binned("value", 0).alias("x"), binned("value", 1).alias("y"),
        F.when(shared, binned("before", 0)).alias("px"), F.when(shared, binned("before", 1)).alias("py"),
        F.greatest("first0", "first1").alias("g0"))


def transitions(binned: DataFrame) -> DataFrame:
    """Add the bins of the previous grid point as ``px``/``py``; the first point has none."""
    if "px" in binned.columns:
        return binned
    keys = [*kind_keys(binned), "id0", "id1"]
    order = Window.partitionBy(*keys).orderBy("g")
    return binned.withColumns({"px": F.lag("x").over(order), "py": F.lag("y").over(order)})


def _tables(bins: int) -> Column:
    """The contingency tables of both directions: (weight into TE 0->1, into TE 1->0, key)."""
    px, py, x, y = F.col("px"), F.col("py"), F.col("x"), F.col("y")
    specs = [  # key columns, weight for id0 -> id1, weight for id1 -> id0
        ((y, py, px), 1, 0), ((x, px, py), 0, 1),
        ((py,), 1, 0), ((px,), 0, 1),
        ((px, py), -1, -1),
        ((y, py), -1, 0), ((x, px), 0, -1),
    ]

    def packed(columns):
        total = F.lit(0).cast("bigint")
        for column in columns:
            total = total * bins + column
        return total

    return F.array(*[
        F.struct(F.lit(i).alias("tab"), F.lit(w01).alias("w01"), F.lit(w10).alias("w10"),
                 packed(columns).alias("key"))
        for i, (columns, w01, w10) in enumerate(specs)])


def transfer_entropy_of_bins(binned: DataFrame, n_windows: int, bins: int, step: int) -> DataFrame:
    """Transfer entropy over all grid points of pairs with at least ``n_windows`` samples.

    One row per direction, id0 = source; exact zeros are not reported.
    """
    keys = kind_keys(binned)
    moves = transitions(binned).filter("px IS NOT NULL")

    def way(source, target, new, own, other):
        return F.struct(F.col(source).alias("s"), F.col(target).alias("t"), F.col(new).alias("new"),
                        F.col(own).alias("own"), F.col(other).alias("other"))

    states = moves.select(*keys, "g", F.explode(F.array(
        way("id0", "id1", "y", "py", "px"), way("id1", "id0", "x", "px", "py"))).alias("w")).groupBy(*keys, "w").agg(
        F.count(F.lit(1)).alias("n"), F.min("g").alias("g0"), F.max("g").alias("g1")).select(
        *keys, "w.*", "n", "g0", "g1")
    pair = [*keys, "s", "t"]

    def count_of(*names):
        return F.sum("n").over(Window.partitionBy(*pair, *names)).cast("double")

    counted = states.withColumns({
        "n_own": count_of("own"), "n_own_other": count_of("own", "other"), "n_new_own": count_of("own", "new")})
    quotient = (F.col("n") * F.col("n_own")) / (F.col("n_own_other") * F.col("n_new_own"))
    summed = counted.groupBy(*pair).agg(
        F.sum(F.col("n") * F.log2(quotient)).alias("total"), F.sum("n").alias("m"),
        F.min("g0").alias("g0"), F.max("g1").alias("g1"), F.bool_and(quotient == 1.0).alias("zero"))
    return summed.filter((F.col("m") + 1 >= n_windows) & ~F.col("zero")).select(
        *keys, F.col("s").alias("id0"), F.col("t").alias("id1"),
        from_micros((F.col("g0") - 1) * step).alias("window_start"),
        from_micros((F.col("g1") + 1) * step).alias("window_end"), (F.col("total") / F.col("m")).alias("value"))


def transfer_entropy(
    ticks: DataFrame, interval: str = "10 seconds", n_windows: int = 30, bins: int = 30,
    multiplier: float = 1.2,
) -> DataFrame:
    """Both directions of every warmed-up pair over all data; id0 = source, id1 = target."""
    binned = _binned(ticks, interval, bins, multiplier)
    return transfer_entropy_of_bins(binned, n_windows, bins, interval_micros(interval))


def primes_to(limit: int) -> list[int]:
    return [n for n in range(2, limit + 1) if all(n % d for d in range(2, math.isqrt(n) + 1))]


def prime_weights(limit: int) -> dict[int, list[int]]:
    """For every prime p up to ``limit`` the list of c times the power of p in c, for c = 0 ... limit."""
    out = {}
    for p in primes_to(limit):
        weights = []
        for c in range(limit + 1):
            power, rest = 0, c
            while rest and rest % p == 0:
                power, rest = power + 1, rest // p
            weights.append(c * power)
        out[p] = weights
    return out


def with_neighbours(rows: DataFrame, held: int, grid_per_cell: int) -> DataFrame:
    """Rows in the cell ``_cell`` of their grid point and, near its ends, in the next cell as well.

    A window over ``held`` grid points either way then sees all it needs within one cell; ``_own``
    marks the row's home.
    """
    cell, place = F.floor(F.col("g") / grid_per_cell), F.pmod(F.col("g"), F.lit(grid_per_cell))
    cells = F.array_compact(F.array(
        cell, F.when(place < held, cell - 1), F.when(place >= grid_per_cell - held, cell + 1)))
    return rows.withColumn("_home", cell).withColumn("_cell", F.explode(cells)).withColumn(
        "_own", F.col("_cell") == F.col("_home")).drop("_home")


def transfer_entropy_sliding(
    ticks: DataFrame, interval: str = "10 seconds", n_windows: int = 30, bins: int = 30,
    multiplier: float = 1.2, grid_per_cell: int = GRID_PER_CELL,
) -> DataFrame:
    """Transfer entropy over the last ``n_windows`` samples, re-evaluated at every grid point.

    A count that goes from c to c+1 changes its table's sum of ``c*log2(c)`` by whole numbers of
    logarithms of primes. Every transition gives that change once when it enters and once when it
    leaves; running sums of integers turn the changes into window values without copies per window
    and without rounding, and exact zeros are not reported. Windows and sums are split by cells of
    ``grid_per_cell`` grid points, of which a window may not be longer.
    """
    step = interval_micros(interval)
    held = n_windows - 1  # transitions between n_windows samples
    grid_per_cell = max(grid_per_cell, held + 1)
    binned = materialize(_binned(ticks, interval, bins, multiplier))
    keys = [*kind_keys(binned), "id0", "id1"]
    span = binned.agg(F.min("g").alias("lo"), F.max("g").alias("hi")).first()
    if held < 1 or span["lo"] is None:
        return transfer_entropy_of_bins(binned.filter("false"), n_windows, bins, step)
    cells = Cells.uniform(grid_per_cell, span["hi"] - span["lo"])

    tabled = binned.filter("px IS NOT NULL").select(*keys, "g", "g0", F.explode(_tables(bins)).alias("e"))
    placed = tabled.withColumns({"_cell": F.lit(0), "_own": F.lit(True)}) if cells.single else with_neighbours(
        tabled, held, grid_per_cell)
    same = Window.partitionBy(*keys, "e.tab", "e.key", "_cell").orderBy("g")
    before = F.count(F.lit(1)).over(same.rangeBetween(-held, -1))
    until = F.count(F.lit(1)).over(same.rangeBetween(0, held))
    changed = placed.withColumns({"before": before, "until": until}).filter("_own")
    moved = changed.select(*keys, "g0", "e", F.explode(F.array(
        F.struct(F.col("g"), F.lit(True).alias("enters"), F.col("before").alias("c"), (F.col("before") + 1).alias("d")),
        F.struct((F.col("g") + held).alias("g"), F.lit(False).alias("enters"), F.col("until").alias("c"),
                 (F.col("until") - 1).alias("d")))).alias("s"))
    # a transition enters before the oldest one leaves, so counts reach held + 1 in between
    sums, names, weights_of = [], [], prime_weights(held + 1)
    for p, weights in weights_of.items():
        table = F.array(*[F.lit(w).cast("bigint") for w in weights])
        change = F.element_at(table, (F.col("s.d") + 1).cast("int")) - F.element_at(table, (F.col("s.c") + 1).cast("int"))
        for way in ("w01", "w10"):
            names.append(f"{way}_{p}")
            sums.append(F.sum(F.col(f"e.{way}") * change).alias(names[-1]))
    merged = moved.groupBy(*keys, F.col("s.g").alias("g")).agg(
        *sums, F.bool_or("s.enters").alias("point"), F.max("g0").alias("g0"))
    running = running_sums(merged, keys, ["g"], names, F.col("g"), cells, "f")
    full = running.filter(F.col("point") & (F.col("g") - F.col("g0") + 1 >= n_windows))

    def way(source, target, name):
        own = [(p, F.col(f"f.{name}_{p}")) for p in weights_of]
        total, some = F.lit(0.0), F.lit(False)
        for p, amount in own:
            total, some = total + amount * F.lit(math.log2(p)), some | (amount != 0)
        return F.when(some, F.struct(F.col(source).alias("id0"), F.col(target).alias("id1"),
                                     (total / held).alias("value")))

    both = full.withColumn("_d", F.explode(F.array_compact(F.array(
        way("id0", "id1", "w01"), way("id1", "id0", "w10")))))
    return both.select(
        *kind_keys(binned), "_d.id0", "_d.id1", from_micros((F.col("g") - held) * step).alias("window_start"),
        from_micros((F.col("g") + 1) * step).alias("window_end"), "_d.value")
