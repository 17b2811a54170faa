"""Sliding correlation over a stream of ticks, in Spark's own keyed state.

Symbols fall into blocks by a hash, and a state key is a pair of blocks: a tick goes to the keys of
its block, so a key has the ticks of all its pairs. Late and unordered ticks are put in order there,
and an event-time timer closes windows once the watermark has reached their end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickweave.functions.cells import from_micros, interval_micros, micros
from tickweave.operators.correlation import kind_keys, scaled_value
from tickweave.session import ship_code, use_rocksdb

BLOCKS = 4


def interval_ranges(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last interval between the times ``b`` that overlaps each interval between ``a``."""
    return np.searchsorted(b[1:], a[:-1], "right"), np.searchsorted(b[:-1], a[1:], "left") - 1


class Series:
    """The ordered ticks of one symbol and, for each window asked for, the intervals that end in it."""

    def __init__(self, block: int, name: str, times: np.ndarray, values: np.ndarray,
                 starts: np.ndarray, size: int):
        self.block, self.name, self.times, self.values = block, name, times, values
        self.deltas = np.diff(values)
        self.low = np.searchsorted(times[1:], starts, "left")
        self.high = np.searchsorted(times[1:], starts + size, "left")
        self.squares = np.array([float(self.deltas[i:j] @ self.deltas[i:j])
                                 for i, j in zip(self.low, self.high)])


def correlations(one: Series, two: Series) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the windows in which both series move, and the correlation in each.

    The changes of ``two`` over consecutive intervals add up to a difference of two of its values,
    so a product sum needs no running sums and keeps whole prices exact.
    """
    windows = np.flatnonzero((one.squares > 0) & (two.squares > 0))
    first, last = interval_ranges(one.times, two.times)
    found = np.zeros(len(windows))
    for place, k in enumerate(windows):
        own = slice(one.low[k], one.high[k])
        begin, end = np.maximum(first[own], two.low[k]), np.minimum(last[own], two.high[k] - 1)
        meets = begin <= end
        moved = two.values[end[meets] + 1] - two.values[begin[meets]]
        norm = np.sqrt(one.squares[k]) * np.sqrt(two.squares[k])
        found[place] = np.clip(float(one.deltas[own][meets] @ moved) / norm, -1.0, 1.0)
    return windows, found


class _BlockPair(StatefulProcessor):
    """The ticks of two blocks that open windows still need, and the next window to close.

    ``series`` maps (block, symbol, time bucket) to the ordered ticks in that bucket; a bucket is as
    long as a window, so closing windows reads the buckets of open windows only. The last tick before
    the open windows stays, because the first interval begins there.
    """

    def __init__(self, origin: int, size: int, advance: int):
        self.origin, self.size, self.advance = origin, size, advance

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.series = handle.getMapState(
            "series", "block int, symbol string, bucket long", "ts array<long>, seq array<long>, value array<double>")
        self.progress = handle.getValueState("progress", "next long, timer long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        # a bucket is read and written once a micro-batch, not once for each of its Arrow batches
        arrived = [chunk for chunk in rows if len(chunk)]
        earliest = None
        if arrived:
            batch = pd.concat(arrived)
            at = batch["at"].to_numpy(np.int64)
            earliest = at.min()
            parts = batch.assign(bucket=at // self.size).groupby(["block", "symbol", "bucket"], sort=False)
            for (block, symbol, bucket), part in parts:
                self.store((int(block), symbol, int(bucket)), part["at"].to_numpy(np.int64),
                           part["seq"].to_numpy(np.int64), part["value"].to_numpy(float))
        if earliest is not None:
            known = self.progress.get() if self.progress.exists() else (0, -1)
            self.wake(int(known[0]), int(known[1]), int(earliest))
        yield from ()

    def store(self, place: tuple, at: np.ndarray, seq: np.ndarray, value: np.ndarray) -> None:
        """Merge ticks into a bucket; of several at one time the first arrival stays."""
        if self.series.containsKey(place):
            old = self.series.getValue(place)
            at, seq = np.r_[np.array(old[0], np.int64), at], np.r_[np.array(old[1], np.int64), seq]
            value = np.r_[np.array(old[2], float), value]
        order = np.lexsort((seq, at))
        order = order[np.r_[True, np.diff(at[order]) > 0]]
        self.series.updateValue(place, (at[order].tolist(), seq[order].tolist(), value[order].tolist()))

    def wake(self, following: int, timer: int, earliest: int) -> None:
        """Have the timer at the end of the first open window that holds ``earliest`` or later ticks."""
        window = max(following, (earliest - self.size - self.origin) // self.advance + 1)
        wanted = -((self.origin + window * self.advance + self.size) // -1000)
        if timer < 0 or wanted < timer:
            if timer >= 0:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(wanted)
            timer = wanted
        self.progress.update((following, timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        reached = timerValues.getCurrentWatermarkInMs() * 1000
        following = int(self.progress.get()[0])
        last = (reached - self.size - self.origin) // self.advance
        held: dict[tuple, list] = {}
        for place, ticks in self.series.iterator():
            held.setdefault((place[0], place[1]), []).append((place[2], ticks))
        merged = {}
        for name, parts in held.items():
            parts.sort(key=lambda part: part[0])
            merged[name] = tuple(np.concatenate([np.array(ticks[i], kind) for _, ticks in parts])
                                 for i, kind in ((0, np.int64), (1, np.int64), (2, float)))
        if last >= following:
            yield from self.closed(key, merged, following, last)
            following = max(following, last + 1)
            self.evict(held, merged, self.origin + following * self.advance)
        open_from = self.origin + following * self.advance
        later = [at[at >= open_from][0] for at, _, _ in merged.values() if len(at) and at[-1] >= open_from]
        self.progress.update((following, -1))
        if later:
            self.wake(following, -1, int(min(later)))

    def closed(self, key, merged: dict, first: int, last: int) -> Iterator[pd.DataFrame]:
        """Correlations of the windows ``first`` to ``last``; only those with an interval's end count."""
        ends = np.unique(np.concatenate([at[1:] for at, _, _ in merged.values()] or [np.zeros(0, np.int64)]))
        low = np.maximum((ends - self.size - self.origin) // self.advance + 1, first)
        high = np.minimum((ends - self.origin) // self.advance, last)
        windows: list[np.ndarray] = []
        done = first - 1
        for a, b in zip(low, high):
            if b > done and b >= a:
                windows.append(np.arange(max(a, done + 1), b + 1))
                done = b
        if not windows:
            return
        numbers = np.concatenate(windows)
        starts = self.origin + numbers * self.advance
        series = [Series(block, name, at, value, starts, self.size)
                  for (block, name), (at, _, value) in sorted(merged.items()) if len(at) > 1]
        *kind, left, right = key
        for i, one in enumerate(series):
            if one.block != left:
                continue
            rows = []
            for j, two in enumerate(series):
                if two.block != right or (left == right and j <= i):
                    continue
                at, values = correlations(one, two)
                names = sorted((one.name, two.name))
                rows.append(pd.DataFrame({
                    **dict(zip(["kind"], kind)), "id0": names[0], "id1": names[1], "start": starts[at],
                    "value": values}))
            if rows:
                yield pd.concat(rows)

    def evict(self, held: dict, merged: dict, open_from: int) -> None:
        """Keep the ticks from ``open_from`` on and each symbol's last one before."""
        for (block, symbol), parts in held.items():
            at = merged[block, symbol][0]
            keep = max(0, int(np.searchsorted(at, open_from, "left")) - 1)
            for bucket, ticks in parts:
                own = np.array(ticks[0], np.int64)
                cut = int(np.searchsorted(own, at[keep], "left"))
                if cut == len(own):
                    self.series.removeKey((block, symbol, bucket))
                elif cut:
                    self.series.updateValue((block, symbol, bucket), tuple(list(x)[cut:] for x in ticks))

    def close(self) -> None:
        pass


def hy_correlation_stream(
    ticks: DataFrame,
    size: str = "30 seconds",
    advance: str = "1 second",
    origin=0,
    lateness: str = "0 seconds",
    scale: int | None = None,
    blocks: int = BLOCKS,
) -> DataFrame:
    """The correlation of every window as it closes: ``(id0, id1, window_start, window_end, value)``.

    Window k starts at ``origin`` (microseconds since the epoch) plus k advances and closes when the
    newest time, less ``lateness`` and a millisecond, has reached its end. Ticks that are late by no
    more than ``lateness`` take their place in time order; later ones are dropped. Of several ticks
    of a symbol at one time the one with the smallest ``seq`` counts.
    """
    spark = ticks.sparkSession
    ship_code(spark)
    use_rocksdb(spark)
    keys = kind_keys(ticks)
    delay = f"{interval_micros(lateness) // 1000 + 1} milliseconds"
    block = F.pmod(F.xxhash64("symbol"), F.lit(blocks)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    routed = ticks.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay).select(
        *keys, "symbol", "ts", micros("ts").alias("at"), F.col("seq").cast("long").alias("seq"),
        scaled_value(scale).alias("value"), block.alias("block"), other.alias("_other")).select(
        *keys, F.least("block", "_other").alias("left"), F.greatest("block", "_other").alias("right"),
        "block", "symbol", "ts", "at", "seq", "value")
    kind = "kind string, " if keys else ""
    found = routed.groupBy(*keys, "left", "right").transformWithStateInPandas(
        statefulProcessor=_BlockPair(int(origin), interval_micros(size), interval_micros(advance)),
        outputStructType=f"{kind}id0 string, id1 string, start long, value double",
        outputMode="Append", timeMode="EventTime")
    return found.select(
        *keys, "id0", "id1", from_micros("start").alias("window_start"),
        from_micros(F.col("start") + interval_micros(size)).alias("window_end"), "value")
