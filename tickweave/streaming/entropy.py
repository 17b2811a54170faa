"""Transfer entropy over a stream of ticks, in Spark's own keyed state.

As in the correlation stream, symbols fall into blocks by a hash and a state key is a pair of
blocks. A key keeps, for each symbol, the ticks of basic windows that are still open and a ring of
the last samples, and for each pair its value ranges. An event-time timer closes a basic window once
the watermark has reached its end, and every warmed-up pair is evaluated then.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickweave.functions.cells import from_micros, interval_micros, micros
from tickweave.operators.correlation import kind_keys
from tickweave.session import ship_code, use_rocksdb

BLOCKS = 4
PAIRS_PER_STEP = 1024


def matches(*states: np.ndarray) -> np.ndarray:
    """For each row and column, how many columns of the row have the same states."""
    same = np.ones((*states[0].shape, states[0].shape[1]), bool)
    for state in states:
        same &= state[:, :, None] == state[:, None, :]
    return same.sum(axis=2)


def directed_entropy(own: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Transfer entropy from ``other`` to ``own``, a row of bins a pair, and whether it is not zero.

    It is the mean logarithm of a quotient of counts; it is zero where all quotients are one.
    """
    new, now, beside = own[:, 1:], own[:, :-1], other[:, :-1]
    above = matches(new, now, beside) * matches(now)
    below = matches(now, beside) * matches(new, now)
    return np.log2(above / below).mean(axis=1), (above != below).any(axis=1)


class _Pairs(StatefulProcessor):
    """``symbols``: block, first and last arrival, ring of samples and unsampled ticks of a symbol.
    ``ranges``: the bounds of both members of a pair, fixed when the newer one's first tick comes."""

    def __init__(self, step: int, n_windows: int, bins: int, multiplier: float):
        self.step, self.n, self.bins, self.multiplier = step, n_windows, bins, multiplier

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.symbols = handle.getMapState(
            "symbols", "symbol string",
            "block int, first long, last long, value double, ring array<double>, ts array<long>, seq array<long>, ticks array<double>")
        self.ranges = handle.getMapState("ranges", "id0 string, id1 string", "lo0 double, hi0 double, lo1 double, hi1 double")
        self.progress = handle.getValueState("progress", "next long, timer long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # pairs are created in arrival order: one row a symbol and the few arrivals that create them matter
        *_, left, right = key
        known = {name[0]: list(state) for name, state in self.symbols.iterator()}
        arrived: list[pd.DataFrame] = [chunk for chunk in rows if len(chunk)]
        if not arrived:
            return iter(())
        batch = pd.concat(arrived).sort_values("seq", kind="stable")
        firsts = batch[~batch["symbol"].isin(known)].drop_duplicates("symbol")
        series = {name: (part["seq"].to_numpy(np.int64), part["value"].to_numpy(float))
                  for name, part in batch.groupby("symbol", sort=False)}
        blocks = {**{name: state[0] for name, state in known.items()},
                  **dict(zip(batch["symbol"], batch["block"].astype(int)))}
        present = dict.fromkeys(known)
        for name, seq, value in zip(firsts["symbol"], firsts["seq"], firsts["value"]):
            for other in present:
                if {blocks[name], blocks[other]} == {left, right}:
                    self.create(name, float(value), other, self.value_at(other, int(seq), known, series))
            present[name] = None
        for name, part in batch.groupby("symbol", sort=False):
            at, seq = part["at"].to_numpy(np.int64), part["seq"].to_numpy(np.int64)
            value = part["value"].to_numpy(float)
            state = known.get(name) or [blocks[name], int(seq[0]), -1, float(value[0]), [], [], [], []]
            if seq[-1] >= state[2]:
                state[2], state[3] = int(seq[-1]), float(value[-1])
            state[5], state[6], state[7] = (list(old) + new.tolist() for old, new in zip(state[5:], (at, seq, value)))
            self.symbols.updateValue((name,), tuple(state))
        earliest = int(batch["at"].min()) // self.step
        following, timer = self.progress.get() if self.progress.exists() else (earliest, -1)
        self.wake(min(following, earliest) if timer < 0 and not known else following, timer)
        return iter(())

    @staticmethod
    def value_at(name: str, seq: int, known: dict, series: dict) -> float:
        """The symbol's last value that had arrived by ``seq``."""
        if name in series:
            place = int(np.searchsorted(series[name][0], seq, "right"))
            if place:
                return float(series[name][1][place - 1])
        return known[name][3]

    def create(self, newer: str, newer_value: float, older: str, older_value: float) -> None:
        pair = sorted(((newer, newer_value), (older, older_value)))
        bounds = [b for _, v in pair for b in sorted((v / self.multiplier, v * self.multiplier))]
        self.ranges.updateValue((pair[0][0], pair[1][0]), tuple(bounds))

    def wake(self, following: int, timer: int) -> None:
        wanted = -((following + 1) * self.step // -1000)
        if timer != wanted:
            if timer >= 0:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(wanted)
        self.progress.update((int(following), int(wanted)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        *kind, left, right = key
        last = timerValues.getCurrentWatermarkInMs() * 1000 // self.step - 1
        following = int(self.progress.get()[0])
        state = {name[0]: list(found) for name, found in self.symbols.iterator()}
        sampled = {}
        for name, found in state.items():
            sampled[name] = self.sample(found, following, last)
            self.symbols.updateValue((name,), tuple(found))
        ranges = [(pair, bounds) for pair, bounds in self.ranges.iterator()]
        for low in range(0, len(ranges), PAIRS_PER_STEP):
            part = ranges[low:low + PAIRS_PER_STEP]
            for g in range(following, last + 1):
                yield from self.evaluate(kind, part, sampled, g, g - following)
        if last >= following:
            following = last + 1
        self.progress.update((following, -1))
        # symbols go on with their last value, so there is a next window as long as there is a symbol
        self.wake(following, -1)

    def sample(self, state: list, first: int, last: int) -> np.ndarray:
        """The ring before ``first`` and the samples up to ``last``; ``state`` keeps the newest ring.

        NaN stands where the symbol had no tick yet.
        """
        at, seq, value = (np.array(state[i], kind) for i, kind in ((5, np.int64), (6, np.int64), (7, float)))
        order = np.lexsort((seq, at))
        at, seq, value = at[order], seq[order], value[order]
        g = at // self.step
        ring = np.r_[np.full(self.n - len(state[4]), np.nan), np.array(state[4], float)][-self.n:]
        out = np.r_[ring, np.full(max(0, last - first + 1), np.nan)]
        now, done = ring[-1], 0
        for i, window in enumerate(range(first, last + 1)):
            upto = int(np.searchsorted(g, window, "right"))
            if upto > done:
                now, done = value[upto - 1], upto
            out[self.n + i] = now
        state[4] = [float(v) for v in out[-self.n:] if not np.isnan(v)]
        for i, kept in ((5, at), (6, seq), (7, value)):
            state[i] = kept[done:].tolist()
        return out

    def evaluate(self, kind: list, part: list, sampled: dict, g: int, offset: int) -> Iterator[pd.DataFrame]:
        window = slice(offset + 1, offset + 1 + self.n)
        ready = [(pair, bounds) for pair, bounds in part
                 if not np.isnan(sampled[pair[0]][window][0]) and not np.isnan(sampled[pair[1]][window][0])]
        if not ready or self.n < 2:
            return
        bounds = np.array([b for _, b in ready], float)
        bins = []
        for i in (0, 1):
            values = np.array([sampled[pair[i]][window] for pair, _ in ready])
            low, high = bounds[:, 2 * i, None], bounds[:, 2 * i + 1, None]
            width = np.where(high > low, high - low, np.nan)
            raw = np.floor((values - low) / width * self.bins)
            bins.append(np.where(np.isnan(raw), 0, np.clip(raw, 0, self.bins - 1)).astype(int))
        for source, target, own, other in ((0, 1, bins[1], bins[0]), (1, 0, bins[0], bins[1])):
            value, some = directed_entropy(own, other)
            rows = [(*kind, ready[i][0][source], ready[i][0][target], g, value[i]) for i in np.flatnonzero(some)]
            if rows:
                yield pd.DataFrame(rows, columns=[*["kind"][:len(kind)], "id0", "id1", "g", "value"])

    def close(self) -> None:
        pass


def transfer_entropy_stream(
    ticks: DataFrame,
    interval: str = "10 seconds",
    n_windows: int = 30,
    bins: int = 30,
    multiplier: float = 1.2,
    lateness: str = "0 seconds",
    blocks: int = BLOCKS,
) -> DataFrame:
    """``transfer_entropy_sliding`` as basic windows close: ``(id0, id1, window_start, window_end, value)``.

    A basic window closes when the newest time, less ``lateness`` and a millisecond, has reached its
    end; a symbol without a tick in it keeps its last value. Ticks later than that are dropped.
    Exact zeros are not reported. ``seq`` has to follow the arrival, as it decides what the ranges of
    a new pair are taken from.
    """
    spark = ticks.sparkSession
    ship_code(spark)
    use_rocksdb(spark)
    keys = kind_keys(ticks)
    step = interval_micros(interval)
    delay = f"{interval_micros(lateness) // 1000 + 1} milliseconds"
    block = F.pmod(F.xxhash64("symbol"), F.lit(blocks)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    routed = ticks.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay).select(
        *keys, "symbol", "ts", micros("ts").alias("at"), F.col("seq").cast("long").alias("seq"),
        F.col("value").cast("double").alias("value"), block.alias("block"), other.alias("_other")).select(
        *keys, F.least("block", "_other").alias("left"), F.greatest("block", "_other").alias("right"),
        "block", "symbol", "ts", "at", "seq", "value")
    kind = "kind string, " if keys else ""
    found = routed.groupBy(*keys, "left", "right").transformWithStateInPandas(
        statefulProcessor=_Pairs(step, n_windows, bins, multiplier),
        outputStructType=f"{kind}id0 string, id1 string, g long, value double",
        outputMode="Append", timeMode="EventTime")
    return found.select(
        *keys, "id0", "id1", from_micros((F.col("g") - (n_windows - 1)) * step).alias("window_start"),
        from_micros((F.col("g") + 1) * step).alias("window_end"), "value")
