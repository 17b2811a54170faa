"""Keyed state: edge changes and the change filter over streams of pairwise results."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickweave.functions.cells import from_micros, interval_micros, micros
from tickweave.functions.sizing import at_most
from tickweave.operators.change import moved_positions
from tickweave.operators.graph import canonical_edge
from tickweave.operators.params import STEP_CHANGES, with_parameter
from tickweave.session import ship_code, use_rocksdb


def prepared(spark) -> None:
    """What a stream with a processor of this package needs of its session."""
    ship_code(spark)
    use_rocksdb(spark)


class _Crossing(StatefulProcessor):
    """Keeps whether the edge exists."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("present", T.StructType([T.StructField("present", T.BooleanType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        # several results of one time count as one: above if any is
        batch = pd.concat(list(rows)).groupby("ts", sort=True, as_index=False).agg(
            {"v0": "first", "v1": "first", "is_add": "max"})
        present = bool(self.state.get()[0]) if self.state.exists() else False
        before = batch["is_add"].shift(1, fill_value=present)
        self.state.update((bool(batch["is_add"].iloc[-1]),))
        yield batch[batch["is_add"] != before][["v0", "v1", "ts", "is_add"]]

    def close(self) -> None:
        pass


def edge_changes_stream(results: DataFrame, threshold: float = 0.7, time: str = "window_end") -> DataFrame:
    """Add/delete events of a stream of pairwise results."""
    prepared(results.sparkSession)
    v0, v1 = canonical_edge("id0", "id1")
    flags = results.filter(F.col("value").isNotNull()).select(
        v0.alias("v0"), v1.alias("v1"), F.col(time).cast("timestamp").alias("ts"),
        (F.abs("value") >= threshold).alias("is_add"))
    return flags.groupBy("v0", "v1").transformWithStateInPandas(
        statefulProcessor=_Crossing(),
        outputStructType="v0 string, v1 string, ts timestamp, is_add boolean",
        outputMode="Append", timeMode="None")


CHANGE = np.dtype([("at", np.int64), ("seq", np.int64), ("value", np.float64)])


class _Thresholds(StatefulProcessor):
    """A share of the pairs with the threshold changes that hold for all of them.

    ``pending`` has results newer than the watermark, ``present`` the edges that exist, ``changes``
    the thresholds from the one in force at the watermark on, in time order.
    """

    def __init__(self, default: float):
        self.default = default

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        pair = "v0 string, v1 string"
        self.pending = handle.getMapState("pending", pair, "at array<long>, value array<double>")
        self.present = handle.getMapState("present", pair, "present boolean")
        self.changes = handle.getValueState("changes", "at array<long>, seq array<long>, value array<double>")
        self.timer = handle.getValueState("timer", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # the changes and a pair's results are read and written once a micro-batch, not for each Arrow batch
        changes, results = [], []
        for chunk in rows:
            if len(chunk):
                changed = chunk["v0"].isna()
                news = np.empty(int(changed.sum()), CHANGE)
                for name in CHANGE.names:
                    news[name] = chunk.loc[changed, name]
                changes.append(news)
                results.append(chunk.loc[~changed, ["v0", "v1", "at", "value"]])
        earliest = None
        if results:
            for pair, part in pd.concat(results).groupby(["v0", "v1"], sort=False):
                old = self.pending.getValue(pair) if self.pending.containsKey(pair) else ([], [])
                self.pending.updateValue(pair, ([*old[0], *part["at"].tolist()], [*old[1], *part["value"].tolist()]))
                first = int(part["at"].min())
                earliest = first if earliest is None else min(first, earliest)
        if earliest is not None:
            self.wake(earliest)
        # without results that wait for the watermark nothing else would ever let changes go
        watermark = timerValues.getCurrentWatermarkInMs() if timerValues else 0
        idle = not self.timer.exists() or int(self.timer.get()[0]) > watermark
        if changes:
            self.store(np.concatenate(changes), watermark * 1000 if idle else 0)
        return iter(())

    def known(self) -> np.ndarray:
        columns = self.changes.get() if self.changes.exists() else ([], [], [])
        found = np.empty(len(columns[0]), CHANGE)
        for name, column in zip(CHANGE.names, columns):
            found[name] = column
        return found

    def store(self, news: np.ndarray, reached: int) -> None:
        """Merge changes, of several at one time the last; those before the one in force at ``reached`` go."""
        merged = np.sort(np.concatenate((self.known(), news)), order=CHANGE.names)
        merged = merged[np.r_[merged["at"][1:] != merged["at"][:-1], True]] if len(merged) else merged
        kept = merged[max(0, int(np.searchsorted(merged["at"], reached, "right")) - 1):]
        if len(news) or len(kept) < len(merged):
            self.changes.update(tuple(kept[name].tolist() for name in CHANGE.names))

    def limits(self, times: np.ndarray) -> np.ndarray:
        """The threshold at each of ``times``; a change at a time holds for it already."""
        known = self.known()
        return np.r_[self.default, known["value"]][np.searchsorted(known["at"], times, "right")]

    def wake(self, at: int) -> None:
        wanted = -(at // -1000)
        known = int(self.timer.get()[0]) if self.timer.exists() else None
        if known is None or wanted < known:
            if known is not None:
                self.handle.deleteTimer(known)
            self.handle.registerTimer(wanted)
            self.timer.update((wanted,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        reached = timerValues.getCurrentWatermarkInMs() * 1000
        self.timer.clear()
        waiting = list(self.pending.iterator())
        times = np.unique(np.array([t for _, (at, _) in waiting for t in at if t <= reached], np.int64))
        limits = dict(zip(times.tolist(), self.limits(times).tolist()))
        out, later = [], []
        for pair, (at, value) in waiting:
            above: dict[int, bool] = {}
            for t, v in zip(at, value):
                if t <= reached:
                    # the changes at the result's own time hold already; several results count as one
                    above[t] = above.get(t, False) or v >= limits[t]
            present = bool(self.present.getValue(pair)[0]) if self.present.containsKey(pair) else False
            for t in sorted(above):
                if above[t] != present:
                    present = above[t]
                    out.append((*pair, t, present))
            self.present.updateValue(pair, (present,))
            rest = [(t, v) for t, v in zip(at, value) if t > reached]
            if rest:
                self.pending.updateValue(pair, tuple(list(x) for x in zip(*rest)))
                later.append(min(t for t, _ in rest))
            else:
                self.pending.removeKey(pair)
        self.store(np.empty(0, CHANGE), reached)
        if later:
            self.wake(min(later))
        if out:
            yield pd.DataFrame(out, columns=["v0", "v1", "at", "is_add"])

    def close(self) -> None:
        pass


def edge_changes_with_parameter_stream(
    results: DataFrame, param_log: DataFrame, name: str = "correlationThreshold", default: float = 0.7,
    time: str = "window_end", lateness: str = "0 seconds", shares: int = 16,
) -> DataFrame:
    """``edge_changes`` of a stream of pairwise results whose threshold changes by a stream
    ``param_log(name, value, ts, seq)``.

    A change holds for results at or after its time, the last of several at one time. Pairs are
    dealt to ``shares`` by a hash and every change goes to all of them. A result counts once the
    newest time of either stream, less ``lateness`` and a millisecond, has reached its own; rows
    that come later than that are dropped.
    """
    prepared(results.sparkSession)
    v0, v1 = canonical_edge("id0", "id1")
    pairs = results.filter(F.col("value").isNotNull()).select(
        v0.alias("v0"), v1.alias("v1"), F.col(time).cast("timestamp").alias("ts"), F.lit(0).cast("long").alias("seq"),
        F.abs("value").alias("value"), F.pmod(F.xxhash64(v0, v1), F.lit(shares)).cast("int").alias("share"))
    nobody = F.lit(None).cast("string")
    news = param_log.filter((F.col("name") == name) & F.col("value").isNotNull()).select(
        nobody.alias("v0"), nobody.alias("v1"), F.col("ts").cast("timestamp").alias("ts"),
        F.col("seq").cast("long").alias("seq"), F.col("value").cast("double").alias("value"),
        F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"))
    both = pairs.unionByName(news).withWatermark("ts", f"{interval_micros(lateness) // 1000 + 1} milliseconds")
    found = both.withColumn("at", micros("ts")).groupBy("share").transformWithStateInPandas(
        statefulProcessor=_Thresholds(float(default)),
        outputStructType="v0 string, v1 string, at long, is_add boolean", outputMode="Append", timeMode="EventTime")
    return found.select("v0", "v1", from_micros("at").alias("ts"), "is_add")


class _Moved(StatefulProcessor):
    """Keeps the last remembered value."""

    def __init__(self, order: str, value: str, rel: float):
        self.order, self.value, self.rel = order, value, rel

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("last", T.StructType([T.StructField("last", T.DoubleType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values([self.order, self.value], kind="stable")
        last = self.state.get()[0] if self.state.exists() else None
        moved, last = moved_positions(batch[self.value].to_numpy(), last, self.rel)
        if last is not None:
            self.state.update((float(last),))
        out = batch.iloc[moved]
        yield out[out[self.value] != 0]

    def close(self) -> None:
        pass


def emit_on_change_stream(
    df: DataFrame, keys: list[str], order: str, value: str = "value", rel: float = 0.01
) -> DataFrame:
    """Rows of a stream whose value moved by more than ``rel`` since the last remembered one.

    Nulls, NaN and ties are treated as in ``emit_on_change``.
    """
    prepared(df.sparkSession)
    df = df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    return df.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=_Moved(order, value, rel), outputStructType=df.schema,
        outputMode="Append", timeMode="None")


class _Member(StatefulProcessor):
    """Keeps whether the key is a member; passes rows that arrive while it is."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("member", T.StructType([T.StructField("member", T.BooleanType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows))
        batch = batch.assign(_row=batch["is_add"].isna()).sort_values(["ts", "_row"], kind="stable")
        first = bool(self.state.get()[0]) if self.state.exists() else False
        member = batch["is_add"].ffill().fillna(first).astype(bool)
        self.state.update((bool(member.iloc[-1]),))
        yield batch[batch["_row"] & member].drop(columns=["_row", "is_add"])

    def close(self) -> None:
        pass


def filter_members_stream(rows: DataFrame, commands: DataFrame, keys: list[str]) -> DataFrame:
    """Stream rows whose key is a member, from a stream of ``(keys, ts, is_add)`` commands.

    A command takes part in the micro-batch it arrives in and in all later ones.
    """
    prepared(rows.sparkSession)
    both = rows.withColumn("is_add", F.lit(None).cast("boolean")).unionByName(
        commands.select(*keys, "ts", "is_add"), allowMissingColumns=True)
    return both.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=_Member(), outputStructType=rows.schema, outputMode="Append", timeMode="None")


def top_hubs_stream(updates: DataFrame, every: str = "10 seconds", lateness: str = "10 seconds") -> DataFrame:
    """The latest count of every node per closed period.

    ``top_hubs_ranked_stream`` goes on from here to ranked lists.
    """
    return (
        updates.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
        .groupBy(F.window("ts", every).alias("w"), "node")
        .agg(F.max_by("visits", "seq").alias("visits"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "node", "visits")
    )


HUBS = "window_start timestamp, window_end timestamp, k int, rank int, node string, visits long"
HUB_COLUMNS = [part.split(" ")[0] for part in HUBS.split(", ")]


def _best(*keys: str):
    """For ``mapInArrow``: the best ``k`` rows of each group with equal ``keys``, kept while batches
    pass; a group has all of its rows in one partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple, tuple] = {}
        kinds = None
        for batch in batches:
            kinds = kinds or {name: batch.schema.field(name).type for name in HUB_COLUMNS if name != "rank"}
            groups = pa.Table.from_batches([batch]).group_by(list(keys)).aggregate([]).to_pylist()
            for group in groups:
                part = batch
                for name in keys:
                    part = part.filter(pc.equal(part[name], pa.scalar(group[name], part[name].type)))
                key = tuple(group[name] for name in keys)
                size, rows = part["k"][0].as_py(), best.get(key, (0, 0, []))[2]
                if not part["visits"].null_count and 0 < size < len(part) and all(v == v for v, _ in rows):
                    visits = part["visits"].to_numpy()
                    part = part.filter(pa.array(visits >= np.partition(visits, -size)[-size]))
                # a missing count is NaN, as in a pandas column
                found = [(float("nan") if v is None else -v, node)
                         for v, node in zip(part["visits"].to_pylist(), part["node"].to_pylist())]
                best[key] = size, part["window_end"][0].as_py(), heapq.nsmallest(size, [*rows, *found])
        for key, (size, end, rows) in sorted(best.items(), key=lambda group: group[0]):
            if rows:
                n, visits = len(rows), [-v if v == v else None for v, _ in rows]
                columns = [[key[0]] * n, [end] * n, [size] * n, range(1, n + 1), [node for _, node in rows], visits]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kinds.get(name, pa.int32())) for name, column in zip(HUB_COLUMNS, columns)],
                    names=HUB_COLUMNS)

    return run


def top_hubs_ranked_stream(
    updates: DataFrame, k: int = 10, every: str = "10 seconds", lateness: str = "10 seconds",
    k_log: DataFrame | None = None, name: str = "hubListSize", shares: int = 16,
) -> DataFrame:
    """``top_hubs_windowed`` as periods close: ``(window_start, window_end, rank, node, visits)``.

    The latest counts of a closed period come in one micro-batch, so ranking them needs no state. Nodes
    are dealt to ``shares`` by a hash, each share passes its ``k`` best on, and those are ranked by
    period; no task sees more than a share of a period's nodes. ``k_log`` is a stored parameter log of
    at most ``STEP_CHANGES`` changes of the list size.
    """
    prepared(updates.sparkSession)
    latest = top_hubs_stream(updates, every, lateness).withColumn("k", F.lit(float(k)))
    if k_log is not None:
        if not at_most(k_log, STEP_CHANGES):
            raise ValueError(f"a stream takes at most {STEP_CHANGES} parameter changes")
        latest = with_parameter(latest.drop("k"), k_log, name, float(k), "window_end").withColumnRenamed(name, "k")
    sized = latest.select("window_start", "window_end", F.col("k").cast("int").alias("k"), "node",
                          F.col("visits").cast("long").alias("visits"),
                          F.pmod(F.xxhash64("node"), F.lit(shares)).cast("int").alias("share"))

    def best(rows: DataFrame, *keys: str) -> DataFrame:
        return rows.repartition(*keys).mapInArrow(_best(*keys), HUBS)

    return best(best(sized, "window_start", "share"), "window_start").drop("k")


def rank_hubs(latest: DataFrame, k: int = 10) -> DataFrame:
    """The k best nodes of each closed period."""
    from pyspark.sql import Window

    order = Window.partitionBy("window_start", "window_end").orderBy(F.desc("visits"), "node")
    return latest.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
