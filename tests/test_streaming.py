import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import at, random_rows, secs, sliding
from tickweave.operators import change, graph, hubs
from tickweave.operators import results as R
from tickweave.streaming import correlation as SC
from tickweave.streaming import keyed
from tickweave.streaming import ticks as ST


def write_files(folder, rows, per_file):
    """Tick lines with an arrival number in front, in files that sort by arrival."""
    folder.mkdir()
    for n in range(0, len(rows), per_file):
        part = rows[n:n + per_file]
        text = "".join(f"{n + i}|{s},{at(t):%m/%d/%Y,%H:%M:%S},{v},1\n" for i, (s, t, v) in enumerate(part))
        path = folder / f"{n:06d}.txt"
        path.write_text(text)
        stamp = 1_700_000_000 + n
        import os
        os.utime(path, (stamp, stamp))


def tick_stream(spark, folder, files=1):
    lines = ST.stream_lines(spark, str(folder), files).select(
        F.substring_index("value", "|", 1).cast("bigint").alias("seq"),
        F.substring_index("value", "|", -1).alias("value"))
    return ST.stream_ticks(lines)


def run(query):
    query.awaitTermination(300)
    assert query.exception() is None


def test_clamp_stream_equals_batch(spark, tmp_path):
    rows = random_rows(21, ticks=60)
    write_files(tmp_path / "in", rows, 20)
    out = str(tmp_path / "out")
    run(ST.clamp_stream(tick_stream(spark, tmp_path / "in"), out, str(tmp_path / "ck")))
    newest, want = 0, []
    for i, (s, t, v) in enumerate(rows):
        newest = max(newest, t)
        want.append((i, newest))
    got = sorted((r["seq"], secs(r["ts"])) for r in spark.read.parquet(out).collect())
    assert got == want


def expected_closed(rows, size, advance, lateness, dedup=True):
    """The model over ticks in time order, windows that the last watermark has reached."""
    newest, seen, kept = None, set(), []
    for order, (symbol, when, value) in sorted(enumerate(rows), key=lambda x: (x[1][1], x[0])):
        if (symbol, when) not in seen:
            seen.add((symbol, when))
            kept.append((symbol, when, value))
    last = max(t for _, t, _ in rows)
    return {k: v for k, v in sliding(kept, size, advance).items() if k[2] + size <= last - lateness - 0.001}


def stream_result(spark, out, kind=None):
    table = spark.read.parquet(out)
    if kind:
        table = table.filter(F.col("kind") == kind)
    rows = [(r["id0"], r["id1"], secs(r["window_start"]), r["value"]) for r in table.collect()]
    assert len({r[:3] for r in rows}) == len(rows)
    return {r[:3]: r[3] for r in rows}


def same(got, want):
    assert got.keys() == want.keys() and len(want) > 5
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


@pytest.mark.parametrize("blocks", [1, 3])
def test_correlation_stream_equals_model(spark, tmp_path, blocks):
    """Eleven micro-batches with late ticks, a gap longer than a window and ticks at one time."""
    rows = random_rows(22, symbols=4, ticks=70)
    end = max(t for _, t, _ in rows)
    rows += [(s, t + end + 95, v) for s, t, v in random_rows(24, symbols=4, ticks=40)]
    write_files(tmp_path / "in", rows, 10)
    first = min(t for _, t, _ in rows)
    windows = SC.hy_correlation_stream(
        tick_stream(spark, tmp_path / "in"), "30 seconds", "10 seconds", lateness="4 seconds", blocks=blocks,
        origin=int((at(first) - at(0)).total_seconds() * 1e6) + 1_704_067_200_000_000)
    query = ST.write_stream(windows, str(tmp_path / "out"), str(tmp_path / "ck"))
    run(query)
    assert query.lastProgress["batchId"] >= 10
    same(stream_result(spark, str(tmp_path / "out")), expected_closed(rows, 30, 10, 4))


def test_correlation_stream_goes_on_after_a_restart(spark, tmp_path):
    import shutil
    rows = random_rows(25, symbols=3, ticks=90)
    write_files(tmp_path / "all", rows, 10)
    (tmp_path / "in").mkdir()
    names = sorted(p.name for p in (tmp_path / "all").iterdir())
    first = min(t for _, t, _ in rows)
    for part in (names[:4], names[4:5], names[5:]):
        for name in part:
            shutil.copy2(tmp_path / "all" / name, tmp_path / "in" / name)
        windows = SC.hy_correlation_stream(
            tick_stream(spark, tmp_path / "in"), "30 seconds", "10 seconds", lateness="4 seconds", blocks=2,
            origin=first * 1_000_000 + 1_704_067_200_000_000)
        run(ST.write_stream(windows, str(tmp_path / "out"), str(tmp_path / "ck")))
    same(stream_result(spark, str(tmp_path / "out")), expected_closed(rows, 30, 10, 4))


def test_correlation_stream_drops_what_is_too_late(spark, tmp_path):
    rows = random_rows(26, symbols=3, ticks=60, late=False)
    first, end = rows[0][1], rows[-1][1]
    late = [("s0", first + 1, 500.0), ("s1", first + 2, 900.0)]
    # the late ticks come in a file of their own after a file that has moved the watermark
    write_files(tmp_path / "in", rows[:40] + late * 5 + rows[40:], 10)
    windows = SC.hy_correlation_stream(
        tick_stream(spark, tmp_path / "in"), "30 seconds", "10 seconds",
        origin=first * 1_000_000 + 1_704_067_200_000_000)
    run(ST.write_stream(windows, str(tmp_path / "out"), str(tmp_path / "ck")))
    same(stream_result(spark, str(tmp_path / "out")), expected_closed(rows, 30, 10, 0))


def test_correlation_stream_keeps_kinds_apart(spark, tmp_path):
    rows = random_rows(23, symbols=2, ticks=90)
    write_files(tmp_path / "in", rows, 15)
    ticks = tick_stream(spark, tmp_path / "in")
    both = ticks.withColumn("kind", F.explode(F.array(F.lit("f"), F.lit("w")))).withColumn(
        "value", F.when(F.col("kind") == "f", F.col("value")).otherwise(200 - F.col("value"))).withColumn(
        "seq", F.col("seq") * 2 + (F.col("kind") == "w").cast("bigint"))
    windows = SC.hy_correlation_stream(both, "30 seconds", "10 seconds", lateness="4 seconds",
                                       origin=min(t for _, t, _ in rows) * 1_000_000 + 1_704_067_200_000_000)
    run(ST.write_stream(windows, str(tmp_path / "out"), str(tmp_path / "ck")))
    for kind in "fw":
        same(stream_result(spark, str(tmp_path / "out"), kind), expected_closed(rows, 30, 10, 4))


@pytest.mark.parametrize("blocks,lateness", [(1, 0), (3, 4)])
def test_transfer_entropy_stream_equals_batch(spark, tmp_path, blocks, lateness):
    from tickweave.operators.entropy import transfer_entropy_sliding
    from tickweave.streaming.entropy import transfer_entropy_stream

    rows = random_rows(41, symbols=3, ticks=110, late=lateness > 0)
    rows += [("new", t, v) for _, t, v in rows[-50:]]
    rows.sort(key=lambda r: r[1] // 30)
    if not lateness:
        rows.sort(key=lambda r: r[1])
    write_files(tmp_path / "in", rows, 16)
    late = f"{max(lateness, 30 if lateness else 0)} seconds"
    found = transfer_entropy_stream(tick_stream(spark, tmp_path / "in"), "2 seconds", 6, 8, lateness=late, blocks=blocks)
    query = ST.write_stream(found, str(tmp_path / "out"), str(tmp_path / "ck"))
    run(query)
    assert query.lastProgress["batchId"] >= 8
    ticks = spark.createDataFrame([(s, at(t), float(v), i) for i, (s, t, v) in enumerate(rows)],
                                  "symbol string, ts timestamp_ntz, value double, seq bigint")
    closed = at(max(t for _, t, _ in rows) - (30 if lateness else 0) - 0.001)
    want = {(r["id0"], r["id1"], r["window_end"]): r["value"]
            for r in transfer_entropy_sliding(ticks, "2 seconds", 6, 8).collect() if r["window_end"] <= closed}
    got = [((r["id0"], r["id1"], r["window_end"]), r["value"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert len(dict(got)) == len(got)
    same(dict(got), want)


def result_stream(spark, folder):
    values = [0.2, 0.7, -0.9, 0.69, 0.1, -0.8, -0.801, -0.9, 0.0, 0.5]
    rows = [(p, "z", at(i), v * (1 if p == "a" else .9)) for i, v in enumerate(values) for p in "ab"]
    df = spark.createDataFrame(rows, "id0 string, id1 string, window_end timestamp_ntz, value double")
    for part, (lo, hi) in enumerate([(0, 3), (3, 7), (7, 10)]):
        df.filter((F.col("window_end") >= F.lit(at(lo))) & (F.col("window_end") < F.lit(at(hi)))).coalesce(1) \
            .write.mode("append").parquet(str(folder))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
    return df, stream


def test_edge_changes_and_change_filter_streams_equal_batch(spark, tmp_path):
    df, stream = result_stream(spark, tmp_path / "in")
    run(ST.write_stream(keyed.edge_changes_stream(stream), str(tmp_path / "edges"), str(tmp_path / "ck1")))
    got = sorted((r["v0"], r["ts"], r["is_add"]) for r in spark.read.parquet(str(tmp_path / "edges")).collect())
    assert got == sorted((r["v0"], r["ts"], r["is_add"]) for r in graph.edge_changes(df).collect())

    moved = keyed.emit_on_change_stream(stream, ["id0", "id1"], "window_end")
    run(ST.write_stream(moved, str(tmp_path / "moved"), str(tmp_path / "ck2")))
    want = change.emit_on_change(df, ["id0", "id1"], "window_end")
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "moved")).collect())) == sorted(map(tuple, want.collect()))


def test_edge_changes_with_a_threshold_that_changes(spark, tmp_path):
    """Results and changes come in files of their own, a few seconds out of order."""
    import random
    from tickweave.operators.params import with_parameter

    rng = random.Random(9)
    rows = [(f"p{rng.randrange(3)}", f"q{rng.randrange(3)}", at(t), rng.uniform(-1, 1)) for t in range(120) for _ in range(3)]
    rows += [("p0", "q0", at(t), None) for t in (5, 50)]
    df = spark.createDataFrame(rows, "id0 string, id1 string, window_end timestamp_ntz, value double")
    changes = [(15, 0.3), (40, 0.9), (40, 0.5), (77, 0.1), (78, 0.8)]
    log = spark.createDataFrame([("correlationThreshold", v, at(t), i) for i, (t, v) in enumerate(changes)]
                                + [("hubListSize", 0.0, at(30), 90), ("correlationThreshold", None, at(60), 91)],
                                "name string, value double, ts timestamp_ntz, seq bigint")
    for i in range(0, 120, 10):
        late = F.when(F.col("value") > 0.9, 4).otherwise(0)
        moved = df.withColumn("_at", F.unix_seconds(F.col("window_end").cast("timestamp")) - 1_704_067_200 + late)
        moved.filter((F.col("_at") >= i) & (F.col("_at") < (i + 10 if i < 110 else 999))).drop("_at").coalesce(1) \
            .write.mode("append").parquet(str(tmp_path / "in"))
        log.filter((F.col("ts") >= F.lit(at(i))) & (F.col("ts") < F.lit(at(i + 10)))).coalesce(1) \
            .write.mode("append").parquet(str(tmp_path / "log"))

    def read(frame, name):
        return spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name))

    found = keyed.edge_changes_with_parameter_stream(
        read(df, "in"), read(log, "log"), default=0.7, lateness="15 seconds", shares=3)
    run(ST.write_stream(found, str(tmp_path / "out"), str(tmp_path / "ck")))
    sized = with_parameter(df, log, "correlationThreshold", 0.7, "window_end")
    closed = at(119 - 15 - 0.001)
    want = [tuple(r) for r in graph.edge_changes(sized, "correlationThreshold").collect() if r["ts"] <= closed]
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == sorted(want) and len(want) > 40


class Stored(dict):
    """Map or value state in memory."""

    getValue, updateValue, containsKey = dict.__getitem__, dict.__setitem__, dict.__contains__
    removeKey, iterator = dict.pop, dict.items

    def exists(self):
        return None in self

    def get(self, key=None):
        return self[key]

    def update(self, value):
        self[None] = value


class Handle:
    def __init__(self):
        self.states, self.timers = {}, set()

    def state(self, name, *schema):
        return self.states.setdefault(name, Stored())

    getMapState = getValueState = state

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)


class Watermark:
    def __init__(self, at):
        self.at = at

    def getCurrentWatermarkInMs(self):
        return self.at


def test_changes_go_where_no_results_wait_for_them():
    """A share without pairs must not collect the whole log; of one time the last change counts."""
    share, handle = keyed._Thresholds(0.7), Handle()
    share.init(handle)
    kept = []
    for batch in range(30):
        at = [batch * 10_000_000 + i * 20_000 for i in range(500)] * 2
        share.handleInputRows((0,), iter([pd.DataFrame({
            "v0": None, "v1": None, "at": at, "seq": range(1000), "value": [i / 1000 for i in range(1000)]})]),
            Watermark(max(0, batch * 10_000 - 2_000)))
        kept.append(len(share.known()))
    assert max(kept) <= 700 and kept[-1] >= 500
    last = 29 * 10_000_000
    assert share.limits(np.array([last, last + 19_999, last + 20_000])).tolist() == [0.5, 0.5, 0.501]


def test_streams_read_together_arrive_in_step(spark, tmp_path):
    """A stretch without rows, or more rows on one side, must not let one stream run ahead."""
    from tickweave.plans import catalog

    few = spark.createDataFrame([(at(t),) for t in (0, 1, 2, 90, 100)], "ts timestamp_ntz")
    many = spark.createDataFrame([(at(t),) for t in range(101)], "ts timestamp_ntz")
    files = []
    for name, frame in (("few", few), ("many", many)):
        catalog._arriving(frame, str(tmp_path / name), slices=10)
        parts = sorted((tmp_path / name).glob("*.parquet"), key=lambda p: p.stat().st_mtime_ns)
        files.append([sorted(secs(r["ts"]) for r in spark.read.parquet(str(p)).collect()) for p in parts])
    assert [len(f) for f in files] == [10, 10] and files[0][0] == [0, 1, 2] and files[0][5] == []
    assert all(max(a) <= max(b) for a, b in zip(*files) if a)


def test_ranking_needs_no_state_and_state_has_few_partitions(spark, tmp_path):
    rows = [(f"n{i % 5}", 10 * i, i) for i in range(40)]
    write_files(tmp_path / "in", rows, 20)
    updates = tick_stream(spark, tmp_path / "in").select(
        F.col("symbol").alias("node"), F.col("value").cast("bigint").alias("visits"), "ts", "seq")
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    query = ST.write_stream(keyed.top_hubs_ranked_stream(updates, 2, "60 seconds"), str(tmp_path / "out"),
                            str(tmp_path / "ck"), partitions=2)
    run(query)
    assert [op["numShufflePartitions"] for op in query.lastProgress["stateOperators"]] == [2]
    assert spark.conf.get("spark.sql.shuffle.partitions") == usual


def test_drop_repeated_stream_equals_batch(spark, tmp_path):
    from tickweave.operators.ordering import drop_repeated_records

    rows = [(s, t, v) for t in range(12) for s, v in [("a", 1), ("a", 1)] * 2] + [("b", 12 + i // 3, i // 7) for i in range(40)]
    rows = [(s, 0, v) for s, _, v in rows]
    write_files(tmp_path / "in", rows, 8)     # several files repeat one record throughout
    run(ST.drop_repeated_stream(tick_stream(spark, tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")))
    got = sorted((r["seq"], r["symbol"], r["value"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    whole = spark.createDataFrame([(s, at(t), float(v), 1, i) for i, (s, t, v) in enumerate(rows)],
                                  "symbol string, ts timestamp_ntz, value double, volume int, seq bigint")
    want = sorted((r["seq"], r["symbol"], r["value"]) for r in drop_repeated_records(whole).collect())
    assert got == want and len(want) < 12


def test_windowed_reports_equal_batch(spark, tmp_path):
    rows = [(f"n{i % 5}", 10 * i, i) for i in range(40)]
    write_files(tmp_path / "in", rows, 10)
    ticks = tick_stream(spark, tmp_path / "in")
    closed = at(390 - 60)  # periods that end before the watermark

    run(ST.write_stream(ST.throughput_stream(ticks), str(tmp_path / "rate"), str(tmp_path / "ck1")))
    batch = spark.createDataFrame([(at(t),) for _, t, _ in rows], "ts timestamp_ntz")
    want = {r["window_start"]: r["tuples_per_sec"] for r in R.throughput(batch).collect() if r["window_end"] <= closed}
    got = {r["window_start"]: r["tuples_per_sec"] for r in spark.read.parquet(str(tmp_path / "rate")).collect()}
    assert got == want and len(want) > 3

    updates = ticks.select(F.col("symbol").alias("node"), F.col("value").cast("bigint").alias("visits"), "ts", "seq")
    latest = keyed.top_hubs_stream(updates, "60 seconds", "60 seconds")
    run(ST.write_stream(latest, str(tmp_path / "hubs"), str(tmp_path / "ck2")))
    ranked = keyed.rank_hubs(spark.read.parquet(str(tmp_path / "hubs")), 2)
    stored = spark.createDataFrame([(n, v, at(t), i) for i, (n, t, v) in enumerate(rows)],
                                   "node string, visits bigint, ts timestamp_ntz, seq bigint")
    want = [(r["window_start"], r["rank"], r["node"]) for r in
            hubs.top_hubs_windowed(stored, 2, "60 seconds").collect() if r["window_end"] <= closed]
    assert sorted((r["window_start"], r["rank"], r["node"]) for r in ranked.collect()) == sorted(want)


@pytest.mark.parametrize("shares", [1, 5])
def test_ranked_hub_lists_equal_batch(spark, tmp_path, shares):
    import random

    rng = random.Random(8)
    rows = [(f"n{rng.randrange(25)}", t, rng.randrange(40)) for t in sorted(rng.randrange(0, 400) for _ in range(300))]
    write_files(tmp_path / "in", rows, 30)
    updates = tick_stream(spark, tmp_path / "in").select(
        F.col("symbol").alias("node"), F.col("value").cast("bigint").alias("visits"), "ts", "seq")
    log = spark.createDataFrame([("hubListSize", 2.0, at(100), 1), ("hubListSize", 5.0, at(200), 2)],
                                "name string, value double, ts timestamp_ntz, seq bigint")
    found = keyed.top_hubs_ranked_stream(updates, 3, "20 seconds", "5 seconds", log, shares=shares)
    run(ST.write_stream(found, str(tmp_path / "out"), str(tmp_path / "ck")))
    stored = spark.createDataFrame([(n, v, at(t), i) for i, (n, t, v) in enumerate(rows)],
                                   "node string, visits bigint, ts timestamp_ntz, seq bigint")
    closed = at(rows[-1][1] - 5)
    want = [tuple(r) for r in hubs.top_hubs_windowed(stored, 3, "20 seconds", log).collect() if r["window_end"] <= closed]
    got = spark.read.parquet(str(tmp_path / "out")).select("window_start", "window_end", "rank", "node", "visits").collect()
    assert sorted(map(tuple, got)) == sorted(want) and len(want) > 40


def test_dedup_stream(spark, tmp_path):
    rows = [("a", 1, 1), ("a", 1, 2), ("b", 1, 3), ("a", 2, 4), ("a", 2, 5)]
    write_files(tmp_path / "in", rows, 2)
    run(ST.write_stream(ST.dedup_stream(tick_stream(spark, tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck")))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_focus_stream_equals_batch(spark, tmp_path):
    from tickweave.operators.ordering import filter_focus_players

    schema = "symbol string, ts timestamp, value double"
    ticks = spark.createDataFrame([(s, at(t), 1.0 * t) for t in range(12) for s in "ab"], schema)
    commands = spark.createDataFrame(
        [("a", at(2), True), ("a", at(5), False), ("b", at(7), True), ("a", at(9), True)],
        "symbol string, ts timestamp, is_add boolean")
    for lo, hi in ((0, 4), (4, 8), (8, 12)):
        for df, name in ((ticks, "ticks"), (commands, "commands")):
            df.filter((F.col("ts") >= F.lit(at(lo))) & (F.col("ts") < F.lit(at(hi)))).coalesce(1) \
                .write.mode("append").parquet(str(tmp_path / name))
    read = lambda df, name: spark.readStream.schema(df.schema).option(
        "maxFilesPerTrigger", 1).parquet(str(tmp_path / name))
    passed = keyed.filter_members_stream(read(ticks, "ticks"), read(commands, "commands"), ["symbol"])
    run(ST.write_stream(passed, str(tmp_path / "out"), str(tmp_path / "ck")))
    want = filter_focus_players(ticks, commands.withColumnRenamed("symbol", "player"))
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == sorted(
        tuple(r) for r in want.select("symbol", "ts", "value").collect())


def test_batch_operator_per_micro_batch(spark, tmp_path):
    from tickweave.operators.results import format_web

    rows = [("a", t, t) for t in range(9)]
    write_files(tmp_path / "in", rows, 3)
    run(ST.apply_per_batch(tick_stream(spark, tmp_path / "in"), format_web, str(tmp_path / "out"), str(tmp_path / "ck")))
    got = [r["line"] for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert len(got) == 9 and "w,a,01/01/2024,00:00:03,3.0" in got


class Held:
    """State and timers of a processor outside a stream; ``writes`` counts updates."""

    def __init__(self):
        self.values, self.writes = {}, 0

    def getMapState(self, *_):
        return Held()

    getValueState = getMapState

    def exists(self):
        return None in self.values

    def get(self):
        return self.values[None]

    def containsKey(self, key):
        return key in self.values

    def getValue(self, key):
        return self.values[key]

    def updateValue(self, key, value):
        self.values[key] = value
        self.writes += 1

    def update(self, value):
        self.updateValue(None, value)

    def registerTimer(self, _):
        pass

    deleteTimer = registerTimer


def test_state_is_written_once_a_batch_however_many_chunks_come():
    ticks = pd.DataFrame({"block": 0, "symbol": "a", "at": range(100), "seq": range(100), "value": 1.0})
    pair = SC._BlockPair(0, 1000, 10)
    pair.init(Held())
    list(pair.handleInputRows((0, 0), iter([ticks[i:i + 10] for i in range(0, 100, 10)]), None))
    assert pair.series.writes == 1 and list(pair.series.values[0, "a", 0][0]) == list(range(100))
    news = pd.DataFrame({"v0": None, "v1": None, "at": range(100, 0, -1), "seq": range(100), "value": 0.5})
    limits = keyed._Thresholds(0.7)
    limits.init(Held())
    list(limits.handleInputRows((0,), iter([news[i:i + 10] for i in range(0, 100, 10)]), None))
    assert limits.changes.writes == 1 and limits.changes.values[None][0] == list(range(1, 101))


def test_arrivals_read_their_table_twice_however_many_there_are(spark, tmp_path):
    from tickweave.plans import catalog

    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    ticks = spark.createDataFrame([(at(i * 60), i) for i in range(240)] + [(None, -1)], "ts timestamp_ntz, n int")
    stream = catalog._arriving(ticks.mapInArrow(counted, ticks.schema), str(tmp_path / "in"))
    assert stream.isStreaming and read.value <= 2 * 241
    files = sorted((tmp_path / "in").glob("*.parquet"), key=lambda f: f.stat().st_mtime)
    parts = [sorted(r["n"] for r in spark.read.parquet(str(f)).collect()) for f in files]
    assert len(parts) == catalog.ARRIVALS and sum(parts, []) == list(range(240))
    catalog._arriving(ticks.filter("false"), str(tmp_path / "none"))
    assert spark.read.schema(ticks.schema).parquet(str(tmp_path / "none")).isEmpty()
