"""Window sizes and periods that change while rows flow, against tick-by-tick simulations."""

import random

import pytest

from helpers import at, clean_rows, correlations, intervals_of, random_rows, secs, ticks_frame
from tickweave.functions.cells import Cells, micros
from tickweave.operators import correlation, hubs

LOG = "name string, value double, ts timestamp_ntz, seq bigint"


def size_log(spark, changes, name="windowSize"):
    rows = [(name, v, at(t), i) for i, (t, v) in enumerate(changes)]
    return spark.createDataFrame([*rows, ("other", 3.0, at(1), 99), (name, None, at(2), 100)], LOG)


def in_force(changes, when, default):
    value = default
    for t, v in changes:
        if t <= when:
            value = v
    return value


def sliding_sizes(clean, size, advance, changes):
    """Windows closed one by one by the tick that arrives, as a running program would."""
    out, seen, start = {}, [], clean[0][1]
    for symbol, when, value in clean:
        now = in_force(changes, when, size)
        while start + now <= when:
            inside = [i for i in intervals_of(seen) if start <= i[2]]
            for pair, found in correlations(inside).items():
                out[(*pair, start, start + now)] = found
            start += advance
        seen.append((symbol, when, value))
    return out


@pytest.mark.parametrize("changes", [
    [], [(40, 12.0)], [(20, 50.0), (60, 8.0), (61, 45.0), (90, 20.0)], [(0, 7.0), (45, 30.0), (45, 16.0)]])
def test_changing_window_size(spark, changes):
    rows = random_rows(31, symbols=3, ticks=80)
    clean = clean_rows(rows)
    ticks = ticks_frame(spark, clean)
    got = correlation.hy_correlation_sliding(ticks, "30 seconds", "5 seconds", size_log=size_log(spark, changes))
    got = {(r["id0"], r["id1"], secs(r["window_start"]), secs(r["window_end"])): r["value"] for r in got.collect()}
    want = sliding_sizes(clean, 30, 5, changes)
    assert got.keys() == want.keys() and len(want) > 10
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    if not changes:
        plain = correlation.hy_correlation_sliding(ticks, "30 seconds", "5 seconds")
        assert {(r["id0"], r["id1"], secs(r["window_start"]), secs(r["window_end"])) for r in plain.collect()} == got.keys()


def test_closings_do_not_depend_on_cells(spark):
    rows = clean_rows(random_rows(32, symbols=3, ticks=120))
    ticks, log = ticks_frame(spark, rows), size_log(spark, [(30, 9.0), (70, 40.0), (100, 20.0)])
    whole = correlation.window_closings(ticks, "30 seconds", "5 seconds", log)
    cells = Cells.fit(ticks, micros("ts"), rows_per_cell=10)
    assert not cells.single
    cut = correlation.window_closings(ticks, "30 seconds", "5 seconds", log, cells=cells)
    assert (whole.t0, whole.windows) == (cut.t0, cut.windows)
    assert sorted(whole.times.collect()) == sorted(cut.times.collect())
    assert sorted(whole.sizes.collect()) == sorted(cut.sizes.collect())


def test_no_ticks_and_no_closed_window(spark):
    log = size_log(spark, [(3, 4.0)])
    assert correlation.hy_correlation_sliding(ticks_frame(spark, []), size_log=log).count() == 0
    few = ticks_frame(spark, [("a", 0, 1), ("b", 1, 2), ("a", 2, 4), ("b", 2, 7)])
    assert correlation.hy_correlation_sliding(few, size_log=log).count() == 0


def signals(changes, every, end):
    """A signal at the first second that is one period of that moment after the last one."""
    out, last = [0], 0
    for second in range(1, end + 1):
        if second - last >= in_force(changes, second, every):
            out.append(second)
            last = second
    return out


@pytest.mark.parametrize("step_changes", [4096, 2])
@pytest.mark.parametrize("changes", [
    [], [(33, 4.0)], [(5, 50.0), (12, 3.0), (13, 40.0), (90, 7.0), (91, 1.0), (95, 25.0)],
    [(10, 30.0), (11, 31.0), (12, 32.0), (13, 33.0), (14, 2.0), (60, 100.0)]])
def test_changing_period(spark, changes, step_changes):
    origin = 1_704_067_200
    rng = random.Random(4)
    rows = [(f"n{rng.randrange(6)}", rng.randrange(100), at(t), i) for i, t in enumerate(
        sorted(rng.randrange(0, 200) for _ in range(150)))]
    updates = spark.createDataFrame(rows, "node string, visits bigint, ts timestamp_ntz, seq bigint")
    log = size_log(spark, changes)
    stretches = hubs.change_periods(spark, log, "10 seconds", step_changes=step_changes)
    got = hubs.in_periods(updates, stretches).collect()
    # the epoch is a signal and 2024-01-01 a multiple of ten seconds later
    marks = signals(changes, 10, 400)
    for r in got:
        when = secs(r["ts"])
        start = max(m for m in marks if m <= when)
        after = min(m for m in marks if m > when)
        assert (secs(r["w"]["start"]), secs(r["w"]["end"])) == (start, after), (when, origin)
    assert len(got) == len(rows)


def test_hub_lists_with_changing_period_and_size(spark):
    changes, sizes = [(25, 7.0), (60, 20.0)], [(30, 1.0), (70, 2.0)]
    rng = random.Random(5)
    rows = [(f"n{rng.randrange(6)}", rng.randrange(100), at(t), i) for i, t in enumerate(
        sorted(rng.randrange(0, 120) for _ in range(90)))]
    updates = spark.createDataFrame(rows, "node string, visits bigint, ts timestamp_ntz, seq bigint")
    got = hubs.top_hubs_windowed(updates, 3, "10 seconds", size_log(spark, sizes, "hubListSize"),
                                 period_log=size_log(spark, changes))
    got = sorted((secs(r["window_start"]), secs(r["window_end"]), r["rank"], r["node"], r["visits"]) for r in got.collect())
    marks, want = signals(changes, 10, 300), []
    for start, end in zip(marks, marks[1:]):
        latest = {}
        for node, visits, ts, _ in rows:
            if start <= secs(ts) < end:
                latest[node] = visits
        best = sorted(latest.items(), key=lambda x: (-x[1], x[0]))[:int(in_force(sizes, end, 3))]
        want += [(start, end, i + 1, n, v) for i, (n, v) in enumerate(best)]
    assert got == sorted(want)


def test_periods_without_changes_are_plain_windows(spark):
    rows = [("a", i, at(7 * i), i) for i in range(20)]
    updates = spark.createDataFrame(rows, "node string, visits bigint, ts timestamp_ntz, seq bigint")
    plain = hubs.top_hubs_windowed(updates, 2, "30 seconds").collect()
    log = size_log(spark, [(40, 0.0), (50, -3.0)])
    assert sorted(hubs.top_hubs_windowed(updates, 2, "30 seconds", period_log=log).collect()) == sorted(plain)
    empty = updates.filter("false")
    assert hubs.top_hubs_windowed(empty, 2, "30 seconds", period_log=log).count() == 0
