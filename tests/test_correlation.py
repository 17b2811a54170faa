import pytest
from pyspark.sql import functions as F

from helpers import at, clean_rows, correlations, intervals_of, random_rows, secs, sliding, ticks_frame
from tickweave.functions.cells import Cells, micros
from tickweave.operators import correlation as C
from tickweave.operators.ordering import clamp_out_of_order, dedup_same_timestamp
from tickweave.operators.pairs import symbol_pairs


def clean_frame(spark, rows, rows_per_cell=None):
    ticks = ticks_frame(spark, rows)
    cells = Cells.fit(ticks, F.col("seq"), rows_per_cell) if rows_per_cell else None
    return dedup_same_timestamp(clamp_out_of_order(ticks, cells))


def values(df):
    return {(r["id0"], r["id1"]): r["value"] for r in df.collect()}


def test_clamp_and_dedup_golden(spark):
    got = clean_frame(spark, [("A", 10, 1.0), ("B", 12, 2.0), ("A", 11, 3.0), ("A", 12, 4.0)])
    assert sorted((r["symbol"], secs(r["ts"]), r["value"]) for r in got.collect()) == [
        ("A", 10, 1.0), ("A", 12, 3.0), ("B", 12, 2.0)]


def test_clamp_does_not_depend_on_cells(spark):
    rows = random_rows(3, ticks=200)
    got = clean_frame(spark, rows, rows_per_cell=17).collect()
    assert sorted((r["symbol"], secs(r["ts"]), r["value"]) for r in got) == sorted(clean_rows(rows))


def test_correlation_golden(spark):
    rows = [("A", 0, 10), ("B", 5, 5), ("A", 10, 12), ("B", 15, 8), ("A", 20, 11)]
    assert values(C.hy_correlation(ticks_frame(spark, rows)))["A", "B"] == pytest.approx(0.447214, abs=1e-6)


def test_touching_intervals_do_not_overlap(spark):
    iv = spark.createDataFrame(
        [("a", at(0), at(10), 1.0), ("b", at(10), at(20), 1.0), ("c", at(9), at(20), 1.0)],
        "symbol string, begin_ts timestamp_ntz, end_ts timestamp_ntz, delta double")
    got = {(r["id0"], r["id1"]) for r in C.overlap_join(iv).collect()}
    assert got == {("a", "c"), ("b", "c")}


def test_constant_series_has_no_row_and_no_overlap_is_zero(spark):
    constant = [("a", i, 5) for i in range(5)] + [("b", i, i) for i in range(5)]
    assert values(C.hy_correlation(ticks_frame(spark, sorted(constant, key=lambda r: r[1])))) == {}
    apart = [("a", 0, 1), ("a", 1, 2), ("b", 5, 1), ("b", 6, 2)]
    assert values(C.hy_correlation(ticks_frame(spark, apart))) == {("a", "b"): 0.0}


@pytest.mark.parametrize("seed", [1, 2])
def test_correlation_matches_double_loop_with_small_cells(spark, seed):
    rows = random_rows(seed, symbols=6, ticks=150)
    frame = clean_frame(spark, rows)
    cells = Cells.fit(frame, micros("ts"), 20)
    assert not cells.single
    got = values(C.hy_correlation(frame, cells=cells))
    want = correlations(intervals_of(clean_rows(rows)))
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


def test_hot_symbol_and_burst(spark):
    """One symbol holds most rows and half of all ticks fall into one second."""
    rows = [("hot", i * 0.001, 100 + i % 7) for i in range(300)]
    rows += [(f"s{j}", j + 20 * i, 100 + (i * j) % 5) for j in range(3) for i in range(8)]
    rows.sort(key=lambda r: r[1])
    frame = ticks_frame(spark, rows)
    got = values(C.hy_correlation(frame, cells=Cells.fit(frame, micros("ts"), 40)))
    want = correlations(intervals_of(rows))
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


@pytest.mark.parametrize("seed,size,advance", [(5, 30, 10), (6, 20, 7)])
def test_sliding_matches_per_tick_model(spark, seed, size, advance):
    rows = random_rows(seed, symbols=4, ticks=120)
    got = C.hy_correlation_sliding(clean_frame(spark, rows), f"{size} seconds", f"{advance} seconds")
    got = {(r["id0"], r["id1"], secs(r["window_start"])): r["value"] for r in got.collect()}
    want = sliding(clean_rows(rows), size, advance)
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


@pytest.mark.parametrize("scale,high", [(None, 1_000_000.3), (None, 1e9), (4, 1e9), (100, 1e12)])
def test_a_spike_leaves_nothing_behind(spark, scale, high):
    """After a huge move has left the window, small moves count exactly again."""
    moves = [0.0, 0.25, -0.5, 0.75, 0.25, -0.25, 0.5]
    rows = []
    for t in range(0, 90):
        rows.append(("a", t, high if t == 5 else 100 + moves[t % 7]))
        rows.append(("b", t + 0.5, 100 + moves[(t * 3) % 7]))
        if t % 2:
            rows.append(("c", t + 0.25, 100 + moves[(t * 5) % 7]))
    got = C.hy_correlation_sliding(ticks_frame(spark, rows), "30 seconds", "1 second", scale=scale)
    got = {(r["id0"], r["id1"], secs(r["window_start"])): r["value"] for r in got.collect()}
    want = sliding(rows, 30, 1)
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


def test_no_window_before_the_first_one_closes(spark):
    frame = ticks_frame(spark, [("a", 0, 1), ("b", 1, 2), ("a", 2, 3), ("b", 3, 1)])
    assert C.hy_correlation_sliding(frame, "30 seconds", "1 second").count() == 0


def test_symbol_pairs_cover_each_pair_once(spark):
    symbols = spark.createDataFrame([(f"s{i:02d}",) for i in range(37)], "symbol string")
    got = [(r["id0"], r["id1"]) for r in symbol_pairs(symbols, blocks=5).collect()]
    names = [f"s{i:02d}" for i in range(37)]
    assert sorted(got) == [(a, b) for i, a in enumerate(names) for b in names[i + 1:]]


def test_tasks_of_symbol_pairs_follow_the_pairs(spark, monkeypatch):
    """The bytes of the names tell nothing of the pairs, so they must not size the tasks."""
    from tickweave.operators import pairs

    monkeypatch.setattr(pairs, "PAIRS_PER_TASK", 4_000)
    monkeypatch.setattr(pairs, "BLOCK_NAMES", 16)
    symbols = spark.range(300).selectExpr("'s' || id AS symbol").unionByName(
        spark.createDataFrame([("s1",), (None,)], "symbol string"))
    got = symbol_pairs(symbols)
    assert got.rdd.getNumPartitions() == 300 * 300 // 4_000
    assert got.distinct().count() == got.count() == 300 * 299 // 2 and got.filter("id0 >= id1").isEmpty()


def test_many_blocks_give_the_same_correlation(spark, monkeypatch):
    from tickweave.operators import pairs

    rows = random_rows(9, symbols=12, ticks=160)
    frame = clean_frame(spark, rows)
    monkeypatch.setattr(pairs, "BLOCK_MEMBERS", 3)
    got = values(C.hy_correlation(frame))
    want = correlations(intervals_of(clean_rows(rows)))
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


@pytest.mark.parametrize("block,span,gap", [(3, 10**6, None), (3, 40, None), (100, 25, None), (4, 30, 17)])
def test_blocks_and_spans_of_whole_sums(spark, monkeypatch, block, span, gap):
    """Sums of pairs in their blocks' task, over one or several spans, with and without missing values."""
    rows = random_rows(13, symbols=11, ticks=240)
    frame = clean_frame(spark, rows)
    clean = clean_rows(rows)
    if gap:
        frame = frame.withColumn("value", F.when(F.col("value") % gap != 0, F.col("value")))
    monkeypatch.setattr(C, "SERIES_PER_BLOCK", block)
    monkeypatch.setattr(C, "INTERVALS_PER_GROUP", span)
    got = values(C.hy_correlation(frame))
    present = [(s, b, e, d) for s, b, e, d in intervals_of(clean)]
    if gap:
        value = {(s, t): v for s, t, v in clean}
        present = [r for r in present if value[r[0], r[1]] % gap and value[r[0], r[2]] % gap]
    want = correlations(present)
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


def test_sums_of_one_block_pair_are_not_shuffled(spark):
    rows = [(f"s{i % 40}", i, 100 + i * 7 % 11) for i in range(400)]
    plan = C.hy_correlation(ticks_frame(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert "id0" not in "".join(line for line in plan.splitlines() if "Exchange" in line)


def test_a_block_is_shuffled_once_whatever_it_meets(spark, monkeypatch):
    """Blocks meet by reading each other's partition; no row is copied for each block that it meets."""
    monkeypatch.setattr(C, "SERIES_PER_BLOCK", 4)
    rows = [(f"s{i % 40}", i, 100 + i * 7 % 11) for i in range(400)]
    found = C.hy_correlation(ticks_frame(spark, rows))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Generate" not in plan
    want = correlations(intervals_of(rows))
    got = values(found)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


def test_an_infinite_price_spoils_its_own_pairs_only(spark):
    rows = sorted([("a", i, float("inf") if i == 4 else 100 + i % 3) for i in range(9)]
                  + [("b", i + 0.5, 100 + i % 4) for i in range(9)] + [("c", i + 0.2, 100 + i % 5) for i in range(9)],
                  key=lambda r: r[1])
    with_a, without = (values(C.hy_correlation(ticks_frame(spark, [r for r in rows if r[0] in names])))
                       for names in ("abc", "bc"))
    assert with_a["b", "c"] == without["b", "c"]


def test_unknown_measure(spark):
    with pytest.raises(ValueError):
        C.pairwise_measure(ticks_frame(spark, [("a", 0, 1)]), "nope")


def test_no_ticks(spark):
    empty = ticks_frame(spark, [("a", 0, 1)]).filter("false")
    assert C.hy_correlation(empty).count() == 0
    assert C.hy_correlation_sliding(empty, "30 seconds", "1 second").count() == 0
