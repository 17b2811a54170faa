import random

from pyspark.sql import functions as F

from helpers import at, secs, ticks_frame
from tickweave.functions.cells import Cells, micros
from tickweave.functions.ordered import as_of, following, last_known, previous, row_numbers, running_sums
from tickweave.operators import ordering, params


def test_cells_bound_a_skewed_column(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(10),) for _ in range(500)] + [(rng.randrange(10**9),) for _ in range(500)]
    df = spark.createDataFrame(rows, "v bigint")
    cells = Cells.fit(df, F.col("v"), 50)
    got = df.select("v", cells.of(F.col("v")).alias("c")).collect()
    assert all(cells.index(r["v"]) == r["c"] for r in got)
    spread = [r["count"] for r in df.select(cells.of(F.col("v")).alias("c")).groupBy("c").count().collect()]
    assert max(spread) <= 150  # a single value may hold up to about 1/10 of half the rows


def test_windows_do_not_depend_on_cells(spark):
    rng = random.Random(2)
    rows = [("hot" if rng.random() < .6 else f"k{rng.randrange(4)}", i, rng.randrange(9), None if i % 3 else i)
            for i in range(300)]
    df = spark.createDataFrame(rows, "k string, o bigint, v bigint, m bigint")
    position = F.col("o")
    many = Cells.fit(df, position, 23)
    for fn in (
        lambda c: previous(df, ["k"], ["o"], ["v", "o"], position, c, "out"),
        lambda c: following(df, ["k"], ["o"], ["v", "o"], position, c, "out"),
        lambda c: last_known(df, ["k"], ["o"], "m", position, c, "out"),
        lambda c: running_sums(df, ["k"], ["o"], ["v"], position, c, "out"),
        lambda c: row_numbers(df, [], ["o"], position, c, "out"),
    ):
        one, split = fn(Cells()), fn(many)
        assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, split.collect()), key=str)


def test_membership_both_ways(spark):
    ticks = ticks_frame(spark, [("a", t, 1) for t in range(10)] + [("b", t, 1) for t in range(10)])
    commands = spark.createDataFrame(
        [(at(2), "a", True), (at(4), "a", True), (at(6), "a", False), (at(8), "a", True)],
        "ts timestamp_ntz, player string, is_add boolean")
    want = [("a", t) for t in (2, 3, 4, 5, 8, 9)]
    for rows in (100, 0):
        got = ordering.filter_focus_players(ticks, commands, broadcast_rows=rows)
        assert sorted((r["symbol"], secs(r["ts"])) for r in got.collect()) == want


def test_parameter_both_ways(spark):
    ticks = ticks_frame(spark, [("a", t, 1) for t in range(6)])
    log = spark.createDataFrame([("p", 5.0, at(2)), ("q", 9.0, at(3)), ("p", 7.0, at(4))],
                                "name string, value double, ts timestamp_ntz")
    for steps in (10, 0):
        got = params.with_parameter(ticks, log, "p", 1.0, step_changes=steps)
        assert [r["p"] for r in got.orderBy("ts").collect()] == [1, 1, 5, 5, 7, 7]


def test_as_of_keeps_null_values_and_splits(spark):
    left = spark.createDataFrame([("a", i) for i in range(40)], "k string, o bigint")
    right = spark.createDataFrame([("a", 5, 1.0), ("a", 12, None), ("a", 30, 3.0)], "k string, o bigint, v double")
    cells = Cells.fit(left, F.col("o"), 7)
    got = {r["o"]: r["v"] for r in as_of(left, right, ["k"], ["o"], "v", F.col("o"), cells).collect()}
    assert got == {i: None if i < 5 or 12 <= i < 30 else (1.0 if i < 12 else 3.0) for i in range(40)}


def test_repeats_limit_names_pairs(spark):
    records = spark.createDataFrame([("x", 0), ("x", 1), (None, 2), (None, 3), ("x", 4)], "v string, seq bigint")
    assert [r["seq"] for r in ordering.drop_repeated_records(records).orderBy("seq").collect()] == [0, 2, 4]
    ticks = ticks_frame(spark, [("c", 0, 1), ("a", 1, 1), ("b", 2, 1), ("c", 3, 1)])
    assert {r["symbol"] for r in ordering.limit_symbols(ticks, 2).collect()} == {"c", "a"}
    names = spark.createDataFrame([("c", "C")], "symbol string, name string")
    assert {r["symbol"]: r["name"] for r in ordering.attach_symbol_names(ticks, names).collect()} == {
        "c": "C", "a": None, "b": None}
    results = spark.createDataFrame([("a", "b"), ("a", "c")], "id0 string, id1 string")
    asked = spark.createDataFrame([("b", "a")], "id0 string, id1 string")
    assert [tuple(r) for r in ordering.subscribe_pairs(results, asked).collect()] == [("a", "b")]
    assert micros("ts") is not None
