from helpers import at
from tickweave.sources import logs
from tickweave.sources import ticks as S


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_parse_ticks_golden(spark):
    ticks, rejects = S.parse_ticks(lines(
        spark, "1,11/14/2023,22:13:20,123.45,x", "1,14/11/2023,22:13:20,1,1", "1,11/14/2023,22:13:20,abc,1",
        "1,04/15/2016", "", "1,4/5/2016,1:2:3,1,1"))
    row = ticks.first()
    assert (row["symbol"], str(row["ts"]), row["value"], row["volume"]) == ("1", "2023-11-14 22:13:20", 123.45, 0)
    assert ticks.count() == 1 and rejects.count() == 5


def test_profile_line_with_arrival(spark):
    ticks, _ = S.parse_ticks(lines(spark, "1700000000123,77,11/14/2023,22:13:20,8.5,1\r"), with_arrival_ms=True)
    assert ticks.first()["volume"] == 1 and ticks.first()["arrival_ms"] == 1700000000123


def test_feed_log(spark, tmp_path):
    entry = "|".join(["NASDAQ", "ABCD", "c", "NoExpiry", *["x"] * 9, "9021"])
    (tmp_path / "feed.log").write_text(
        "LOGIN,ok!QUOTE,9021,a,b,123.45,10,11/14/2023,22:13:20!quote,short!"
        f"QUOTELIST,{entry}\nA|B|C|D|E!DEPTH,1,2!ERROR,bad!\n!")
    quotes, symbols, depth, errors = S.feed_log_to_tables(S.read_feed_log(spark, str(tmp_path)))
    assert [r["value"] for r in quotes.collect()] == ["9021,11/14/2023,22:13:20,123.45,10"]
    assert [tuple(r) for r in symbols.collect()] == [("9021", "NASDAQ·ABCD·NoExpiry")]
    assert [r["message"] for r in depth.collect()] == ["DEPTH,1,2"]
    assert sorted(r["message"] for r in errors.collect()) == ["A|B|C|D|E", "ERROR,bad"]


def test_symbol_list_and_key(spark):
    got = S.clean_symbol_list(lines(spark, "NASDAQ�ABCD�NoExpiry\r", "")).collect()
    assert [r["symbol"] for r in got] == ["NASDAQ·ABCD·NoExpiry"]
    keys = lines(spark, "a,b", ",b", "ab", "").select(S.symbol_key("value").alias("k")).collect()
    assert [r["k"] for r in keys] == ["a", "", "", ""]


def test_edge_log(spark):
    edges, rejects = logs.parse_edge_log(lines(
        spark, "n4,n9,03/21/2023,07:08:09,1", "n4,n9,03/21/2023,07:08:09,0", "a,b,03/21/2023,07:08:09,2",
        "a,b,03/21/2023,07:08:09", "a,b,31/15/2016,12:52:50,1"))
    assert sorted(r["is_add"] for r in edges.collect()) == [False, True]
    assert rejects.count() == 3


def test_commands_and_queries(spark):
    log = spark.createDataFrame(
        [(at(1), "addMarketplayer/1,2"), (at(2), "removeMarketplayer/1"), (at(3), "x/1/2"), (at(4), "x")],
        "ts timestamp_ntz, value string")
    got = sorted((r["player"], r["is_add"]) for r in logs.parse_player_commands(log).collect())
    assert got == [("1", False), ("1", True), ("2", True)]
    snapshots, paths, rejects = logs.parse_graph_queries(lines(
        spark, "", "03/21/2023,07:08:09", "03/21/2023,07:08:09,03/22/2023,07:08:09",
        "03/21/2023,12:00:00,03/21/2023,13:00:00,a,c,shortest",
        "03/21/2023,12:00:00,03/21/2023,13:00:00,a,c,longest", "1,2,3"))
    assert snapshots.count() == 2 and snapshots.filter("start_ts = end_ts").count() == 2
    assert [r["type"] for r in paths.collect()] == ["SHORTEST"]
    assert rejects.count() == 2


def test_recommendations(spark):
    row = logs.parse_recommendations(lines(
        spark, "9021,0.8,03/21/2023,07:08:09,earnings;ceo,9022;9023", "")).collect()
    assert len(row) == 1 and row[0]["keywords"] == ["earnings", "ceo"] and row[0]["related"] == ["9022", "9023"]
