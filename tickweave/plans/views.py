"""Views over the driver tables that feed the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.functions.text import DATE_COMMA_TIME
from tickweave.session import pin_utc


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    pin_utc(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _ticks(spark, folder, symbol) -> DataFrame:
    return table(spark, folder, "events").select(
        symbol.alias("symbol"), "ts", "value", F.lit(1).alias("volume"), F.col("event_id").alias("seq"))


def ticks_type(spark, folder) -> DataFrame:
    """Ticks with the event type as symbol: few symbols, each with a fifth of the rows."""
    return _ticks(spark, folder, F.col("event_type"))


def ticks_user(spark, folder) -> DataFrame:
    """Ticks with the user as symbol: many symbols."""
    return _ticks(spark, folder, F.col("user_id").cast("string"))


def spiked_ticks(spark, folder) -> DataFrame:
    """Ticks by event type, a few of them a million times as high."""
    value = F.when(F.col("seq") % 509 == 7, F.col("value") * 1e6).otherwise(F.col("value"))
    return ticks_type(spark, folder).withColumn("value", value)


def late_ticks(spark, folder) -> DataFrame:
    """Ticks whose arrival numbers are shuffled locally, so that some come late."""
    return _ticks(spark, folder, F.col("event_type")).withColumn(
        "seq", (F.col("seq") + (F.col("seq") * 31) % 17) * 10_000_000_000 + F.col("seq"))


def tick_lines(spark, folder) -> DataFrame:
    """Text ticks with some lines broken on purpose."""
    e = F.col("event_id")
    date = F.when(e % 50 == 7, F.lit("15/04/2016")).otherwise(F.date_format("ts", "MM/dd/yyyy"))
    price = F.when(e % 50 == 11, F.lit("abc")).otherwise(F.col("value").cast("string"))
    volume = F.when(e % 50 == 13, F.lit("x")).otherwise((e % 90).cast("string"))
    return table(spark, folder, "events").select(
        e.alias("seq"),
        F.concat_ws(",", "event_type", date, F.date_format("ts", "HH:mm:ss"), price, volume).alias("value"))


def command_log(spark, folder) -> DataFrame:
    """A signup puts its user in focus, an error takes it out; other events are malformed text."""
    op = F.when(F.col("event_type") == "signup", "addMarketplayer").when(
        F.col("event_type") == "error", "removeMarketplayer")
    user = F.col("user_id").cast("string")
    return table(spark, folder, "events").select(
        "ts", F.when(op.isNotNull(), F.concat(op, F.lit("/"), user)).otherwise(user).alias("value"))


def param_log(spark, folder) -> DataFrame:
    e = F.col("event_id")
    return table(spark, folder, "events").filter("event_type = 'error'").select(
        F.when(e % 2 == 0, "correlationThreshold").otherwise("hubListSize").alias("name"),
        F.when(e % 2 == 0, (e % 20) / 100).otherwise((e % 9 + 1).cast("double")).alias("value"),
        "ts", e.alias("seq"))


def size_log(spark, folder, every: int, hours: list[float]) -> DataFrame:
    """Changes of ``windowSize`` in seconds at every so-many-th of the error events."""
    e = F.col("event_id")
    steps = F.array(*[F.lit(h * 3600.0) for h in hours])
    return table(spark, folder, "events").filter((F.col("event_type") == "error") & (e % every == 3)).select(
        F.lit("windowSize").alias("name"), F.element_at(steps, (F.floor(e / every) % len(hours) + 1).cast("int")).alias("value"),
        "ts", e.alias("seq"))


def visit_updates(spark, folder) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("node"),
        F.round(F.col("value") * 100).cast("bigint").alias("visits"), "ts", F.col("event_id").alias("seq"))


def nation_results(spark, folder) -> DataFrame:
    """Monthly trade between two nations relative to the month's mean pair: a pairwise result."""
    read = lambda name: table(spark, folder, name)
    a = read("nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("a"))
    b = read("nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("b"))
    buyers = read("customer").join(a, "c_nationkey").select(F.col("c_custkey").alias("o_custkey"), "a")
    sellers = read("supplier").join(b, "s_nationkey").select(F.col("s_suppkey").alias("l_suppkey"), "b")
    placed = read("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    trade = (
        read("lineitem").select("l_orderkey", "l_suppkey")
        .join(placed, "l_orderkey").join(buyers, "o_custkey").join(sellers, "l_suppkey")
        .filter("a != b")
        .groupBy(F.least("a", "b").alias("id0"), F.greatest("a", "b").alias("id1"),
                 F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("window_start"))
        .agg(F.count(F.lit(1)).alias("c"))
    )
    month = trade.groupBy("window_start").agg(F.sum("c").alias("total"))
    return trade.join(month, "window_start").select(
        "id0", "id1", "window_start",
        (F.col("window_start") + F.expr("INTERVAL 1 MONTH")).alias("window_end"),
        (F.col("c") * F.lit(300.0) / F.col("total")).alias("value"))


def nation_events(spark, folder) -> DataFrame:
    from tickweave.operators.graph import edge_changes

    return edge_changes(nation_results(spark, folder), 1.5)


def nation_graph(spark, folder) -> DataFrame:
    """All nation pairs that ever traded above the mean, as a directed adjacency."""
    from tickweave.operators.graph import symmetrize

    pairs = nation_events(spark, folder).filter("is_add").select("v0", "v1").distinct()
    return symmetrize(pairs)


def edge_lines(spark, folder) -> DataFrame:
    """The edge log as text, every seventh line with a wrong action."""
    events = nation_events(spark, folder)
    action = F.when(F.month("ts") == 7, "2").when(F.col("is_add"), "1").otherwise("0")
    return events.select(F.concat_ws(
        ",", "v0", "v1", F.date_format("ts", DATE_COMMA_TIME), action).alias("value"))


def instant_queries(spark, folder) -> DataFrame:
    """One snapshot query per quarter with orders."""
    quarter = F.date_trunc("quarter", "o_orderdate").cast("timestamp_ntz")
    return table(spark, folder, "orders").select(quarter.alias("start_ts")).distinct().select(
        F.date_format("start_ts", "yyyy-MM").alias("query_id"), "start_ts")


def period_queries(spark, folder) -> DataFrame:
    return instant_queries(spark, folder).withColumn(
        "end_ts", F.col("start_ts") + F.expr("INTERVAL 2 MONTH"))


def path_queries(spark, folder) -> DataFrame:
    k = F.col("s_suppkey")
    start = F.expr("TIMESTAMP_NTZ '1996-01-01 00:00:00' + make_ym_interval(0, CAST(s_suppkey % 36 AS INT))")
    return table(spark, folder, "supplier").select(
        k.alias("query_id"),
        start.alias("start_ts"),
        F.when(k % 5 == 0, start).otherwise(start + F.expr("INTERVAL 3 MONTH")).alias("end_ts"),
        F.concat(F.lit("NATION_"), F.col("s_nationkey")).alias("source"),
        F.concat(F.lit("NATION_"), (F.col("s_nationkey") + 1 + k % 24) % 25).alias("target"),
        F.element_at(F.array(*map(F.lit, ("SHORTEST", "CONTINUOUS", "EARLIEST", "REACHABILITY"))),
                     (k % 4 + 1).cast("int")).alias("type"))


def replay_requests(spark, folder) -> DataFrame:
    start = F.expr("TIMESTAMP_NTZ '1996-01-01 00:00:00' + make_ym_interval(0, CAST(s_suppkey % 24 AS INT))")
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("ticket"), start.alias("start_ts"),
        (start + F.expr("INTERVAL 12 MONTH")).alias("end_ts"),
        F.array(F.concat(F.lit("NATION_"), F.col("s_nationkey")),
                F.concat(F.lit("NATION_"), (F.col("s_nationkey") + 7) % 25)).alias("players"))


def pair_subscriptions(spark, folder) -> DataFrame:
    """Subscribe/unsubscribe log of nation pairs, in either order of the two ids."""
    return table(spark, folder, "orders").select(
        F.concat(F.lit("NATION_"), F.col("o_custkey") % 25).alias("id0"),
        F.concat(F.lit("NATION_"), F.floor(F.col("o_custkey") / 25) % 25).alias("id1"),
        F.col("o_orderdate").alias("ts"), (F.col("o_orderstatus") == "F").alias("is_add"),
        F.col("o_orderkey").alias("seq")).filter("id0 != id1")


def feed_messages(spark, folder) -> DataFrame:
    """A feed log: a quote per event and a quote list per event of some kinds."""
    e = F.col("event_id").cast("string")
    date, time = F.date_format("ts", "MM/dd/yyyy"), F.date_format("ts", "HH:mm:ss")
    entry = F.concat_ws("|", F.lit("NASDAQ"), "event_type", F.lit("-"), F.lit("NoExpiry"),
                        *[F.lit("x")] * 9, e)
    short = F.lit("NYSE|a|b|c|d")
    quote = F.concat_ws(",", F.lit("Quote"), e, F.lit("a"), F.lit("b"), F.col("value").cast("string"),
                        (F.col("event_id") % 90).cast("string"), date, time)
    return table(spark, folder, "events").select(
        F.when(F.col("event_type") == "signup", F.concat(F.lit("QUOTELIST,"), entry, F.lit("\n"), short))
        .when(F.col("event_type") == "error", F.concat(F.lit("ERROR,"), e))
        .when(F.col("event_type") == "view", F.concat(F.lit("DEPTH,"), e, F.lit(",1,2")))
        .otherwise(quote).alias("value"))


def recommendation_lines(spark, folder) -> DataFrame:
    user = F.col("user_id").cast("string")
    return table(spark, folder, "events").select(
        F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.concat_ws(
            ",", user, F.col("value").cast("string"), F.date_format("ts", DATE_COMMA_TIME),
            F.concat(F.lit("kw;"), "event_type"),
            F.concat_ws(";", user, ((F.col("user_id") + 1) % 15).cast("string")))).alias("value"))


def query_lines(spark, folder) -> DataFrame:
    """A log of snapshot queries, path queries, resets and malformed text."""
    e = F.col("event_id")
    at = F.date_format("ts", DATE_COMMA_TIME)
    later = F.date_format(F.col("ts") + F.expr("INTERVAL 1 HOUR"), DATE_COMMA_TIME)
    user, other = F.col("user_id").cast("string"), (F.col("user_id") + 1).cast("string")
    kind = F.when(e % 7 == 0, "unknown").when(e % 3 == 0, "shortest").otherwise("EARLIEST")
    return table(spark, folder, "events").select(
        e.alias("query_id"),
        F.when(F.col("event_type") == "click", at)
        .when(F.col("event_type") == "view", F.concat_ws(",", at, later))
        .when(F.col("event_type") == "signup", F.concat_ws(",", at, later, user, other, kind))
        .when(F.col("event_type") == "error", F.lit(""))
        .otherwise(F.concat_ws(",", at, user)).alias("value"))
