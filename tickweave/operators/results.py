"""Result lines, delivery, throughput and replay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.functions.ordered import explode_range
from tickweave.functions.sizing import broadcast_if_small
from tickweave.functions.text import format_instant, six_decimals
from tickweave.session import materialize

# fixed values: the prefixes of the result lines (``f``, ``w``, ``te``, ``hubList``, ``focusPip``,
# ``snapshots`` and their second fields) and the text "No path" are the wire format


def _line(df: DataFrame, *parts: Column | str) -> DataFrame:
    """One ``line`` per row; a null part (no ticket) is left out."""
    return df.select(F.concat_ws(",", *[F.lit(p) if isinstance(p, str) else p for p in parts]).alias("line"))


def _ticket(df: DataFrame) -> Column:
    return F.col("ticket").cast("string") if "ticket" in df.columns else F.lit(None).cast("string")


def format_correlation(df: DataFrame, time: str = "window_end") -> DataFrame:
    """``f,[ticket,]id0,id1,date,time,value``."""
    return _line(df, "f", _ticket(df), F.col("id0"), F.col("id1"), format_instant(F.col(time)),
                 six_decimals(F.col("value")))


def format_web(df: DataFrame, time: str = "ts") -> DataFrame:
    """``w,[ticket,]symbol,date,time,value``."""
    return _line(df, "w", _ticket(df), F.col("symbol"), format_instant(F.col(time)),
                 F.col("value").cast("string"))


def format_transfer(df: DataFrame, time: str = "window_end") -> DataFrame:
    """``te,te_response,...`` or, with a ticket, ``te,te_replay_response,ticket,...``."""
    kind = F.when(_ticket(df).isNull(), F.lit("te_response")).otherwise(F.lit("te_replay_response"))
    return _line(df, "te", kind, _ticket(df), F.col("id0"), F.col("id1"),
                 format_instant(F.col(time)), six_decimals(F.col("value")))


def format_hubs(df: DataFrame) -> DataFrame:
    """``hubList,[ticket,]id,id,...``."""
    return _line(df, "hubList", _ticket(df), F.array_join("hubs", ","))


def format_focus_edges(df: DataFrame) -> DataFrame:
    """``focusPip,[ticket,]resultsNodes_response,v0,v1,date,time,1|0``."""
    action = F.when(F.col("is_add"), F.lit("1")).otherwise(F.lit("0"))
    return _line(df, "focusPip", _ticket(df), "resultsNodes_response", F.col("v0"), F.col("v1"),
                 format_instant(F.col("ts")), action)


def format_focus_suggestions(df: DataFrame, text: str = "value") -> DataFrame:
    """``focusPip,suggestion_response,[ticket,]text``; empty suggestions are dropped."""
    return _line(df.filter(F.length(text) > 0), "focusPip", "suggestion_response", _ticket(df), F.col(text))


def format_snapshots(df: DataFrame) -> DataFrame:
    """``snapshots,snapshot_response,[ticket,]part/parts,json``; parts count from 1."""
    place = F.concat_ws("/", (F.col("part") + 1).cast("string"), F.col("parts").cast("string"))
    return _line(df, "snapshots", "snapshot_response", _ticket(df), place, F.col("snapshot"))


def format_paths(df: DataFrame) -> DataFrame:
    """``snapshots,path_response,[ticket,]1,start,end,path``, or ``...,No path``."""
    found = F.concat_ws(",", F.lit("1"), format_instant(F.col("start_ts")),
                        format_instant(F.col("end_ts")), F.array_join("path", ","))
    return _line(df, "snapshots", "path_response", _ticket(df),
                 F.when(F.col("path_found") == 1, found).otherwise(F.lit("No path")))


def format_edge_log(df: DataFrame) -> DataFrame:
    """``v0,v1,MM/dd/yyyy,HH:mm:ss,1|0``, the edge log's own layout."""
    action = F.when(F.col("is_add"), F.lit("1")).otherwise(F.lit("0"))
    return _line(df, F.col("v0"), F.col("v1"), format_instant(F.col("ts")), action)


def write_results(df: DataFrame, path: str, fmt: str = "text", mode: str = "append") -> None:
    """Deliver results as files, one writer per partition."""
    df.write.format(fmt).mode(mode).save(path)


def throughput(df: DataFrame, time: str = "ts", every: str = "60 seconds") -> DataFrame:
    """Tuples per second in each tumbling period."""
    from tickweave.functions.cells import interval_micros

    seconds = interval_micros(every) / 1_000_000
    return df.groupBy(F.window(time, every).alias("w")).agg(
        (F.count(F.lit(1)) / F.lit(seconds)).alias("tuples_per_sec")
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "tuples_per_sec")


PLAYER_BUCKETS = 32
WRITERS = 4            # tasks that share one day and bucket
DAYS_PER_TASK = 1_000_000


def _sides(results: DataFrame) -> DataFrame:
    """Each result once for each of its two ids, as ``_player``; ``_side`` says which one it is."""
    return results.withColumn("_s", F.explode(F.array(
        F.struct(F.col("id0").alias("player"), F.lit(0).alias("side")),
        F.struct(F.col("id1").alias("player"), F.lit(1).alias("side"))))).select(
        *results.columns, F.col("_s.player").alias("_player"), F.col("_s.side").alias("_side"))


def _asked(requests: DataFrame) -> DataFrame:
    """One row per request and player; ``_request`` numbers the requests."""
    numbered = materialize(requests.withColumn("_request", F.monotonically_increasing_id()))
    return materialize(numbered.filter("start_ts <= end_ts").select(
        "_request", "ticket", "start_ts", "end_ts", F.explode(F.array_distinct("players")).alias("_player")))


def _once_per_request(found: DataFrame, asked: DataFrame, columns: list[str]) -> DataFrame:
    """Keep a result that both of its ids are asked for on its first side only."""
    first = asked.select("_request", F.col("_player").alias("id0")).distinct()
    second = found.filter("_side = 1").join(broadcast_if_small(first), ["_request", "id0"], "left_anti")
    return found.filter("_side = 0").select("ticket", *columns).unionByName(second.select("ticket", *columns))


def replay_selection(results: DataFrame, requests: DataFrame, time: str = "window_end") -> DataFrame:
    """Stored results of each request's period and players, tagged with its ticket.

    A result qualifies when either id is asked for, and appears once per request.
    """
    asked = _asked(requests)
    found = _sides(results).join(
        broadcast_if_small(asked).alias("a"), ["_player"]).filter(
        (F.col(time) >= F.col("a.start_ts")) & (F.col(time) <= F.col("a.end_ts")))
    return _once_per_request(found, asked, results.columns)


def store_results(
    results: DataFrame, path: str, time: str = "window_end", buckets: int = PLAYER_BUCKETS, mode: str = "append",
) -> None:
    """Results for replay, partitioned by day (since the epoch) and player bucket, sorted by player.

    A result is stored once for each of its ids, so a request reads the days and buckets it asks for.
    """
    rows = _sides(results).withColumns({
        "_day": F.unix_date(F.to_date(time)), "_bucket": F.pmod(F.xxhash64("_player"), F.lit(buckets)).cast("int")})
    rows = rows.repartition("_day", "_bucket", F.pmod(F.xxhash64("id0", "id1"), F.lit(WRITERS)))
    rows.sortWithinPartitions("_day", "_bucket", "_player", time).write.mode(mode).partitionBy("_day", "_bucket").parquet(path)


def replay_stored(
    spark: SparkSession, path: str, requests: DataFrame, time: str = "window_end", buckets: int = PLAYER_BUCKETS,
) -> DataFrame:
    """``replay_selection`` of what ``store_results`` wrote.

    Requests become rows of (day, bucket, player) for the days that are stored. The days and buckets
    asked for, no more than there are folders, let Spark prune the scan at run time.
    """
    stored = spark.read.parquet(path)
    columns = [c for c in stored.columns if not c.startswith("_")]
    folder = ["_day", "_bucket"]
    asked = _asked(requests)
    first, last = F.unix_date(F.to_date("start_ts")), F.unix_date(F.to_date("end_ts"))
    length = asked.agg(F.sum((last - first + 1).cast("bigint")).alias("n")).first()["n"] or 0
    tasks = min(int(spark.conf.get("spark.sql.shuffle.partitions")), length // DAYS_PER_TASK + 1)
    placed = asked.withColumn("_bucket", F.pmod(F.xxhash64("_player"), F.lit(buckets)).cast("int"))
    days = explode_range(placed.repartition(tasks), first, last, "_day").withColumn("_day", F.col("_day").cast("int"))
    days = materialize(days.join(broadcast_if_small(stored.select(*folder).distinct()), folder, "left_semi"))
    folders = days.filter("start_ts <= end_ts").select(*folder).distinct()
    found = stored.join(broadcast_if_small(folders), folder, "left_semi").join(
        broadcast_if_small(days).alias("a"), [*folder, "_player"]).filter(
        (F.col(time) >= F.col("a.start_ts")) & (F.col(time) <= F.col("a.end_ts")))
    return _once_per_request(found, asked, columns)
