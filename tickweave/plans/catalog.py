"""The registered queries: one per operator, over the whole driver tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.functions.cells import micros
from tickweave.operators import change, correlation, entropy, graph, hubs, ordering, pairs, params
from tickweave.operators import paths as path_ops
from tickweave.operators import results, snapshots
from tickweave.operators.walk_store import WalkStore
from tickweave.plans import views as v
from tickweave.session import materialize, pin_utc, shared_folder
from tickweave.sources import logs
from tickweave.sources import ticks as tick_source
from tickweave.streaming.correlation import hy_correlation_stream as hy_correlation_stream_of
from tickweave.streaming.entropy import transfer_entropy_stream as transfer_entropy_stream_of
from tickweave.streaming.keyed import edge_changes_with_parameter_stream, top_hubs_ranked_stream
from tickweave.streaming.ticks import write_stream

Query = Callable[[SparkSession, str], DataFrame]

SIZE, ADVANCE = "1 day", "6 hours"  # the events span 30 days
_registry: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(pin_utc(spark), folder)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    _registry[fn.__name__] = run
    return run


def all_queries() -> dict[str, Query]:
    return dict(_registry)


def _clean(ticks: DataFrame) -> DataFrame:
    return ordering.dedup_same_timestamp(ticks)


def _rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in (names or ("value",))})


def _written_lines(spark: SparkSession, lines: DataFrame, separator: str = "\n") -> str:
    """Put text rows into the shared folder, for the file readers."""
    path = f"{shared_folder(spark)}/tickweave/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    lines.select("value").write.option("lineSep", separator).text(path)
    return path


def _type_windows(spark, folder) -> DataFrame:
    return _rounded(correlation.hy_correlation_sliding(
        _clean(v.ticks_type(spark, folder)), SIZE, ADVANCE, scale=100))


# --- sources -------------------------------------------------------------------------------------

@query
def parse_ticks(spark, folder):
    return tick_source.parse_ticks(v.tick_lines(spark, folder))[0].select(
        "seq", "symbol", "ts", "value", "volume")


@query
def parse_ticks_rejects(spark, folder):
    return tick_source.parse_ticks(v.tick_lines(spark, folder))[1]


@query
def parse_ticks_with_arrival(spark, folder):
    lines = v.tick_lines(spark, folder).select(
        F.concat_ws(",", (F.col("seq") + 1700000000123).cast("string"), F.concat("value", F.lit("\r"))).alias("value"))
    return tick_source.parse_ticks(lines, with_arrival_ms=True)[0].select(
        "arrival_ms", "symbol", "ts", "value", "volume")


@query
def feed_quotes(spark, folder):
    path = _written_lines(spark, v.feed_messages(spark, folder), "!")
    return tick_source.feed_log_to_tables(tick_source.read_feed_log(spark, path))[0]


@query
def feed_symbols(spark, folder):
    path = _written_lines(spark, v.feed_messages(spark, folder), "!")
    return tick_source.feed_log_to_tables(tick_source.read_feed_log(spark, path))[1]


@query
def feed_depth_and_errors(spark, folder):
    _, _, depth, errors = tick_source.feed_log_to_tables(v.feed_messages(spark, folder))
    return depth.withColumn("route", F.lit("depth")).unionByName(errors.withColumn("route", F.lit("errors")))


@query
def read_symbol_list(spark, folder):
    names = v.table(spark, folder, "customer").select(
        F.when(F.col("c_custkey") % 10 == 0, F.lit("")).otherwise(
            F.concat(F.lit("NASDAQ�"), "c_name", F.lit("�NoExpiry"))).alias("value"))
    return tick_source.read_symbol_list(spark, _written_lines(spark, names))


@query
def parse_edge_log(spark, folder):
    return logs.parse_edge_log(v.edge_lines(spark, folder))[0]


@query
def parse_edge_log_rejects(spark, folder):
    return logs.parse_edge_log(v.edge_lines(spark, folder))[1]


@query
def read_edge_files(spark, folder):
    lines = v.edge_lines(spark, folder)
    blanks = lines.filter("value LIKE '%/01/%'").select(F.concat(F.lit(" "), "value").alias("value"))
    path = _written_lines(spark, lines.unionByName(blanks))
    return logs.read_edge_files(spark, path)


@query
def symbol_key(spark, folder):
    lines = v.tick_lines(spark, folder).select(
        "seq", F.when(F.col("seq") % 5 == 0, F.col("seq").cast("string"))
        .when(F.col("seq") % 5 == 1, F.concat(F.lit(","), "value")).otherwise(F.col("value")).alias("value"))
    return lines.select("seq", tick_source.symbol_key("value").alias("symbol"))


@query
def parse_player_commands(spark, folder):
    return logs.parse_player_commands(v.command_log(spark, folder))


@query
def parse_snapshot_queries(spark, folder):
    return logs.parse_graph_queries(v.query_lines(spark, folder))[0]


@query
def parse_path_queries(spark, folder):
    return logs.parse_graph_queries(v.query_lines(spark, folder))[1]


@query
def parse_graph_query_rejects(spark, folder):
    return logs.parse_graph_queries(v.query_lines(spark, folder))[2]


@query
def parse_recommendations(spark, folder):
    parsed = logs.parse_recommendations(v.recommendation_lines(spark, folder))
    return parsed.select("stock", "impact", "ts", F.array_join("keywords", "+").alias("keywords"),
                         F.explode("related").alias("related_stock"))


# --- ordering and filters ------------------------------------------------------------------------

@query
def clamp_out_of_order(spark, folder):
    return ordering.clamp_out_of_order(v.late_ticks(spark, folder)).select("seq", "symbol", "ts", "value")


@query
def dedup_same_timestamp(spark, folder):
    clamped = ordering.clamp_out_of_order(v.late_ticks(spark, folder))
    return ordering.dedup_same_timestamp(clamped).select("seq", "symbol", "ts", "value")


@query
def filter_known_symbols(spark, folder):
    symbols = v.table(spark, folder, "customer").filter("c_acctbal > 0").select(
        F.col("c_custkey").cast("string").alias("symbol"))
    return ordering.filter_known_symbols(v.ticks_user(spark, folder), symbols).select("seq", "symbol", "ts", "value")


@query
def filter_known_symbols_from_arrival(spark, folder):
    """The first symbol list arrives after some ticks; those are dropped."""
    symbols = v.table(spark, folder, "customer").filter("c_acctbal > 0").select(
        F.col("c_custkey").cast("string").alias("symbol"),
        F.expr("TIMESTAMP_NTZ '2024-01-05 00:00:00' + make_dt_interval(CAST(c_custkey % 20 AS INT))").alias("ts"))
    return ordering.filter_known_symbols(v.ticks_user(spark, folder), symbols).select("seq", "symbol", "ts", "value")


@query
def filter_focus_players(spark, folder):
    commands = logs.parse_player_commands(v.command_log(spark, folder))
    return ordering.filter_focus_players(v.ticks_user(spark, folder), commands).select("seq", "symbol", "ts")


@query
def filter_focus_players_merged(spark, folder):
    """The same with a command log treated as too long to broadcast."""
    commands = logs.parse_player_commands(v.command_log(spark, folder))
    return ordering.filter_focus_players(
        v.ticks_user(spark, folder), commands, broadcast_rows=0).select("seq", "symbol", "ts")


@query
def attach_symbol_names(spark, folder):
    names = v.table(spark, folder, "customer").filter("c_custkey % 3 != 0").select(
        F.col("c_custkey").cast("string").alias("symbol"), F.col("c_name").alias("name"))
    return ordering.attach_symbol_names(v.ticks_user(spark, folder), names).select("seq", "symbol", "name")


@query
def drop_repeated_records(spark, folder):
    return ordering.drop_repeated_records(v.ticks_type(spark, folder).select("symbol", "seq"))


@query
def limit_symbols(spark, folder):
    return ordering.limit_symbols(v.ticks_user(spark, folder), 20).select("seq", "symbol")


@query
def subscribe_pairs(spark, folder):
    log = v.pair_subscriptions(spark, folder)
    return _rounded(ordering.subscribe_pairs(v.nation_results(spark, folder), log)).select(
        "id0", "id1", "window_end", "value")


@query
def tag_kind(spark, folder):
    """Financial and web ticks through one correlation; kinds never pair with each other."""
    web = v.ticks_user(spark, folder).withColumn(
        "symbol", (F.col("symbol").cast("bigint") % 7).cast("string"))
    both = ordering.union_kinds(
        ordering.tag_kind(v.ticks_type(spark, folder), "f"), ordering.tag_kind(web, "w"))
    return _rounded(correlation.hy_correlation(_clean(both), scale=100))


# --- correlation ---------------------------------------------------------------------------------

@query
def tick_intervals(spark, folder):
    return correlation.tick_intervals(_clean(v.ticks_user(spark, folder)), scale=100)


@query
def symbol_pairs(spark, folder):
    return pairs.symbol_pairs(v.ticks_user(spark, folder))


@query
def overlap_join(spark, folder):
    intervals = correlation.tick_intervals(_clean(v.ticks_type(spark, folder)), scale=100)
    return correlation.overlap_join(intervals)


@query
def hy_correlation(spark, folder):
    return _rounded(correlation.hy_correlation(_clean(v.ticks_type(spark, folder)), scale=100))


@query
def hy_correlation_users(spark, folder):
    return _rounded(correlation.hy_correlation(_clean(v.ticks_user(spark, folder)), scale=100))


@query
def hy_correlation_sliding(spark, folder):
    return _type_windows(spark, folder)


@query
def hy_correlation_sliding_spike(spark, folder):
    """Prices with rare spikes and no scale: a spike must leave nothing behind in later windows."""
    windows = _rounded(correlation.hy_correlation_sliding(
        _clean(v.spiked_ticks(spark, folder)), SIZE, ADVANCE))
    return windows.withColumn("value", F.when(F.col("value") == 0, F.lit(0.0)).otherwise(F.col("value")))


ARRIVALS = 12          # micro-batches of a stream query at least
ROWS_PER_ARRIVAL = 500_000
STATE_PARTITIONS = 16  # of a stream's state at most


def _slices(df: DataFrame, time: str = "ts") -> int:
    return max(ARRIVALS, -(-df.agg(F.count(time).alias("n")).first()["n"] // ROWS_PER_ARRIVAL))


def _arriving(
    df: DataFrame, folder: str, time: str = "ts", slices: int | None = None, rows: int = ROWS_PER_ARRIVAL
) -> DataFrame:
    """``df`` as a stream whose files arrive in time order, each a slice of it, one a micro-batch.

    Slices are dealt out in one pass; each is then read and written alone, so that files come in order.
    Streams that are read together need equal ``slices``, or one would run ahead of the other; they
    then have a file for each of them, if need be an empty one.
    """
    spark, at = df.sparkSession, micros(time)
    span = df.agg(F.min(at).alias("lo"), F.max(at).alias("hi"), F.count(time).alias("n")).first()
    arrivals = slices or max(ARRIVALS, -(-span["n"] // rows))
    low, width = span["lo"] or 0, ((span["hi"] or 0) - (span["lo"] or 0)) // arrivals + 1
    dealt = f"{folder}-dealt"
    numbered = df.filter(at.isNotNull()).withColumn("_slice", F.floor((at - low) / width).cast("int"))
    numbered.write.partitionBy("_slice").parquet(dealt)
    written = spark.read.schema(numbered.schema).parquet(dealt)
    filled = sorted(row["_slice"] for row in written.select("_slice").distinct().collect())
    for i in range(slices) if slices else filled or [0]:
        part = written.filter(F.col("_slice") == i).drop("_slice")
        # small row groups, so that several tasks can read one file
        part.coalesce(1).write.mode("append").option("parquet.block.size", 1 << 20).parquet(folder)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)


@query
def hy_correlation_stream(spark, folder):
    """The events as a stream of ticks in a dozen micro-batches, windows written as they close."""
    work = f"{shared_folder(spark)}/tickweave/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    ticks = v.ticks_type(spark, folder)
    origin = ticks.agg(F.min(micros("ts")).alias("lo")).first()["lo"] or 0
    windows = hy_correlation_stream_of(_arriving(ticks, f"{work}/in"), SIZE, ADVANCE, origin=origin, scale=100)
    write_stream(windows, f"{work}/out", f"{work}/checkpoint").awaitTermination()
    return _rounded(spark.read.schema(windows.schema).parquet(f"{work}/out"))


@query
def hy_correlation_sliding_with_parameter(spark, folder):
    """The window size changes while ticks flow."""
    return _rounded(correlation.hy_correlation_sliding(
        _clean(v.ticks_type(spark, folder)), SIZE, ADVANCE, scale=100,
        size_log=v.size_log(spark, folder, 40, [12, 30, 48, 18, 96, 24])))


@query
def hy_correlation_late(spark, folder):
    """Clamp, de-duplicate and correlate a stream with late ticks."""
    clean = _clean(ordering.clamp_out_of_order(v.late_ticks(spark, folder)))
    return _rounded(correlation.hy_correlation_sliding(clean, "2 days", "12 hours", scale=100))


@query
def pairwise_measure(spark, folder):
    return _rounded(correlation.pairwise_measure(
        _clean(v.ticks_type(spark, folder)), "correlation", size="5 days", advance="1 day", scale=100))


@query
def transfer_entropy_stream(spark, folder):
    """Sliding transfer entropy as basic windows close, in a dozen micro-batches."""
    work = f"{shared_folder(spark)}/tickweave/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    found = transfer_entropy_stream_of(_arriving(v.ticks_type(spark, folder), f"{work}/in"), "6 hours")
    write_stream(found, f"{work}/out", f"{work}/checkpoint").awaitTermination()
    return _rounded(spark.read.schema(found.schema).parquet(f"{work}/out"))


# --- transfer entropy ----------------------------------------------------------------------------

@query
def sample_basic_windows(spark, folder):
    return entropy.sample_basic_windows(v.ticks_user(spark, folder), "6 hours")


@query
def discretize(spark, folder):
    return entropy.discretize(v.ticks_type(spark, folder), "1 hour")


@query
def transfer_entropy(spark, folder):
    return _rounded(entropy.transfer_entropy(v.ticks_type(spark, folder), "1 hour"))


@query
def transfer_entropy_sliding(spark, folder):
    return _rounded(entropy.transfer_entropy_sliding(v.ticks_type(spark, folder), "6 hours"))


@query
def emit_on_change(spark, folder):
    rows = _type_windows(spark, folder).select("id0", "id1", "window_end", "value")
    return change.emit_on_change(rows, ["id0", "id1"], "window_end", rel=0.2)


@query
def emit_on_change_nulls(spark, folder):
    """Results that are missing, the first of a pair among them, are no values."""
    missing = F.hour("window_end") >= 18
    rows = _type_windows(spark, folder).select(
        "id0", "id1", "window_end", F.when(~missing, F.col("value")).alias("value"))
    return change.emit_on_change(rows, ["id0", "id1"], "window_end", rel=0.2)


# --- dynamic graph and hubs ----------------------------------------------------------------------

@query
def canonical_edge(spark, folder):
    a, b = F.col("event_type"), F.col("user_id").cast("string")
    v0, v1 = graph.canonical_edge(a, b)
    return v.table(spark, folder, "events").select("event_id", v0.alias("v0"), v1.alias("v1"))


@query
def edge_changes(spark, folder):
    return graph.edge_changes(_type_windows(spark, folder), 0.08)


@query
def edge_changes_transfer(spark, folder):
    """Both directions of a directed measure at one time make one state of the edge."""
    windows = _rounded(entropy.transfer_entropy_sliding(v.ticks_type(spark, folder), "6 hours"))
    return graph.edge_changes(windows, 0.5)


@query
def edge_changes_with_parameter(spark, folder):
    """The threshold follows the parameter log."""
    windows = params.with_parameter(
        _type_windows(spark, folder), v.param_log(spark, folder), "correlationThreshold", 0.7, "window_end")
    return graph.edge_changes(windows, "correlationThreshold")


@query
def edge_changes_stream_with_parameter(spark, folder):
    """The same on streams of results and of threshold changes, as far as both have come."""
    work = f"{shared_folder(spark)}/tickweave/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    results, log = materialize(_type_windows(spark, folder)), v.param_log(spark, folder)
    slices = max(_slices(results, "window_end"), _slices(log))
    windows = _arriving(results, f"{work}/windows", "window_end", slices)
    changes = _arriving(log, f"{work}/changes", slices=slices)
    found = edge_changes_with_parameter_stream(windows, changes, lateness="2 days")
    write_stream(found, f"{work}/out", f"{work}/checkpoint", partitions=STATE_PARTITIONS).awaitTermination()
    return spark.read.schema(found.schema).parquet(f"{work}/out")


@query
def edge_intervals(spark, folder):
    return graph.edge_intervals(v.nation_events(spark, folder))


@query
def vertex_first_seen(spark, folder):
    return graph.vertex_first_seen(v.nation_events(spark, folder))


@query
def symmetrize(spark, folder):
    return graph.symmetrize(v.nation_events(spark, folder))


@query
def expected_visits(spark, folder):
    return _rounded(hubs.expected_visits(v.nation_graph(spark, folder)), "visits", digits=4)


@query
def visit_counts_mc(spark, folder):
    return hubs.visit_counts_mc(v.nation_graph(spark, folder))


@query
def update_walks(spark, folder):
    """Walks on the edges of all events but the last month's, updated by that month."""
    events = v.nation_events(spark, folder)
    last = events.agg(F.max("ts").alias("ts")).first()["ts"]
    before = graph.edge_intervals(events.filter(F.col("ts") < last)).filter("valid_to IS NULL")
    edges = materialize(graph.symmetrize(before).select("src", "dst"))
    changes = graph.symmetrize(events.filter(F.col("ts") == last)).select("src", "dst", "is_add")
    walks = hubs.walk_table(edges)
    return hubs.visit_counts(hubs.update_walks(walks, edges, changes, seed=8))


@query
def update_walks_incremental(spark, folder):
    """The same update as a delta of stored walks."""
    events = v.nation_events(spark, folder)
    last = events.agg(F.max("ts").alias("ts")).first()["ts"]
    before = graph.edge_intervals(events.filter(F.col("ts") < last)).filter("valid_to IS NULL")
    changes = graph.symmetrize(events.filter(F.col("ts") == last)).select("src", "dst", "is_add")
    work = f"{shared_folder(spark)}/tickweave/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    store = WalkStore(spark, work, buckets=16).create(graph.symmetrize(before).select("src", "dst"))
    store.update(changes, 1)
    return store.visit_counts()


@query
def update_walks_checks(spark, folder):
    """Per node after two updates (the last month's changes, then undone): its walks' starts,
    duplicated steps and hops over edges that are gone."""
    events = v.nation_events(spark, folder)
    last = events.agg(F.max("ts").alias("ts")).first()["ts"]
    before = graph.edge_intervals(events.filter(F.col("ts") < last)).filter("valid_to IS NULL")
    edges = materialize(graph.symmetrize(before).select("src", "dst"))
    changes = graph.symmetrize(events.filter(F.col("ts") == last)).select("src", "dst", "is_add")
    walks = hubs.update_walks(hubs.walk_table(edges), edges, changes, seed=8)
    gone = changes.filter("NOT is_add").select("src", "dst")
    after = materialize(edges.join(gone, ["src", "dst"], "left_anti").unionByName(
        changes.filter("is_add").select("src", "dst")).distinct())
    undone = changes.withColumn("is_add", ~F.col("is_add"))
    return hubs.walk_checks(hubs.update_walks(walks, after, undone, seed=9), edges)


@query
def latest_visits(spark, folder):
    return hubs.latest_visits(v.visit_updates(spark, folder))


@query
def top_hubs(spark, folder):
    return hubs.top_hubs(hubs.latest_visits(v.visit_updates(spark, folder)))


@query
def top_hubs_windowed(spark, folder):
    return hubs.top_hubs_windowed(v.visit_updates(spark, folder), 3, "6 hours")


@query
def top_hubs_windowed_with_parameter(spark, folder):
    return hubs.top_hubs_windowed(
        v.visit_updates(spark, folder), 10, "6 hours", v.param_log(spark, folder))


@query
def top_hubs_stream(spark, folder):
    """Ranked hub lists as periods close, in a dozen micro-batches."""
    work = f"{shared_folder(spark)}/tickweave/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    found = top_hubs_ranked_stream(
        _arriving(v.visit_updates(spark, folder), f"{work}/in", rows=4 * ROWS_PER_ARRIVAL), 3, "6 hours", "1 hour")
    write_stream(found, f"{work}/out", f"{work}/checkpoint", partitions=STATE_PARTITIONS).awaitTermination()
    start, end = (F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end"))
    return spark.read.schema(found.schema).parquet(f"{work}/out").select(start, end, "rank", "node", "visits")


@query
def top_hubs_windowed_with_period(spark, folder):
    """The period of the hub timer and the list size change while updates flow."""
    return hubs.top_hubs_windowed(
        v.visit_updates(spark, folder), 10, "6 hours", v.param_log(spark, folder),
        period_log=v.size_log(spark, folder, 20, [2, 10.5, 1, 30, 5]))


# --- time travel ---------------------------------------------------------------------------------

def _nation_history(spark, folder) -> DataFrame:
    return materialize(graph.edge_intervals(v.nation_events(spark, folder)))


@query
def snapshot_at(spark, folder):
    return snapshots.snapshot_at(_nation_history(spark, folder), v.instant_queries(spark, folder))


@query
def snapshot_with_ticket(spark, folder):
    """Queries with an optional column that most of them leave null."""
    asked = v.instant_queries(spark, folder).withColumn(
        "start_ts", F.col("start_ts") - F.expr("INTERVAL 8 MONTH")).withColumn(
        "ticket", F.when(F.month("start_ts") == 5, F.concat(F.lit("t"), "query_id")))
    return snapshots.snapshot_at(_nation_history(spark, folder), asked)


@query
def snapshot_before_history(spark, folder):
    """Instants before the first edge have an answer too: the empty graph."""
    early = v.instant_queries(spark, folder).withColumn(
        "start_ts", F.col("start_ts") - F.expr("INTERVAL 3 YEAR"))
    return snapshots.snapshot_at(_nation_history(spark, folder), early)


@query
def snapshots_between(spark, folder):
    return snapshots.snapshots_between(_nation_history(spark, folder), v.period_queries(spark, folder))


@query
def snapshot_json(spark, folder):
    alive = snapshots.snapshot_at(_nation_history(spark, folder), v.instant_queries(spark, folder))
    return snapshots.snapshot_json(alive, ["query_id"], "start_ts")


@query
def paths(spark, folder):
    answers = path_ops.paths(_nation_history(spark, folder), v.path_queries(spark, folder))
    return answers.withColumn("path", F.array_join("path", ">"))


# --- results and parameters ----------------------------------------------------------------------

@query
def format_correlation(spark, folder):
    return results.format_correlation(_type_windows(spark, folder))


@query
def format_web(spark, folder):
    return results.format_web(v.ticks_user(spark, folder))


@query
def format_transfer(spark, folder):
    rows = _rounded(entropy.transfer_entropy(v.ticks_type(spark, folder), "1 hour"))
    ticket = F.when(F.col("id0") < F.col("id1"), F.lit(7))
    return results.format_transfer(rows.withColumn("ticket", ticket))


@query
def format_hubs(spark, folder):
    ranked = hubs.top_hubs_windowed(v.visit_updates(spark, folder), 3, "6 hours")
    return results.format_hubs(hubs.hub_list(ranked, ["window_end"]))


@query
def format_focus_edges(spark, folder):
    return results.format_focus_edges(v.nation_events(spark, folder).withColumn("ticket", F.month("ts")))


@query
def format_focus_suggestions(spark, folder):
    return results.format_focus_suggestions(v.recommendation_lines(spark, folder))


@query
def format_snapshots(spark, folder):
    alive = snapshots.snapshot_at(_nation_history(spark, folder), v.instant_queries(spark, folder))
    return results.format_snapshots(snapshots.snapshot_json(alive, ["query_id"], "start_ts"))


@query
def format_paths(spark, folder):
    return results.format_paths(
        path_ops.paths(_nation_history(spark, folder), v.path_queries(spark, folder)))


@query
def write_results(spark, folder):
    """Lines written by the file sink, read back."""
    path = f"{shared_folder(spark)}/tickweave/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    results.write_results(results.format_web(v.ticks_type(spark, folder)), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query
def throughput(spark, folder):
    return _rounded(results.throughput(v.ticks_type(spark, folder)), "tuples_per_sec")


@query
def replay_selection(spark, folder):
    return _rounded(results.replay_selection(
        v.nation_results(spark, folder), v.replay_requests(spark, folder))).select(
        "ticket", "id0", "id1", "window_end", "value")


@query
def replay_stored(spark, folder):
    """The same from results stored by day and player."""
    path = f"{shared_folder(spark)}/tickweave/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    results.store_results(v.nation_results(spark, folder), path, buckets=4)
    return _rounded(results.replay_stored(spark, path, v.replay_requests(spark, folder), buckets=4)).select(
        "ticket", "id0", "id1", "window_end", "value")


@query
def with_parameter(spark, folder):
    return params.with_parameter(
        v.ticks_type(spark, folder), v.param_log(spark, folder), "correlationThreshold", 0.7).select(
        "seq", "ts", "correlationThreshold")


@query
def with_parameter_merged(spark, folder):
    """The same with a log treated as too long for a step function."""
    return params.with_parameter(
        v.ticks_type(spark, folder), v.param_log(spark, folder), "correlationThreshold", 0.7,
        step_changes=0).select("seq", "ts", "correlationThreshold")
