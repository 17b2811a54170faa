"""Edge logs, player commands, graph queries and recommendation lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.functions.text import field, parse_instant

# fixed values: the path query types
PATH_TYPES = ("SHORTEST", "CONTINUOUS", "EARLIEST", "REACHABILITY")


def parsed_edges(lines: DataFrame) -> DataFrame:
    """``v0,v1,MM/dd/yyyy,HH:mm:ss,1|0`` with an ``accepted`` flag; keeps other columns."""
    parts = F.split("value", ",")
    kept = [c for c in lines.columns if c != "value"]
    return lines.filter(F.col("value").isNotNull()).select(
        *kept,
        F.col("value").alias("line"),
        field(parts, 0).alias("v0"),
        field(parts, 1).alias("v1"),
        parse_instant(field(parts, 2), field(parts, 3)).alias("ts"),
        (field(parts, 4) == "1").alias("is_add"),
        (
            (F.size(parts) == 5)
            & F.coalesce(field(parts, 4).isin("0", "1"), F.lit(False))
            & parse_instant(field(parts, 2), field(parts, 3)).isNotNull()
        ).alias("accepted"),
    )


def parse_edge_log(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edge events and the lines that are not one."""
    parsed = parsed_edges(lines)
    return (
        parsed.filter("accepted").drop("line", "accepted"),
        parsed.filter(~F.col("accepted")).select("line"),
    )


def read_edge_files(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Edge lines of a folder, blank and space-led lines left out."""
    reader = spark.readStream if streaming else spark.read
    return reader.text(path).filter((F.length("value") > 0) & ~F.col("value").startswith(" "))


def parse_player_commands(log: DataFrame) -> DataFrame:
    """``op/id,id,...`` rows with a ``ts`` become one ``(ts, player, is_add)`` row per player."""
    parts = F.split("value", "/")
    kept = [c for c in log.columns if c != "value"]
    return (
        log.filter(F.size(parts) == 2)
        .select(
            *kept,
            F.explode(F.split(field(parts, 1), ",")).alias("player"),
            field(parts, 0).startswith("add").alias("is_add"),
        )
        .filter(F.length("player") > 0)
    )


def parse_graph_queries(log: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Split a query log into snapshot queries, path queries and rejects.

    Empty text resets the query and yields nothing. A snapshot query names one or two instants
    and uses the first; a path query is ``d,t,d,t,A,B,type``.
    """
    parts = F.split("value", ",")
    kept = [c for c in log.columns if c != "value"]
    parsed = log.filter(F.length("value") > 0).select(
        *kept,
        F.col("value").alias("line"),
        F.size(parts).alias("fields"),
        parse_instant(field(parts, 0), field(parts, 1)).alias("start_ts"),
        parse_instant(field(parts, 2), field(parts, 3)).alias("second_ts"),
        field(parts, 4).alias("source"),
        field(parts, 5).alias("target"),
        F.upper(field(parts, 6)).alias("type"),
    )
    is_snapshot = F.col("fields").isin(2, 4) & F.col("start_ts").isNotNull()
    is_path = (
        (F.col("fields") == 7)
        & F.col("start_ts").isNotNull()
        & F.col("second_ts").isNotNull()
        & F.coalesce(F.col("type").isin(*PATH_TYPES), F.lit(False))
    )
    snapshots = parsed.filter(is_snapshot).select(*kept, "start_ts", F.col("start_ts").alias("end_ts"))
    paths = parsed.filter(is_path).select(
        *kept, "start_ts", F.col("second_ts").alias("end_ts"), "source", "target", "type")
    rejects = parsed.filter(~is_snapshot & ~is_path).select("line")
    return snapshots, paths, rejects


def parse_recommendations(lines: DataFrame) -> DataFrame:
    """``stock,impact,date,time,kw;kw,rel;rel`` rows; null and empty lines dropped."""
    parts = F.split("value", ",")
    kept = [c for c in lines.columns if c != "value"]
    return lines.filter(F.length("value") > 0).select(
        *kept,
        field(parts, 0).alias("stock"),
        field(parts, 1).try_cast("double").alias("impact"),
        parse_instant(field(parts, 2), field(parts, 3)).alias("ts"),
        F.split(field(parts, 4), ";").alias("keywords"),
        F.split(field(parts, 5), ";").alias("related"),
    )
