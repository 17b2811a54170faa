"""Tick lines, symbol lists and the feed log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.functions.text import field, parse_instant

NAME_SEPARATOR = "·"
REPLACEMENT = "�"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One ``value`` row per text line."""
    return spark.read.text(path)


def parsed_ticks(lines: DataFrame, with_arrival_ms: bool = False, seq: str | None = None) -> DataFrame:
    """Every line with its parsed fields; ``accepted`` tells ticks from rejects.

    Works on static and streaming frames. ``seq`` names a column that numbers arrival; columns
    other than ``value`` are kept.
    """
    shift = 1 if with_arrival_ms else 0
    parts = F.split(F.trim(F.regexp_replace("value", r"\r$", "")), ",")
    kept = [c for c in lines.columns if c != "value"]
    out = lines.select(
        *kept,
        F.col("value").alias("line"),
        field(parts, shift).alias("symbol"),
        parse_instant(field(parts, shift + 1), field(parts, shift + 2)).alias("ts"),
        field(parts, shift + 3).try_cast("double").alias("value"),
        F.coalesce(field(parts, shift + 4).try_cast("int"), F.lit(0)).alias("volume"),
        *([field(parts, 0).try_cast("bigint").alias("arrival_ms")] if with_arrival_ms else []),
    )
    if seq and seq != "seq":
        out = out.withColumnRenamed(seq, "seq")
    return out.withColumn(
        "accepted",
        (F.length("symbol") > 0) & F.col("ts").isNotNull() & F.col("value").isNotNull(),
    ).withColumn("accepted", F.coalesce("accepted", F.lit(False)))


def parse_ticks(
    lines: DataFrame, with_arrival_ms: bool = False, seq: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split ``id,MM/dd/yyyy,HH:mm:ss,value,volume`` lines into ticks and rejects.

    A bad volume becomes 0; a bad date or value rejects the line.
    """
    parsed = parsed_ticks(lines, with_arrival_ms, seq)
    ticks = parsed.filter("accepted").drop("line", "accepted")
    rejects = parsed.filter(~F.col("accepted")).select(F.col("line"))
    return ticks, rejects


def clean_symbol_list(lines: DataFrame) -> DataFrame:
    """Non-empty symbols, with undecodable characters read as the name separator."""
    return lines.select(
        F.translate(F.regexp_replace("value", r"\r$", ""), REPLACEMENT, NAME_SEPARATOR).alias("symbol")
    ).filter(F.length("symbol") > 0)


def read_symbol_list(spark: SparkSession, path: str) -> DataFrame:
    return clean_symbol_list(read_lines(spark, path))


def symbol_key(line: str | Column) -> Column:
    """Text before the first comma; empty when there is none."""
    column = F.col(line) if isinstance(line, str) else line
    return F.when(F.instr(column, ",") > 1, F.substring_index(column, ",", 1)).otherwise(F.lit(""))


def read_feed_log(spark: SparkSession, path: str) -> DataFrame:
    """Messages end in ``!`` and may span lines."""
    return spark.read.option("lineSep", "!").text(path)


def feed_log_to_tables(messages: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Route feed messages by their type into quotes, symbols, depth and errors."""
    text = messages.select(F.trim(F.regexp_replace("value", r"!$|^\s+|\s+$", "")).alias("message"))
    typed = text.withColumn("type", F.upper(F.substring_index("message", ",", 1))).filter(
        F.instr("message", ",") > 0)

    parts = F.split("message", ",")
    quotes = typed.filter((F.col("type") == "QUOTE") & (F.size(parts) > 7)).select(
        F.concat_ws(",", *[field(parts, i) for i in (1, 6, 7, 4, 5)]).alias("value"))

    entries = (
        typed.filter("type = 'QUOTELIST'")
        .select(F.explode(F.split(F.expr("substring(message, 11)"), "\n")).alias("entry"))
        .filter(F.length("entry") > 0)
        .withColumn("data", F.split("entry", r"\|"))
    )
    symbols = entries.filter(F.size("data") >= 14).select(
        field(F.col("data"), 13).alias("symbol"),
        F.concat_ws(NAME_SEPARATOR, *[field(F.col("data"), i) for i in (0, 1, 3)]).alias("name"),
    )
    short_entries = entries.filter((F.size("data") > 3) & (F.size("data") < 14)).select(
        F.col("entry").alias("message"))

    depth = typed.filter("type = 'DEPTH'").select("message")
    errors = typed.filter("type = 'ERROR'").select("message").unionByName(short_entries)
    return quotes, symbols, depth, errors
