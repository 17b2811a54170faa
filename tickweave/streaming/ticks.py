"""Tick streams: parsing, order, duplicates, delivery and windowed reports."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickweave.functions.cells import micros
from tickweave.operators.ordering import clamp_out_of_order, drop_repeated_records
from tickweave.sources.ticks import parsed_ticks


def stream_lines(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Text lines of files as they appear in ``folder``."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(folder)


def stream_ticks(lines: DataFrame, seq: str | None = None) -> DataFrame:
    """Accepted ticks of a stream of tick lines."""
    return parsed_ticks(lines, seq=seq).filter("accepted").drop("line", "accepted")


def drop_late(ticks: DataFrame, lateness: str) -> DataFrame:
    """The watermark policy: ticks later than ``lateness`` are dropped by stateful steps."""
    return ticks.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)


def dedup_stream(ticks: DataFrame, lateness: str = "1 minute") -> DataFrame:
    """First arrival of each (symbol, ts) within the watermark."""
    return drop_late(ticks, lateness).dropDuplicatesWithinWatermark(["symbol", "ts"])


def throughput_stream(ticks: DataFrame, every: str = "60 seconds", lateness: str = "1 minute") -> DataFrame:
    """Tuples per second of each closed tumbling period."""
    from tickweave.functions.cells import interval_micros

    seconds = interval_micros(every) / 1_000_000
    return (
        drop_late(ticks, lateness).groupBy(F.window("ts", every).alias("w"))
        .agg((F.count(F.lit(1)) / F.lit(seconds)).alias("tuples_per_sec"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "tuples_per_sec")
    )


def write_stream(
    df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", partitions: int | None = None, **trigger
) -> StreamingQuery:
    """Exactly-once delivery to files.

    ``partitions`` bounds the partitions of the stream's state, which every micro-batch opens and
    commits one by one; the session's own number is for tables.
    """
    spark, name = df.sparkSession, "spark.sql.shuffle.partitions"
    usual = spark.conf.get(name)
    if partitions:
        spark.conf.set(name, str(min(partitions, int(usual))))
    try:
        return (
            df.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start()
        )
    finally:
        if partitions:  # the stream has its own copy of the settings by now
            spark.conf.set(name, usual)


def apply_per_batch(
    df: DataFrame, operator: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Run a batch operator on every micro-batch; each batch owns one output folder.

    For operators that need no state of earlier batches, and for those whose state is a stored
    table they read themselves (a parameter log, an edge history, stored walks).
    """

    def run(batch: DataFrame, number: int) -> None:
        operator(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return (
        df.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def newest_batch(spark: SparkSession, out: str, number: int) -> DataFrame | None:
    """The rows of the newest batch before ``number`` that has written any below ``out``."""
    try:
        written = spark.read.parquet(out)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None  # the first batch
    batches = {int(n) for n in re.findall(r"/batch=(\d+)/", "\n".join(written.inputFiles()))}
    for earlier in sorted((n for n in batches if n < number), reverse=True):
        rows = written.filter(F.col("batch") == earlier).drop("batch")
        if not rows.isEmpty():
            return rows
    return None


def newest_written(spark: SparkSession, out: str, number: int) -> int | None:
    """The newest ``ts`` that the batches before ``number`` have written below ``out``.

    Clamped times never fall, so the newest earlier batch has it.
    """
    before = newest_batch(spark, out, number)
    return None if before is None else before.agg(F.max(micros("ts")).alias("newest")).first()["newest"]


def drop_repeated_stream(records: DataFrame, out: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Drop records equal to the one that arrived just before them (``seq``), over all micro-batches.

    The last record of the batches before equals the last one they kept, so it is in the table that
    the stream writes; each micro-batch runs the batch operator behind that one row. ``seq`` rises
    from batch to batch.
    """
    def run(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        before = newest_batch(batch.sparkSession, out, number)
        last = before.orderBy(F.desc("seq")).limit(1).select(*batch.columns) if before is not None else None
        row = last.first() if last is not None else None
        kept = drop_repeated_records(batch if row is None else last.unionByName(batch))
        if row is not None:
            kept = kept.filter(F.col("seq") > row["seq"])
        # a batch of nothing but repetitions writes no rows and leaves the newest batch as it is
        kept.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return (
        records.writeStream.foreachBatch(run).option("checkpointLocation", f"{checkpoint}/query")
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def clamp_stream(ticks: DataFrame, out: str, checkpoint: str, **trigger) -> StreamingQuery:
    """The clamp policy: late ticks take the newest timestamp of all arrivals before them.

    The order spans all symbols, so a keyed state would hold the stream in one task. Each
    micro-batch runs the batch operator instead, which splits the arrival order into cells and
    carries one maximum between them; the maximum of the batches before is in the table itself. A
    batch that runs again reads the same earlier batches and overwrites its own folder.
    """
    def run(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        clamped = clamp_out_of_order(batch, floor_micros=newest_written(batch.sparkSession, out, number))
        clamped.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return (
        ticks.writeStream.foreachBatch(run).option("checkpointLocation", f"{checkpoint}/query")
        .trigger(**(trigger or {"availableNow": True})).start()
    )
