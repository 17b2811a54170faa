"""Parameters that change while rows flow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.functions.cells import Cells, micros
from tickweave.functions.ordered import as_of
from tickweave.functions.sizing import at_most

STEP_CHANGES = 4096


def with_parameter(
    df: DataFrame,
    param_log: DataFrame,
    name: str,
    default: float,
    time: str = "ts",
    step_changes: int = STEP_CHANGES,
) -> DataFrame:
    """Add column ``name`` with the value in force at each row's time.

    ``param_log(name, value, ts)`` holds for rows at or after a change; a null value is no change. A log of few changes
    becomes a constant step function evaluated in place, without a shuffle; a longer one is merged
    with the rows in time order.
    """
    changes = param_log.filter((F.col("name") == name) & F.col("value").isNotNull()).groupBy("ts").agg(
        F.max_by("value", "seq").alias("value") if "seq" in param_log.columns
        else F.max("value").alias("value"))
    if at_most(changes, step_changes):
        steps = sorted((r["at"], r["value"]) for r in changes.select(
            micros("ts").alias("at"), "value").collect())
        cells = Cells(tuple(at for at, _ in steps))
        values = F.split(F.lit(",".join(repr(float(v)) for v in [default, *[v for _, v in steps]])),
                         ",").cast("array<double>")
        return df.withColumn(name, F.element_at(values, cells.of(micros(time)) + 1))
    rows = df.withColumn("ts", F.col(time)) if time != "ts" else df
    known = as_of(rows, changes.withColumnRenamed("value", name), [], ["ts"], name, micros("ts"))
    return known.withColumn(name, F.coalesce(name, F.lit(default))).select(*df.columns, name)
