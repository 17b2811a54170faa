"""Change filter: report a value only when it moved away from the last reported one."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.functions.cells import Cells, micros
from tickweave.session import materialize, ship_code


def moved_positions(values: np.ndarray, last: float | None, rel: float) -> tuple[list[int], float | None]:
    """Positions that move ``last`` and the final ``last``.

    A value moves ``last`` when there is none yet or when it differs by more than
    ``rel * abs(last)``.
    """
    moved = []
    for i, value in enumerate(values.tolist()):
        if last is None or abs(value - last) > rel * abs(last):
            moved.append(i)
            last = value
    return moved, last


def emit_on_change(
    df: DataFrame,
    keys: list[str],
    order: str,
    value: str = "value",
    rel: float = 0.01,
    cells: Cells | None = None,
) -> DataFrame:
    """Rows whose value differs from the last remembered one by more than ``rel``.

    A zero is remembered but not emitted. Null and NaN values are neither: their rows are left out
    first. Rows of a key with equal ``order`` count from the smallest value up. The filter is sequential per key, so a long key is cut
    into cells: each cell runs with the last value its predecessor ended on, and only cells whose
    predecessor ended differently run again. It stops when nothing changes, so the rows are those
    of one sequential pass.
    """
    position = micros(order) if df.schema[order].dataType.typeName().startswith("timestamp") else F.col(order)
    ship_code(df.sparkSession)
    df = materialize(df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))))
    cells = cells or Cells.fit(df, position)
    chunked = df.withColumn("_cell", cells.of(position).cast("int"))
    groups, columns, schema = [*keys, "_cell"], df.columns, df.schema

    def filtered(with_start: DataFrame) -> DataFrame:
        def keep(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values([order, value], kind="stable")
            start = pdf["_start"].iloc[0]
            moved, _ = moved_positions(
                pdf[value].to_numpy(), None if pd.isna(start) else float(start), rel)
            out = pdf.iloc[moved]
            return out[out[value] != 0][columns]

        return with_start.groupBy(*groups).applyInPandas(keep, schema)

    if cells.single:
        return filtered(chunked.withColumn("_start", F.lit(None).cast("double")))

    chunked = materialize(chunked)
    end_schema = T.StructType([
        *[chunked.schema[g] for g in groups], T.StructField("_end", T.DoubleType())])

    def ends(with_start: DataFrame) -> DataFrame:
        def last_value(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values([order, value], kind="stable")
            start = pdf["_start"].iloc[0]
            _, last = moved_positions(
                pdf[value].to_numpy(), None if pd.isna(start) else float(start), rel)
            return pdf[groups].head(1).assign(_end=last)

        return with_start.groupBy(*groups).applyInPandas(last_value, end_schema)

    across = Window.partitionBy(*keys).orderBy("_cell")
    state = materialize(
        ends(chunked.withColumn("_start", F.lit(None).cast("double")))
        .withColumn("_start", F.lit(None).cast("double")))
    while True:
        # starts follow from the ends so far; only cells whose start differs have to run again
        due = materialize(
            state.withColumn("_due", F.lag("_end").over(across))
            .withColumn("_stale", ~F.col("_due").eqNullSafe(F.col("_start"))))
        if due.filter("_stale").isEmpty():
            break
        stale = due.filter("_stale").select(*groups, F.col("_due").alias("_start"))
        again = ends(chunked.join(stale, groups)).join(stale, groups)
        fresh = due.filter(~F.col("_stale")).select(*groups, "_end", "_start")
        state = materialize(fresh.unionByName(again.select(*groups, "_end", "_start")))
    return filtered(chunked.join(state.select(*groups, "_start"), groups))
