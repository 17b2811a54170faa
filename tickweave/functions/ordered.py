"""Window functions over groups of any size.

With one cell every helper is a plain window per key. With several, the window runs per
``(keys, cell)``; one summary row per group is carried forward through a small second window and
joined back on the same keys. The result does not depend on where the cells are cut.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickweave.functions.cells import Cells
from tickweave.session import materialize


def _carried(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    position: Column,
    cells: Cells,
    local: Callable[[Window], Column],
    summary: Column,
    carry: Callable[[Window], Column],
    merge: Callable[[Column, Column], Column],
    out: str,
) -> DataFrame:
    keys, order = list(keys), list(order)
    if cells.single:
        window = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(*order)
        return df.withColumn(out, local(window))
    parted = materialize(df.withColumn("_cell", cells.of(position)))
    groups = [*keys, "_cell"]
    inner = parted.withColumn("_local", local(Window.partitionBy(*groups).orderBy(*order)))
    tails = parted.groupBy(*groups).agg(summary.alias("_tail"))
    across = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_cell")
    carries = tails.select(*groups, carry(across).alias("_carry"))
    return (
        inner.join(carries, groups, "left")
        .withColumn(out, merge(F.col("_local"), F.col("_carry")))
        .select(*df.columns, out)
    )


def previous(df, keys, order, values, position, cells, out="prev") -> DataFrame:
    """The ``values`` of the row before, as a struct (null on a key's first row)."""
    row = F.struct(*values)
    return _carried(
        df, keys, order, position, cells,
        local=lambda w: F.lag(row).over(w),
        summary=F.max_by(row, F.struct(*order)),
        carry=lambda w: F.lag("_tail").over(w),
        merge=lambda here, before: F.coalesce(here, before),
        out=out,
    )


def following(df, keys, order, values, position, cells, out="next") -> DataFrame:
    """The ``values`` of the row after, as a struct (null on a key's last row)."""
    row = F.struct(*values)
    return _carried(
        df, keys, order, position, cells,
        local=lambda w: F.lead(row).over(w),
        summary=F.min_by(row, F.struct(*order)),
        carry=lambda w: F.lead("_tail").over(w),
        merge=lambda here, after: F.coalesce(here, after),
        out=out,
    )


def last_known(df, keys, order, value, position, cells, out) -> DataFrame:
    """The newest non-null ``value`` at or before each row."""
    column = F.col(value)
    return _carried(
        df, keys, order, position, cells,
        local=lambda w: F.last(column, True).over(
            w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        summary=F.max_by(column, F.when(column.isNotNull(), F.struct(*order))),
        carry=lambda w: F.last("_tail", True).over(
            w.rowsBetween(Window.unboundedPreceding, -1)),
        merge=lambda here, before: F.coalesce(here, before),
        out=out,
    )


def running_max(df, keys, order, value, position, cells, out) -> DataFrame:
    """Largest ``value`` at or before each row."""
    return _carried(
        df, keys, order, position, cells,
        local=lambda w: F.max(value).over(
            w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        summary=F.max(value),
        carry=lambda w: F.max("_tail").over(w.rowsBetween(Window.unboundedPreceding, -1)),
        merge=lambda here, before: F.greatest(here, before),
        out=out,
    )


def running_sums(df, keys, order, values, position, cells, out) -> DataFrame:
    """Sums of ``values`` up to and including each row, as a struct of the same names."""
    def totals(window):
        return F.struct(*[
            F.sum(v).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias(v)
            for v in values])

    def before(window):
        return F.struct(*[
            F.sum(f"_tail.{v}").over(window.rowsBetween(Window.unboundedPreceding, -1)).alias(v)
            for v in values])

    return _carried(
        df, keys, order, position, cells,
        local=totals,
        summary=F.struct(*[F.sum(v).alias(v) for v in values]),
        carry=before,
        merge=lambda here, earlier: F.struct(*[
            (here[v] + F.coalesce(earlier[v], F.lit(0))).alias(v) for v in values]),
        out=out,
    )


def row_numbers(df, keys, order, position, cells, out) -> DataFrame:
    """Consecutive numbers from 1 in ``order``, which must be a total order."""
    return _carried(
        df, keys, order, position, cells,
        local=lambda w: F.row_number().over(w).cast("bigint"),
        summary=F.count(F.lit(1)),
        carry=lambda w: F.sum("_tail").over(w.rowsBetween(Window.unboundedPreceding, -1)),
        merge=lambda here, before: here + F.coalesce(before, F.lit(0)),
        out=out,
    )


def explode_range(df, low, high, out, piece: int = 4096) -> DataFrame:
    """One row per integer in ``[low, high]``; two steps, so no row holds a huge array."""
    outer = df.filter(low <= high).withColumn("_piece", F.explode(F.sequence(
        F.floor(low / piece), F.floor(high / piece))))
    first = F.greatest(low, F.col("_piece") * piece)
    last = F.least(high, F.col("_piece") * piece + (piece - 1))
    return outer.withColumn(out, F.explode(F.sequence(first, last))).drop("_piece")


def as_of(left, right, keys, order, value, position, cells=None, out=None) -> DataFrame:
    """Give each left row the newest right ``value`` of the same keys at or before it.

    ``order`` names columns both sides carry. On ties the right row comes first, so a change
    holds for the left row of the same instant. One union and one window, no range join.
    """
    out = out or value
    marked_left = left.withColumn("_value", F.lit(None).cast(right.schema[value].dataType)).withColumn(
        "_side", F.lit(1))
    marked_right = right.select(*keys, *order, F.col(value).alias("_value")).withColumn(
        "_side", F.lit(0))
    both = marked_left.unionByName(marked_right, allowMissingColumns=True)
    if cells is None:
        cells = Cells.fit(both, position)
    # a right row with a null value would be skipped by last_known; box it so it counts
    boxed = both.withColumn("_value", F.when(F.col("_side") == 0, F.struct("_value")))
    filled = last_known(boxed, keys, [*order, "_side"], "_value", position, cells, "_known")
    return filled.filter("_side = 1").select(
        *left.columns, F.col("_known._value").alias(out))
