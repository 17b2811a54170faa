"""Equal-depth cells: split an ordered column into pieces that hold about the same number of rows.

Windows over a hot key and range joins over a busy period would otherwise run in one task. A cell
is a bounded slice of the order, so ``(key, cell)`` groups stay bounded whatever the key or time
distribution is.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_CELL = 1_000_000
MAX_CELLS = 16_384


@dataclass(frozen=True)
class Cells:
    """Cell i holds the values v with ``cuts[i-1] <= v < cuts[i]``; cell 0 is open to the left."""

    cuts: tuple[int, ...] = ()
    rows: int = 0
    width: int | None = field(default=None)

    @classmethod
    def fit(
        cls,
        df: DataFrame,
        value: Column,
        rows_per_cell: int = ROWS_PER_CELL,
        max_cells: int = MAX_CELLS,
    ) -> "Cells":
        """Cut points at the approximate quantiles of a BIGINT expression.

        At most ``max_cells`` longs reach the driver. Small inputs need only the row count.
        """
        rows = df.count()
        wanted = min(max_cells, -(-rows // rows_per_cell))
        if wanted <= 1:
            return cls((), rows)
        probs = [i / wanted for i in range(1, wanted)]
        quantiles = df.agg(
            F.percentile_approx(value, probs, max(10_000, 8 * wanted)).alias("q")
        ).first()["q"]
        return cls(tuple(sorted(set(quantiles))), rows)

    @classmethod
    def uniform(cls, width: int, span: int) -> "Cells":
        """Fixed-width cells, for orders without gaps (window numbers, grid points)."""
        return cls((), 0, width if span > width else None)

    @property
    def single(self) -> bool:
        return not self.cuts and self.width is None

    @property
    def count(self) -> int:
        return len(self.cuts) + 1

    def index(self, value: int) -> int:
        """The cell of a driver-side value."""
        return value // self.width if self.width else bisect_right(self.cuts, value)

    def of(self, value: Column) -> Column:
        """The cell of a BIGINT column (0 for null): search the block heads, then one block."""
        if self.width is not None:
            return F.floor(value / F.lit(self.width)).cast("int")
        if not self.cuts:
            return F.lit(0)
        step = max(1, round(len(self.cuts) ** 0.5))
        heads = long_array(self.cuts[::step])
        block = F.size(F.filter(heads, lambda cut: cut <= value))
        inner = F.slice(long_array(self.cuts), (block - 1) * step + 1, F.lit(step))
        below = F.size(F.filter(inner, lambda cut: cut <= value))
        return F.when(block == 0, F.lit(0)).otherwise((block - 1) * step + below)


def long_array(values) -> Column:
    """A constant BIGINT array that Catalyst folds into one literal."""
    return F.split(F.lit(",".join(str(v) for v in values)), ",").cast("array<bigint>")


def micros(ts: str | Column) -> Column:
    """Epoch microseconds of a timestamp column (session zone is UTC)."""
    column = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(column.cast("timestamp"))


def from_micros(value: str | Column) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return F.timestamp_micros(column).cast("timestamp_ntz")


_UNITS = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
          "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000}


def interval_micros(text: str) -> int:
    """``"30 seconds"`` -> microseconds."""
    amount, unit = text.split()
    return int(amount) * _UNITS[unit.rstrip("s")]
