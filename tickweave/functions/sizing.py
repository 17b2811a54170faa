"""Size checks that decide between a broadcast and a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000


def at_most(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has no more than ``rows`` rows; looks at ``rows + 1`` of them at most."""
    return df.limit(rows + 1).count() <= rows


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only for a side checked to be small; a larger one is shuffled.

    Left to itself Spark would go by the estimated bytes, and rows made from a small compressed table
    (one a day of a long period, say) may be many more than these bytes tell.
    """
    return F.broadcast(df) if at_most(df, rows) else df.hint("merge")
