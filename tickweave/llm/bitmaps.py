"""Fixed-size sets of 64-bit values that thin rows inside a scan.

A bitmap has one bit per slot, and a value falls into the slot of its lower bits. It never misses a
value and lets some others through, the more the fuller it is; whoever uses it goes on with an exact
step. Its size is a parameter, so it may be sent to every task whatever the data holds.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Bitmap:
    def __init__(self, words: np.ndarray):
        self.words = words            # uint64

    def holds(self, values: np.ndarray) -> np.ndarray:
        slot = values.view(np.uint64) & np.uint64(64 * len(self.words) - 1)
        word = self.words[(slot >> np.uint64(6)).astype(np.int64)]
        return (word >> (slot & np.uint64(63))) & np.uint64(1) == 1


def bitmap_of(frame: DataFrame, column: str, slots: int) -> Bitmap:
    """The bitmap of a long column; ``slots`` is a power of two, ``slots / 64`` rows come back."""
    slot = F.col(column).bitwiseAND(slots - 1)
    bits = frame.groupBy(F.shiftright(slot, 6).cast("int").alias("at")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(`{column}` & 63 as int))")).alias("bits")).toArrow()
    words = np.zeros(slots // 64, np.int64)
    words[bits.column("at").to_numpy()] = bits.column("bits").to_numpy()
    return Bitmap(words.view(np.uint64))
