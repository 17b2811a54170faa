"""Small-frame builders and plain per-tick models to compare with."""

from __future__ import annotations

import datetime as dt
import math
import random

T0 = dt.datetime(2024, 1, 1)


def at(seconds: float) -> dt.datetime:
    return T0 + dt.timedelta(seconds=seconds)


def secs(ts: dt.datetime) -> float:
    return (ts - T0).total_seconds()


TICKS = "symbol string, ts timestamp_ntz, value double, volume int, seq bigint"


def ticks_frame(spark, rows):
    """rows of (symbol, seconds, value) in arrival order."""
    return spark.createDataFrame(
        [(s, at(t), float(v), 1, i) for i, (s, t, v) in enumerate(rows)], TICKS)


def random_rows(seed, symbols=4, ticks=60, late=True):
    rng, now, rows = random.Random(seed), 0, []
    for _ in range(ticks):
        now += rng.choice([0, 0, 1, 1, 2, 5])
        when = now - rng.choice([0, 0, 0, 3]) if late else now
        rows.append((f"s{rng.randrange(symbols)}", max(when, 0), rng.randrange(90, 110)))
    return rows


def clean_rows(rows):
    """Clamp to the newest time seen, then keep the first of each (symbol, time)."""
    newest, seen, out = None, set(), []
    for symbol, when, value in rows:
        newest = when if newest is None else max(newest, when)
        if (symbol, newest) not in seen:
            seen.add((symbol, newest))
            out.append((symbol, newest, value))
    return out


def intervals_of(clean):
    last, out = {}, []
    for symbol, when, value in clean:
        if symbol in last:
            begin, before = last[symbol]
            out.append((symbol, begin, when, value - before))
        last[symbol] = (when, value)
    return out


def correlations(intervals):
    """Definition of the estimator by a double loop."""
    symbols = sorted({i[0] for i in intervals})
    ss = {s: sum(i[3] ** 2 for i in intervals if i[0] == s) for s in symbols}
    out = {}
    for x, a in enumerate(symbols):
        for b in symbols[x + 1:]:
            if ss[a] > 0 and ss[b] > 0:
                num = sum(i[3] * j[3] for i in intervals if i[0] == a for j in intervals
                          if j[0] == b and i[1] < j[2] and j[1] < i[2])
                out[a, b] = max(-1.0, min(1.0, num / (math.sqrt(ss[a]) * math.sqrt(ss[b]))))
    return out


def sliding(clean, size, advance):
    intervals, t0, t1 = intervals_of(clean), clean[0][1], clean[-1][1]
    out, start = {}, t0
    while start + size <= t1:
        inside = [i for i in intervals if start <= i[2] < start + size]
        for pair, value in correlations(inside).items():
            out[(*pair, start)] = value
        start += advance
    return out
