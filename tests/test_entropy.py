"""Transfer entropy against counts taken window by window, exact zeros included."""

import math
import random
from collections import Counter
from fractions import Fraction

import pytest

from helpers import secs, ticks_frame
from tickweave.operators import entropy


def entropies(xs, ys):
    """Both directions of one window of samples; None for an exact zero."""
    out = []
    for own, other in ((ys, xs), (xs, ys)):
        steps = list(zip(own[1:], own, other))
        c3, c1 = Counter(steps), Counter(o for _, o, _ in steps)
        c2, n2 = Counter((o, e) for _, o, e in steps), Counter((n, o) for n, o, _ in steps)
        quotients = [Fraction(c3[s] * c1[s[1]], c2[s[1:]] * n2[s[:2]]) for s in steps]
        zero = all(q == 1 for q in quotients)
        out.append(None if zero else sum(math.log2(q) for q in quotients) / len(steps))
    return out


def model(rows, step, n_windows, bins, multiplier=1.2):
    """(source, target, window end) -> value, from the definitions."""
    last = max(t for _, t, _ in rows) // step
    samples, first = {}, {}
    for symbol in {s for s, _, _ in rows}:
        own = [(t, i, v) for i, (s, t, v) in enumerate(rows) if s == symbol]
        first[symbol] = min(own, key=lambda x: x[1])
        for g in range(min(t for t, _, _ in own) // step, last + 1):
            samples[symbol, g] = max((x for x in own if x[0] < (g + 1) * step))[2]
    out = {}
    names = sorted(first)
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            newer = max(first[a][1], first[b][1])
            bounds = []
            for s in (a, b):
                value = [v for j, (name, _, v) in enumerate(rows) if name == s and j <= newer][-1]
                bounds.append(sorted((value / multiplier, value * multiplier)))

            def bin_of(s, g, k):
                low, high = bounds[k]
                return max(0, min(bins - 1, math.floor((samples[s, g] - low) / (high - low) * bins)))

            shared = [g for g in range(last + 1) if (a, g) in samples and (b, g) in samples]
            for g in shared:
                if g - shared[0] + 1 >= n_windows:
                    window = range(g - n_windows + 1, g + 1)
                    xs, ys = ([bin_of(s, w, k) for w in window] for k, s in ((0, a), (1, b)))
                    for pair, value in zip(((a, b), (b, a)), entropies(xs, ys)):
                        if value is not None:
                            out[(*pair, (g + 1) * step)] = value
    return out


def series(seed, symbols=3, length=120, calm=0.5):
    rng, rows = random.Random(seed), []
    value = {f"s{i}": 100.0 for i in range(symbols)}
    for t in range(length):
        for i, s in enumerate(sorted(value)):
            if t >= 9 * i and rng.random() < 0.6:
                if rng.random() > calm:
                    value[s] = rng.choice([90.0, 100.0, 110.0])
                rows.append((s, t, value[s]))
    return rows


def by_window(df):
    rows = [((r["id0"], r["id1"], int(secs(r["window_end"]))), r["value"]) for r in df.collect()]
    assert len(dict(rows)) == len(rows)
    return dict(rows)


@pytest.mark.parametrize("calm,n_windows,grid", [(0.3, 8, 1_000_000), (0.9, 6, 1_000_000), (0.6, 12, 13), (0.9, 5, 7)])
def test_sliding_windows(spark, calm, n_windows, grid):
    rows = series(3, calm=calm)
    got = by_window(entropy.transfer_entropy_sliding(
        ticks_frame(spark, rows), "2 seconds", n_windows, 10, grid_per_cell=grid))
    want = model(rows, 2, n_windows, 10)
    assert got.keys() == want.keys() and len(want) > 2
    assert all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)


def test_zeros_of_unequal_counts_are_found(spark):
    """Independent steps: the four sums of c*log2(c) differ but cancel, 4 log 4 against 2 log 2."""
    own, new, other = [], [], []
    for a in (0, 1):
        for b in (0, 1):
            own.append(0), new.append(a), other.append(b)
    moves = [("a", "b", 10 * i + 1, o, n, p, q) for i, (n, q, p) in enumerate(zip(new, own, other)) for o in (0,)]
    binned = spark.createDataFrame(moves, "id0 string, id1 string, g bigint, x int, y int, px int, py int")
    got = entropy.transfer_entropy_of_bins(binned, 2, 30, 1_000_000).collect()
    assert got == []
    weights = entropy.prime_weights(8)
    assert weights[2][8] == 24 and weights[2][4] == 8 and weights[3][6] == 6 and weights[7][7] == 7
    assert all(sum(w[c] * math.log2(p) for p, w in weights.items()) == pytest.approx(c * math.log2(c)) for c in range(1, 9))


def test_windows_do_not_depend_on_history(spark):
    """The value of a window is that of its samples alone, bit by bit, however much came before."""
    rows = series(5, symbols=2, length=80, calm=0.2)
    whole = by_window(entropy.transfer_entropy_sliding(ticks_frame(spark, rows), "1 second", 10, 10))
    again = by_window(entropy.transfer_entropy_sliding(ticks_frame(spark, rows), "1 second", 10, 10, grid_per_cell=11))
    assert whole == again and len(whole) > 20


def test_no_ticks_and_short_windows(spark):
    assert entropy.transfer_entropy_sliding(ticks_frame(spark, [])).count() == 0
    rows = [("a", 0, 1.0), ("b", 0, 2.0), ("a", 1, 3.0)]
    assert entropy.transfer_entropy_sliding(ticks_frame(spark, rows), "1 second", 1).count() == 0
