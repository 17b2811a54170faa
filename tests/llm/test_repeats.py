"""Both operators on repeated windows against the definition, with split and unsplit buckets."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.texts import corpus, frame, spaced, wide
from tickweave.llm import batches, repeats, suffixes, superkmers


def key(ident):
    return -(1 << 63) if ident is None else ident


def removed_words(rows, order):
    first, cut = {}, {}
    for row in sorted(set(rows), key=order):
        words = spaced(row[1])
        for p in range(len(words) - 19):
            first.setdefault(tuple(words[p:p + 20]), (row, p))
    for row in set(rows):
        words = spaced(row[1])
        gone = [False] * len(words)
        for p in range(len(words) - 19):
            if first[tuple(words[p:p + 20])] != (row, p):
                gone[p:p + 20] = [True] * 20
        cut[row] = (len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g))
    return Counter((row[0], *cut[row]) for row in rows)


@pytest.mark.parametrize("large", [200_000, 3])
def test_words(spark, large):
    from pyspark.sql import functions as F
    rows = corpus()
    hashes = {r["text"]: r["h"] for r in frame(spark, rows).select(
        "text", F.xxhash64("text").alias("h")).collect()}
    expected = removed_words(rows, lambda r: (key(r[0]), hashes[r[1]]))
    got = superkmers.remove_repeats(wide(spark, rows), bucket_windows=large).collect()
    assert Counter(map(tuple, got)) == expected


def removed_bytes(rows):
    seen, out = Counter(), Counter()
    texts = [(i, (t or "").encode()) for i, t in rows]
    for _, raw in texts:
        seen.update(raw[p:p + 400] for p in range(len(raw) - 399))
    for ident, raw in texts:
        gone = bytearray(len(raw))
        for p in range(len(raw) - 399):
            if seen[raw[p:p + 400]] > 1:
                gone[p:p + 400] = b"x" * 400
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        out[ident, len(raw), len(raw) - len(kept), len(re.findall(b"x+", bytes(gone))),
            hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.mark.parametrize("large", [200_000, 3])
def test_bytes(spark, large):
    rows = corpus()
    got = suffixes.remove_repeats(wide(spark, rows), bucket_windows=large, digest=True).collect()
    assert Counter(map(tuple, got)) == removed_bytes(rows)


@pytest.mark.parametrize("large", [3, 700, 3000])
def test_parts_of_large_buckets(spark, large, monkeypatch):
    """A passage amid different texts: few rows for its windows, whatever the bucket's size."""
    import random
    from tests.llm.texts import prose
    rng = random.Random(9)
    passages = [prose(rng, n)[:size] for n, size in ((90, 330), (90, 420), (200, 900))]
    rows = [(i, prose(rng, rng.randrange(60, 90)) + passages[i % 3] + prose(rng, rng.randrange(60, 90)))
            for i in range(60)]
    rows += [(100 + i, rows[i][1][:700] + "?" + rows[i][1][701:]) for i in range(20)] + rows[:2]
    sent, written = [], repeats.materialize

    def watched(df):
        out = written(df)
        if "core" in out.columns and "place" in out.columns:
            sent.append(out)
        return out

    monkeypatch.setattr(repeats, "materialize", watched)
    got = suffixes.remove_repeats(frame(spark, rows), bucket_windows=large, digest=True).collect()
    assert Counter(map(tuple, got)) == removed_bytes(rows)
    counts = sent[0].selectExpr("count(core) as parts", "sum(if(core is null, 0, windows)) as windows",
                                "count(*) as rows").first()
    assert counts["parts"] > 0 and counts["windows"] > 12 * counts["parts"]


def test_bytes_kept(spark):
    rows = corpus(size=5)
    got = suffixes.remove_repeats(frame(spark, rows)).collect()
    assert Counter((*r[:4], hashlib.sha256(bytes(r[4])).hexdigest()) for r in got) == (
        removed_bytes(rows))


def test_empty_tables(spark):
    empty = frame(spark, [])
    assert superkmers.remove_repeats(empty).count() == 0
    assert suffixes.remove_repeats(empty).count() == 0


def test_suffix_array():
    rng = np.random.default_rng(0)
    for _ in range(200):
        data = rng.integers(97, 97 + rng.integers(1, 6), rng.integers(1, 80)).astype(np.uint8)
        base = bytes(data[:12])
        for raw in (bytes(data), base * 5 + b"z" * 20 + base):
            got = suffixes.suffix_array(np.frombuffer(raw, np.uint8), 400).tolist()
            assert got == sorted(range(len(raw)), key=lambda i: raw[i:])


def test_minimiser_cuts_are_a_matter_of_content():
    rng = np.random.default_rng(1)
    codes = batches.mix(rng.integers(0, 3, 500).astype(np.uint64))
    grams = batches.Rolling(codes).grams(2)
    whole = batches.minimiser_cuts(grams, np.array([0, 500]), 2, 20)
    assert whole[2].sum() == 481 and whole[2].max() <= 19
    part = batches.minimiser_cuts(batches.Rolling(codes[100:200]).grams(2), np.array([0, 100]), 2, 20)
    least = dict(zip(np.concatenate([s + np.arange(n) for s, n in zip(whole[1], whole[2])]),
                     np.repeat(whole[3], whole[2])))
    for start, size, value in zip(part[1], part[2], part[3]):
        assert all(least[100 + start + i] == value for i in range(size))
