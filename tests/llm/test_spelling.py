"""Spelling variants against brute force over all pairs, and the automata by themselves."""

import random
import re
import zlib

import pytest

from tests.llm.texts import frame, wide
from tickweave.llm import spelling

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def model(rows):
    counts = {}
    for ident, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if ident is None else ident}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] = counts.get(run, 0) + 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    beside = {w: [v for v in words if near(w, v)] for w in words}
    forms = {}
    for w, n in words.items():
        best = min(beside[w], key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, len(beside[w]), words[forms[w]] if forms[w] else None))
    return sorted(out, key=lambda r: r[0])


def result(docs, **options):
    got = spelling.spelling_variants(docs, **options)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(r) for r in got.collect()), key=lambda r: r[0])


def rows_of(seed=1, letters="abé", size=700):
    rng = random.Random(seed)
    base = ["".join(rng.choices(letters, k=rng.randrange(4, 10))) for _ in range(60)]
    rows = []
    for i in range(size):
        words = []
        for _ in range(rng.randrange(0, 25)):
            w = rng.choice(base[:rng.randrange(1, 60)])
            if rng.random() < 0.4:
                at = rng.randrange(len(w) + 1)
                w = rng.choice([w[:at] + rng.choice(letters) + w[at:], w[:at] + w[at + 1:],
                                w[:at] + rng.choice(letters) + w[at + 1:]])
            words.append(rng.choice([w, w.upper(), w.title()]))
        rows.append((i, rng.choice([" ", ", ", "1", "_"]).join(words)))
    rows += [(9000, None), (9001, ""), (9002, "日本語テスト ÀÉÎÕÜ àéîõü ÀÉÎÕÜ × ÷÷÷÷÷ ÷÷÷÷÷ ÷÷÷÷÷"), (None, "nulls nulls nulls nulla nulla nulla"),
             rows[3], rows[3], (9003, "x" * 300 + " " + "x" * 300 + " " + "x" * 299 + " " + "y" + "x" * 299 + " "),
             (9003, "x" * 300 + " " + "x" * 299 + " " + "x" * 299 + " " + ("y" + "x" * 299 + " ") * 2)]
    return rows


@pytest.mark.parametrize("group_words", [spelling.GROUP_WORDS, 4])
def test_against_all_pairs(spark, group_words):
    rows = rows_of()
    expected = model(rows)
    assert sum(r[4] for r in expected) > 500 and any(r[2] not in (r[0], r[1]) for r in expected)
    assert result(frame(spark, rows).repartition(6), group_words=group_words) == expected


def test_two_letters_cut_small(spark):
    """Runs of equal letters have many ways to insert one; each pair still counts once."""
    rows = rows_of(7, "ab", 300)
    assert result(frame(spark, rows), group_words=2) == model(rows)


def test_empty_and_clashing(spark):
    assert result(frame(spark, [])) == []
    assert result(frame(spark, [(1, None), (2, "rare words only")])) == []
    rows = rows_of(3, size=80)
    from pyspark.sql import functions as F
    docs = wide(spark, rows).withColumns({c: F.lit(1) for c in ("word", "n", "g", "rest")})
    assert result(docs) == model(rows)


def test_long_texts_are_counted_in_parts():
    rng = random.Random(2)
    text = "".join(rng.choices("abcé -1", [5, 5, 5, 2, 2, 1, 1], k=5000)) + "z" * 400
    for size in (1, 7, 100, 10_000):
        parts = list(spelling.text_parts(text, size))
        assert "".join(parts) == text
        assert [w for p in parts for w in spelling.RUN.findall(p)] == spelling.RUN.findall(text)


def test_words_are_handed_on_when_many_are_held(spark):
    rows = rows_of(5, size=100)
    few = spelling.vocabulary(frame(spark, rows), held_words=3).collect()
    assert sorted(few) == sorted(spelling.vocabulary(frame(spark, rows)).collect())


def test_acceptor_is_minimal():
    words = sorted({a + b for a in ("", "x", "yy", "zzz") for b in ("ing", "ed", "s")})
    machine = spelling.Acceptor()
    initial = machine.add(words)
    assert machine.sizes[initial] == len(words)
    suffixes = {frozenset(w[len(p):] for w in words if w.startswith(p))
                for w in words for p in (w[:i] for i in range(len(w) + 1))}
    assert len(machine.final) == len(suffixes)
    pairs = {frozenset((words[a], words[b])) for a, b in machine.replaced(initial)}
    assert pairs == {frozenset((a, b)) for a in words for b in words if len(a) == len(b) and near(a, b)}
