"""The prefix trie against a plain dictionary of prefixes."""

import hashlib
import random
import re
import zlib

import pytest

from tickweave.llm import prefix_trie

DDL = "conv_id long, turn long, role string, text string"


def model(rows):
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    turns = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in convs.items()}
    nodes = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        full = tuple(turns.get(base, [])[:h] + own[h:])
        for d in range(len(full) + 1):
            nodes.setdefault(full[:d], ([], []))[0].append(c)
        nodes[full][1].append(c)
    out = {}
    children = {k: 0 for k in nodes}
    for k in nodes:
        if k:
            children[k[:-1]] += 1
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for k in sorted(nodes, key=len, reverse=True):
        leaves[k] += children[k] == 0
        if k:
            saved[k] += (len(nodes[k][0]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1]))
            leaves[k[:-1]] += leaves[k]
            saved[k[:-1]] += saved[k]
        members, ends = nodes[k]
        out[min(members), len(k)] = (
            min(nodes[k[:-1]][0]) if k else None, len(members), children[k], leaves[k], saved[k],
            hashlib.sha256(",".join(map(str, sorted(ends))).encode()).hexdigest())
    return out


def result(frame, **options):
    got = prefix_trie.prefix_trie(frame, **options).collect()
    return {(r["conv_id"], r["depth"]): tuple(r)[2:] for r in got}, len(got)


def rows_of(seed=2):
    rng = random.Random(seed)
    rows = []
    for c in range(150):
        for t in range(rng.randrange(0, 7)):
            same = rng.random() < 0.6
            text = f"hello  {t}" if same else f"own {rng.randrange(30)}\tx {'w ' * rng.randrange(4)}"
            rows.append((c, t, rng.choice(["user", "assistant"]) if not same else "user", text))
    rows += [(c, t, "user", f"shared {t}") for c in range(400, 440) for t in range(5)]       # copies
    rows += [(500, t, "user", f"long {t}") for t in range(90)] + [(501, t, "user", f"long {t}") for t in range(60)]
    rows += [(600, None, None, None), (600, None, "user", "b"), (600, 1, "", " \n"), (600, 1, "a", "tie"),
             (600, 1, "a", "tie"), (601, 5, None, "x y z"), (-7, 0, "user", "neg"), (-7, 1, "user", "neg two"),
             (-20, 0, "user", "base"), (-27, 3, "user", "hello  0"), (None, 0, "user", "no id"), (5_000_000_000, 2, "u", "big"),
             (700, 0, "user", "word " * 50_000)]
    return rows


@pytest.mark.parametrize("options", [
    {}, {"shard_rows": 2, "rows_per_cell": 60, "queue_messages": 3}, {"shard_rows": 16, "queue_messages": 1}])
def test_against_a_dictionary(spark, options):
    rows = rows_of()
    got, count = result(spark.createDataFrame(rows, DDL).repartition(5), **options)
    expected = model(rows)
    assert count == len(expected)
    assert got == expected


def test_caterpillar_of_all_prefixes(spark):
    """Every prefix of one conversation is a conversation: a chain for each, nested in the one before."""
    rows = [(c * 20, t, "user", f"t{t}") for c in range(40) for t in range(40 - c)]
    got, _ = result(spark.createDataFrame(rows, DDL), shard_rows=3, rows_per_cell=100, queue_messages=2)
    assert got == model(rows)


def test_empty_and_clashing(spark):
    assert result(spark.createDataFrame([], DDL)) == ({}, 0)
    assert result(spark.createDataFrame([(None, 1, "a", "b")], DDL)) == ({}, 0)
    rows = rows_of(5)[:200]
    frame = spark.createDataFrame(rows, DDL).selectExpr(
        "*", "1 as conv", "2 as depth", "3 as idx", "'x' as k1", "0 as words", "7 as `_cell`", "8 as shard")
    assert result(frame)[0] == model(rows)


def test_queue_spills_and_keeps_order():
    rng = random.Random(4)
    queue, sent = prefix_trie.SpillingQueue(5), {}
    for _ in range(400):
        order = (-rng.randrange(30), rng.randrange(5))
        queue.push(order, 1, order[1])
        sent[order] = sent.get(order, 0) + 1
    assert len(queue.runs) > 10 and len(queue.heap) <= 5
    for order in sorted({(-d, c) for d in range(30) for c in range(5)}):
        n = sent.get(order, 0)
        assert queue.take(order) == (n, n * order[1])
    assert not queue.heap and not queue.fronts
