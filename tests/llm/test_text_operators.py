"""The other operators on texts against plain models."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest

from tests.llm.texts import corpus, frame, prose, spaced, wide, words
from tickweave.llm import (
    language_id, line_templates, lm_scoring, lsh_forest, pieces, secrets, winnowing,
)


# -------------------------------------------------------------------------------- 1 secrets
SECRET_TEXTS = [
    (1, 'x password = "abcdefghijkl" y'), (2, "token=short; Secret:0123456789abcdef0"),
    (3, "AKIA12345678901234 AKIAABC deadbeefdeadbeef0 deadbeef"), (4, None), (5, ""),
    (6, 'password=token":abcdefghijklmnop'), (7, "ſecret=abcdefghijklmnop API_KEY: 'Zz9/+=_.-aaaa'"),
    (8, "é" * 50 + ' apikey="q9X2v7LmT4rB8nKc1WzY5pQd"'), (None, "passwd:aaaaaaaaaaaaa"),
    (9, "auth bearer Qm7ZxT9vKpL2sWcR4yUbN8dHfJ3gAeXo follows"),
    (10, "the token is somethingsomethingsomething something"), (8, "a" * 40),
]


def plain_spans(text):
    found = []
    pattern = (r"((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|"
               r"(?:[Ss][Ee][Cc][Rr][Ee][Tt])|(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))"
               r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
    for rank, (kind, expr, group, least) in enumerate((
            ("assign", pattern, 2, 12), ("access", r"AKIA[A-Z0-9]+", 0, 18),
            ("hex", r"[0-9a-f]+", 0, 16))):
        found += [(m.start(), rank, f"{kind}:{m.start()}:{m.end()}")
                  for m in re.finditer(expr, text) if len(m.group(group)) >= least]
    return ",".join(x for _, _, x in sorted(found))


def test_secrets(spark):
    from pyspark.sql import functions as F
    base = secrets.KINDS[:3]
    got = secrets.find_secrets(wide(spark, SECRET_TEXTS)).select(
        "doc_id", secrets.spans_text("spans", base), secrets.spans_text("spans"),
        F.size("spans")).collect()
    assert Counter((r[0], r[1]) for r in got) == Counter(
        (i, plain_spans(t or "")) for i, t in SECRET_TEXTS)
    novel = {r[0]: r[2] for r in got if "novel" in r[2]}
    # key material without a name=value form; no findings of the base kinds again, no prose
    assert 9 in novel and not set(novel) & {1, 2, 3, 8, 10}
    assert secrets.find_secrets(frame(spark, [])).count() == 0


def test_secrets_written_twice_do_not_hide_each_other(spark):
    keys = ["Qm7ZxT9vKpL2sWcR4yUbN8dHfJ3gAeXo5kTi0PqE", "b8GyLw1RzVn6MjXs3CuDh9FaKe2QtOp7YiBx4ZmW"]
    text = f"bearer {keys[0]} then the bearer {keys[1]} and again bearer {keys[0]} sent"
    rows = [(i, f"{text} {'x' * i}") for i in range(30)] + [(50, text), (51, text)]
    for row in secrets.find_secrets(frame(spark, rows)).collect():
        assert [text[s.start:s.end] for s in row.spans if s.kind == "novel"] == [*keys, keys[0]]
    around = [a for _, _, a in secrets.candidates(text, [])]
    assert len(around) == 3 and not any(k[5:15] in a for a in around for k in keys)


def plain_candidates(text, base):
    """Whole strings that start in reach of a sensitive word or reach into it, less base spans."""
    found = []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{16,}", text):
        near = any(w.start() - secrets.REACH < m.end() and m.start() <= w.end() + secrets.REACH
                   for w in secrets.SENSITIVE.finditer(text))
        if near and not any(a < m.end() and m.start() < b for a, b, _ in base):
            found.append(m.span())
    return found


def test_secrets_of_a_long_text_take_linear_time():
    import random
    import time
    rng = random.Random(3)
    key = lambda n: "".join(rng.choices("QWERTZUIOPqwertzuiop0123456789", k=n))
    text = " ".join(f"bearer {key(24)} and token={key(20)} {prose(rng, rng.randrange(60))} "
                    f"{key(30)} or secret {key(40)}" for _ in range(40))
    base = secrets.base_spans(text)
    found = secrets.candidates(text, base)
    assert [(start, end) for start, end, _ in found] == plain_candidates(text, base)
    for start, end, around in found:   # nothing of a candidate or a base span is left around it
        low, high = max(0, start - secrets.AROUND), end + secrets.AROUND
        assert not any(text[a:b] in around for a, b, _ in found)
        assert not any(low <= a and b <= high and text[a:b] in around for a, b, _ in base)
    for long in (text * 1000, "the token of " * 10**6):
        started = time.monotonic()
        secrets.candidates(long, secrets.base_spans(long))
        assert time.monotonic() - started < 40


def test_secrets_of_any_alphabet_and_place_are_whole(spark):
    rng = __import__("random").Random(9)
    full = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = [("".join(rng.choices(letters, k=size)), gap) for letters, size, gap in (
        (full, 40, 51), (full, 40, 29), ("0123456789ABCDEF", 80, 1), ("0123456789ABCDEF", 400, 1),
        ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 1024, 1))]
    rows = [(i, f"{k}{' ' * gap}token of the day") for i, (k, gap) in enumerate(keys)]
    rows.append((90, "token " + "/some/path/of/words" * 9))
    got = {r["doc_id"]: r["spans"] for r in secrets.find_secrets(frame(spark, rows)).collect()}
    for i, (key, _) in enumerate(keys):
        assert [(s.start, s.end, s.kind) for s in got[i]] == [(0, len(key), "novel")], i
    assert got[90] == []


# -------------------------------------------------------------------------------- 3 join
def linked(rows):
    sets = []
    for ident, text in rows:
        w = words(text)
        grams = frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) or frozenset([tuple(w)])
        sets.append((ident, grams if w else None))
    distinct = list({s for _, s in sets if s})
    part, degree = list(range(len(distinct))), Counter()

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for i, a in enumerate(distinct):
        for j in range(i):
            b = distinct[j]
            if len(a & b) >= 0.8 * len(a | b):
                degree[i] += 1
                degree[j] += 1
                part[root(i)] = root(j)
    where = {s: i for i, s in enumerate(distinct)}
    name, same = {}, {}
    for ident, s in sets:
        if s and ident is not None:
            name[root(where[s])] = min(name.get(root(where[s]), ident), ident)
            same[where[s]] = min(same.get(where[s], ident), ident)
    return Counter((i, name[root(where[s])] if s else i, same[where[s]] if s else i,
                    len(s) if s else 0, degree[where[s]] if s else 0) for i, s in sets)


@pytest.mark.parametrize("block", [256, 7])
def test_jaccard_join(spark, block):
    rows = corpus()
    got = lsh_forest.jaccard_join(wide(spark, rows), block_members=block).collect()
    assert Counter(map(tuple, got)) == linked(rows)


def test_one_per_class(spark):
    rows = corpus()
    kept = Counter(lsh_forest.one_per_class(wide(spark, rows)).select("doc_id", "text").rdd.map(
        tuple).collect())
    low = lambda i: -(1 << 63) if i is None else i
    named = [(i, t) for i, t in rows if i is not None]
    classes = {(i, s): c for i, c, s, *_ in linked(named)}
    assert kept[(None, None)] == 1 and kept[(400, None)] == 1 and kept[(401, "")] == 1
    for ident, text in set(rows):
        if words(text) and text != rows[2][1]:
            # the smallest id of each class stays; id 1 has two texts of different classes
            own = {c for (i, _), c in classes.items() if i == ident}
            if len(own) == 1:
                assert bool(kept[ident, text]) == (own == {ident}), ident
    # of the copies of this text the row without id counts as the smallest
    assert [i for i, t in kept if t == rows[2][1]] == [None]
    assert kept[rows[0]] == 3         # repeated rows stay together
    assert sum(kept.values()) < len(rows) and all(low(i) is not None for i, _ in kept)
    assert lsh_forest.one_per_class(frame(spark, [])).count() == 0


def test_prefix_is_shortened_to_the_recall():
    length = lsh_forest.prefix_length()
    recall = 1 - (1 - 0.8 ** length) ** lsh_forest.TREES
    longer = 1 - (1 - 0.8 ** (length + 1)) ** lsh_forest.TREES
    assert recall >= lsh_forest.TARGET_RECALL > longer


# -------------------------------------------------------------------------------- 4 scoring
def test_lm_scoring(spark):
    import math
    rows = corpus(size=15)[:60]
    good = {i for i, _ in rows if i is not None and i % 2 == 0}
    labels = spark.createDataFrame(
        [(i, 1 if i in good else 0) for i, _ in rows if i is not None] + [(None, 1), (5, None)],
        "doc_id long, quality int")
    got = lm_scoring.score_documents(wide(spark, rows), labels).collect()

    def pairs_of(text):
        found = words(text)
        return list(zip([None, *found], found))

    counts = [(Counter(), Counter(), Counter()) for _ in range(2)]
    for ident, text in rows:
        for model in ((0, 1) if ident in good else (0,)):
            for v, w in pairs_of(text):
                for own, key in zip(counts[model], (w, v, (v, w))):
                    own[key] += 1
    size = len(counts[0][0])

    def loss(model, v, w):
        single, heads, pairs = counts[model]
        p = (single[w] + 1) / (sum(single.values()) + size)
        return -math.log2((pairs[v, w] + lm_scoring.MU * p) / (heads[v] + lm_scoring.MU))

    expected = defaultdict(list)
    for ident, text in rows[:25]:
        found = pairs_of(text)
        expected[ident].append([sum(loss(m, *c) for c in found) / len(found) for m in (1, 0)]
                               if found else None)
    by_id = defaultdict(list)
    for r in got:
        by_id[r["doc_id"]].append(r)
    for ident, values in expected.items():
        for value in values:
            if value is None:
                assert any(r["score"] is None and r["n_tokens"] == 0 for r in by_id[ident])
            else:
                assert any(r["score"] is not None
                           and abs(r["target_loss"] - value[0]) < 1e-4
                           and abs(r["background_loss"] - value[1]) < 1e-4
                           and abs(r["score"] - value[0] + value[1]) < 2e-4 for r in by_id[ident])
    assert len(got) == len(rows)
    assert lm_scoring.score_documents(frame(spark, []), labels).count() == 0


def test_lm_scoring_counts_every_word_and_bigram_alone(spark, monkeypatch):
    import math
    rng = __import__("random").Random(6)
    rows = [(i, " ".join(f"w{rng.randrange(60000)} the of" for _ in range(3000))) for i in range(24)]
    rows += [(None, "the of"), (30, None)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(24)], "doc_id long, quality int")
    monkeypatch.setattr(lm_scoring, "PART_BYTES", 1 << 16)
    got = {r["doc_id"]: r for r in lm_scoring.score_documents(frame(spark, rows), labels).collect()}
    counts = [(Counter(), Counter(), Counter()) for _ in range(2)]
    for ident, text in rows:
        for model in ((0, 1) if ident in range(1, 24, 2) else (0,)):
            w = words(text)
            for own, found in zip(counts[model], (w, [None, *w][:-1] if w else [], zip([None, *w], w))):
                own.update(found)
    size = len(counts[0][0])
    for ident, text in rows:
        w, losses = words(text), []
        for single, heads, pairs in counts[::-1]:
            n = sum(single.values())
            losses.append(sum(-math.log2(
                (pairs[v, x] + lm_scoring.MU * (single[x] + 1) / (n + size)) / (heads[v] + lm_scoring.MU))
                for v, x in zip([None, *w], w)) / max(1, len(w)))
        if not w:
            assert got[ident]["score"] is None and got[ident]["n_tokens"] == 0
        else:
            assert abs(got[ident]["target_loss"] - losses[0]) < 1e-9
            assert abs(got[ident]["background_loss"] - losses[1]) < 1e-9
    assert len(got) == len(rows)


def test_planes_take_the_bytes_their_values_need():
    import numpy as np
    for values, width in (([], 1), ([0], 1), ([255, 3], 1), ([256, 0, 7], 2), ([(1 << 64) - 1, 5], 8)):
        packed = lm_scoring.planes(np.array(values, np.uint64))
        assert len(packed) == 1 + width * len(values)
        assert lm_scoring.from_planes(packed).tolist() == values


def test_lm_scoring_of_an_id_that_repeats(spark, monkeypatch):
    from pyspark.sql import functions as F
    rows = [(7, f"one of many words {i % 500}") for i in range(20000)] + [(8, "words of one"), (7, None)]
    labels = spark.createDataFrame([(7, 1), (8, 0)], "doc_id long, quality int")
    monkeypatch.setattr(lm_scoring, "PART_BYTES", 1 << 12)
    got = lm_scoring.score_documents(frame(spark, rows), labels)
    found = got.groupBy("doc_id", "n_tokens").agg(F.count("*").alias("n")).collect()
    assert {(r["doc_id"], r["n_tokens"]): r["n"] for r in found} == {(7, 5): 20000, (8, 3): 1, (7, 0): 1}
    # every row of the id is target, so the target model has seen its bigrams as often as all have
    sides = got.filter("doc_id = 7 and n_tokens = 5").agg(
        F.max(F.abs("score")).alias("most"), F.countDistinct("score").alias("kinds")).first()
    assert sides["most"] < 0.01 and sides["kinds"] >= 1


# -------------------------------------------------------------------------------- 5 lines
def template_keys(line):
    tokens = ["<*>" if re.search("[0-9@]", w) else w for w in spaced(line)]
    n = len(tokens)
    cuts = [n * q // 4 for q in range(5)]
    if set(tokens) == {"<*>"}:
        return [("bare", *spaced(line))]
    keys = [("all", *tokens)] if n else []
    if n >= 8:
        keys += [(q, n, tuple(tokens[:3]), tuple(tokens[:cuts[q]]), tuple(tokens[cuts[q + 1]:]))
                 for q in range(4)
                 if set(tokens[:3] + tokens[:cuts[q]] + tokens[cuts[q + 1]:]) != {"<*>"}]
    return keys


LINES = [(i, f"opening line number of {prose(__import__('random').Random(i), 9)}\n"
             f"user{i} logged in from 10.0.0.{i} at noon\n\n"
             f"the fixed line of eight {'uvwxyz'[i]} tokens here now\nend") for i in range(6)] + [
    (20, None), (21, ""), (22, "\n\n"), (23, "end\nend\nother"), (None, "end\nfree"), (23, "end\nend\nother")]


def test_line_templates(spark):
    low = lambda i: -(1 << 63) if i is None else i
    found = defaultdict(set)
    for ident, text in LINES:
        for line in (text or "").split("\n"):
            for key in template_keys(line):
                found[key].add((low(ident), text))
    expected = Counter()
    for ident, text in LINES:
        lines = [] if text is None else text.split("\n")
        kept = [x for x in lines if not any(
            len(found[k]) >= 2 and min(found[k]) != (low(ident), text) for k in template_keys(x))]
        expected[ident, None if text is None else "\n".join(kept), len(lines),
                 len(lines) - len(kept)] += 1
    got = line_templates.drop_recurring_lines(wide(spark, LINES))
    assert got.columns == [*wide(spark, LINES).columns, "n_lines", "n_dropped"]
    assert Counter(map(tuple, got.select("doc_id", "text", "n_lines", "n_dropped").collect())) == expected
    copies = line_templates.drop_recurring_lines(frame(spark, LINES), leave_copies=0.5)
    assert {r["doc_id"]: r["n_dropped"] for r in copies.collect()}[23] == 0
    assert line_templates.drop_recurring_lines(frame(spark, [])).count() == 0


def test_lines_of_fields_only_recur_only_as_they_are(spark):
    rows = [(1, "8 42 3\nown one"), (2, "9 40 3\nown two"), (3, "8 42 3\nown three"),
            (4, "1 2 3 4 5 6 7 8 nine"), (5, "2 3 4 5 6 7 8 9 ten"), (6, "7"), (7, "8")]
    got = {r["doc_id"]: r["n_dropped"] for r in
           line_templates.drop_recurring_lines(frame(spark, rows)).collect()}
    assert got == {1: 0, 2: 0, 3: 1, 4: 0, 5: 0, 6: 0, 7: 0}


def test_boilerplate_is_no_copy(spark):
    import random
    block = prose(random.Random(1), 80)
    own = {i: prose(random.Random(100 + i), 50) for i in range(5)}
    rows = [(i, f"{block}\n{own[i]}") for i in range(5)]
    other = "\n".join(prose(random.Random(200 + i), 20) for i in range(5))
    rows += [(10, other), (11, other), (12, other + "\nand a line of its own")]
    got = {r["doc_id"]: r["text"] for r in line_templates.drop_recurring_lines(
        frame(spark, rows), leave_copies=0.5).collect()}
    assert got[0] == rows[0][1] and all(got[i] == own[i] for i in range(1, 5))
    assert [got[i] for i in (10, 11, 12)] == [t for _, t in rows[5:]]


def test_a_line_of_two_documents_recurs(spark):
    passage = prose(__import__("random").Random(5), 60)
    rows = [(1, f"one own line\n{passage}"), (2, f"{passage}\nanother own"), (3, "own too")]
    got = line_templates.drop_recurring_lines(frame(spark, rows)).select(
        "doc_id", "text", "n_dropped").collect()
    assert {tuple(r) for r in got} == {(*rows[0], 0), (2, "another own", 1), (*rows[2], 0)}


# -------------------------------------------------------------------------------- 7 winnowing
def test_winnowing(spark):
    rows = corpus()
    text = {i: t for i, t in rows}
    items = [(1, " ".join(words(text[200])[20:60])), (2, "q q q"), (3, "nowhere to be found"),
             (10, " ".join(words(text[3])[:13]).upper()), (4, None), (5, "..."), (None, text[5]),
             (6, "a"), (7, " ".join(words(text[200])[20:60])), (8, text[410])]
    windows = defaultdict(set)
    for item, body in items:
        w = words(body)
        if w and item is not None:
            size = min(13, len(w))
            for i in range(len(w) - size + 1):
                windows[tuple(w[i:i + size])].add(str(item))
    sizes = {len(k) for k in windows}
    expected = Counter()
    for ident, body in rows:
        w, hit, met = words(body), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                own = windows.get(tuple(w[i:i + size]))
                if own:
                    hit.update(range(i, i + size))
                    met |= own
        expected[ident, len(w), len(hit), tuple(sorted(met)),
                 bool(hit) and 20 * len(hit) >= len(w)] += 1
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = winnowing.contamination(wide(spark, rows), benchmark).collect()
    assert Counter((r[0], r[1], r[2], tuple(r[3]), r[4]) for r in got) == expected
    clean = winnowing.contamination(frame(spark, rows), benchmark.limit(0)).collect()
    assert len(clean) == len(rows) and not any(r["n_hit"] for r in clean)


# -------------------------------------------------------------------------------- 9 pieces
def test_pieces(spark):
    sentencepiece = pytest.importorskip("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    rows = corpus(size=20) + [(500, "  lead  and trail  "), (501, "\n\nx\ty"), (502, "▁a▁ b"),
                              (503, "x" * 400 + " " * 40), (504, "\x00\x01é́ ̈a"),
                              (505, "def f(a_b):\n\treturn {1: 2}  # http://a.b/c?d=e")]
    got = pieces.encode(wide(spark, rows))
    assert got.columns == [c for c in wide(spark, rows).columns if c != "ids"] + ["ids", "round_trip"]
    decoded = pieces.decode(got).select("doc_id", "text", "ids", "round_trip", "decoded").collect()
    for r in decoded:
        if r["text"] is None:
            assert r["ids"] is None and r["round_trip"] is None and r["decoded"] is None
        else:
            assert r["ids"] == library.encode(r["text"])
            assert r["round_trip"] and r["decoded"] == r["text"].replace("▁", " ")
    assert pieces.encode_documents(frame(spark, [])).count() == 0


def test_streaming_search_commits_the_whole_paths():
    model = pieces.model_of(pieces.MODEL)
    for text in ("internationalization" * 40, "日本語テスト" * 60, "ab12-" * 200):
        raw = model.marked(text)
        assert model.stream(raw) == model.short_path(raw.decode())


def slice_of(texts):
    import numpy as np
    raw = [t.encode() for t in texts]
    return (np.frombuffer(b"".join(raw), np.uint8),
            np.concatenate([[0], np.cumsum([len(t) for t in raw])]).astype(np.int64))


def test_remembered_stretches_are_small():
    import tracemalloc
    model = pieces.model_of(pieces.MODEL)
    data, offsets = slice_of([f"{i:x}ing" for i in range(20_000)])
    pieces.encode_slice(model, pieces.Remembered(), data, offsets)    # fills what the model keeps
    tracemalloc.start()
    known = pieces.Remembered()
    pieces.encode_slice(model, known, data, offsets)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert len(known.young) + len(known.old) == 20_000
    assert held < 80 * 20_000


def test_remembered_stretches_give_the_searched_ids():
    import random
    rng = random.Random(6)
    model = pieces.model_of(pieces.MODEL)
    for size in (2, 7, 1000):                                          # generations change often
        known = pieces.Remembered(size)
        for _ in range(8):
            texts = [" ".join(rng.choices(["the", "tion", "wh", "é", "日本", "x" * 90, "a-b", " "],
                                          k=rng.randrange(0, 9))) for _ in range(6)]
            ids, borders, _, _ = pieces.encode_slice(model, known, *slice_of(texts))
            for i, text in enumerate(texts):
                assert ids[borders[i]:borders[i + 1]].tolist() == model.encode(text)
            assert len(known.young) <= max(1, size // 2)


def test_equal_codes_of_different_stretches():
    import numpy as np
    model = pieces.model_of(pieces.MODEL)
    known, code = pieces.Remembered(), np.array([7], np.uint64)
    for word in (b" the", b" tha", b" then", b" the"):
        data = np.frombuffer(word, np.uint8)
        ids, counts = known.encode(model, code, data, word, np.array([0]), np.array([len(word)]))
        assert ids.tolist() == model.search(word.replace(b" ", pieces.SPACE)) and counts[0] == len(ids)


def test_unigram_search_is_the_best_path():
    import random
    rng = random.Random(4)
    listed = ["<unk>"] + [f"<0x{b:02X}>" for b in range(256)] + ["▁", "a", "b", "c", "ab", "bc",
                                                                  "abc", "▁a", "ca", "cab"]
    kinds = [2] + [6] * 256 + [1] * 10
    scores = [0.0] * 257 + [round(-rng.random() * 5, 3) for _ in range(10)]
    model = pieces.Model([p.encode() for p in listed], scores, kinds, bpe=False, prefix=True)

    def best(raw):
        table = {0: (0.0, ())}
        for end in range(1, len(raw) + 1):
            ways = [(table[s][0] + scores[i], (*table[s][1], i)) for s in table
                    for i in [model.ids.get(raw[s:end])] if i is not None]
            if ways:
                table[end] = max(ways)
        return table[len(raw)][0]

    for _ in range(50):
        raw = model.marked("".join(rng.choices("abc ", k=300)))
        ids = model.search(raw)
        assert b"".join(model.pieces[i] for i in ids) == raw
        assert abs(sum(scores[i] for i in ids) - best(raw)) < 1e-6


# -------------------------------------------------------------------------------- 10 language
def languages(count=60):
    import random
    own = {"en": "the of and ing tion wh", "de": "sch ung ü der keit ß", "fr": "eau ç é oux ment qu"}
    rows = []
    for i in range(count * 3):
        lang = list(own)[i % 3]
        rng = random.Random(i)
        text = " ".join("".join(rng.choices(own[lang].split(), k=2)) for _ in range(rng.randrange(3, 90)))
        rows.append((i, text, lang))
    return rows + [(1000, None, "en"), (1001, "", None), (1002, "12 34 !", "de"),
                   (None, "the and", "en"), (1003, "der ung " * 3000, None)]


def test_language_id(spark):
    import zlib
    from pyspark.sql import functions as F
    rows = languages()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    network = language_id.fit(docs)
    assert network.languages == ["de", "en", "fr"]
    wide_docs = docs.select(F.lit(1).alias("_letter"), F.lit("x").alias("lang_pred"), "*")
    got = language_id.predict(wide_docs, network).select(
        "doc_id", "text", "lang", "lang_pred", "score",
        language_id.held_out("doc_id").alias("held_out")).collect()
    assert len(got) == len(rows)
    right = []
    for r in got:
        ident = r["doc_id"]
        assert r["held_out"] == (ident is not None and zlib.crc32(str(ident).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1
        if not r["text"] or not re.search("[a-zA-Zé]", r["text"]):
            assert r["lang_pred"] == "und" and r["score"] == 0
        elif r["held_out"] and r["lang"]:
            right.append(r["lang"] == r["lang_pred"])
    assert sum(right) >= 0.95 * len(right) and len(right) > 20
    assert {r["doc_id"]: r["lang_pred"] for r in got}[1003] == "de"


def test_network_tables_agree():
    import numpy as np
    network = language_id.train([t.encode()[:256] for _, t, g in languages() if t and g],
                                [g for _, t, g in languages() if t and g])
    windows = np.random.default_rng(0).integers(0, 64, (20, language_id.WINDOW)).astype(np.uint8)
    assert np.allclose(network.responses(windows)[0], network.fast()(windows), atol=1e-4)


def test_language_id_is_the_plain_convolution(spark):
    import numpy as np
    rows = [r for r in languages(8) if r[1] and re.search("[a-zé]", r[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    network = language_id.fit(docs)
    got = {r["text"]: (r["lang_pred"], r["score"]) for r in language_id.predict(docs, network).collect()}

    def chances(window):
        pooled = []
        for width in language_id.WIDTHS:
            sums = [sum(network.filters[width][j][window[at + j]] for j in range(width))
                    for at in range(len(window) - width + 1)]
            pooled.append(np.max(sums, axis=0))
        score = np.maximum(np.concatenate(pooled) + network.bias, 0) @ network.weights + network.offset
        return np.exp(score - score.max()) / np.exp(score - score.max()).sum()

    for _, text, _ in rows[:9] + rows[-1:]:
        raw = list(language_id.TABLE[list(text.encode()[:40000])])
        total = 0
        for at in range(0, len(raw), language_id.WINDOW):
            share = min(language_id.WINDOW, len(raw) - at)
            low = max(0, min(at, len(raw) - language_id.WINDOW))   # the last one is moved back
            window = raw[low:low + language_id.WINDOW]
            total = total + share * chances(window + [0] * (language_id.WINDOW - len(window)))
        total = total / len(raw)
        assert got[text][0] == network.languages[int(total.argmax())]
        assert abs(got[text][1] - total.max()) < 1e-3


def test_language_id_learns_from_repeated_rows_and_cuts_long_texts(spark):
    from pyspark.sql import functions as F
    one = "schung derung keit ß und ung sch der " * 4
    rows = [(i, t, g) for i, t, g in languages() if g == "en" and t]
    ident = next(i for i in range(10**6, 10**6 + 9) if __import__("zlib").crc32(str(i).encode()) % 3 != 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").union(
        spark.range(5000).select(F.lit(ident), F.lit(one), F.lit("de"))).union(
        spark.range(1).select(F.lit(ident), F.repeat(F.lit("eau ç qu oux "), 1 << 22), F.lit("fr")))
    network = language_id.fit(docs)
    assert network.languages == ["de", "en", "fr"]
    got = language_id.predict(docs.filter("length(text) < 1000000"), network)
    assert got.filter("lang = 'de' and lang_pred = 'de'").count() == 5000
    cut = spark.createDataFrame([("a" * 256 + "é" * 512 + "z",), ("kurz",)], "t string").select(
        language_id.training_windows(F.col("t")).alias("w")).collect()
    raw = ("a" * 256 + "é" * 512 + "z").encode()
    assert [bytes(w) for w in cut[0]["w"]] == [raw[at:at + 256] for at in (0, 341, 683, 1025)]
    assert [bytes(w) for w in cut[1]["w"]] == [b"kurz"]


def test_language_id_without_labels(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert language_id.fit(docs) is None
    assert language_id.predict(docs, None).first()["lang_pred"] == "und"
    assert language_id.predict(docs.limit(0), None).count() == 0
