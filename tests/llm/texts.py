"""Small corpora with the awkward cases, and plain models of word cutting."""

from __future__ import annotations

import random
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SYLLABLES = "the of an er in on ti es or en at ha sh wh ea ly ble ing tion é ü ñ".split()


def words(text):
    """Runs of ASCII letters and digits and non-ASCII characters, lowered."""
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def prose(rng, count):
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randrange(1, 4))) for _ in range(count))


def corpus(seed=3, size=40):
    """(doc_id, text) rows: prose, copies, near copies, shared passages, nulls, empty, periodic,
    a long text, a null id and repeated rows."""
    rng = random.Random(seed)
    shared = prose(rng, 90)
    rows = [(i, prose(rng, rng.randrange(1, 160))) for i in range(size)]
    rows += [(100 + i, rows[i % 5][1]) for i in range(12)]
    rows += [(200 + i, f"{prose(rng, 30)}\n{shared} {prose(rng, i * 3)}") for i in range(12)]
    base = prose(rng, 120).split()
    for i in range(25):
        near = list(base)
        for _ in range(rng.randrange(0, 5)):
            near[rng.randrange(len(near))] = f"new{rng.randrange(9)}"
        rows.append((300 + i, " ".join(near)))
    rows += [(400, None), (401, ""), (402, " \n\t"), (403, "ab cd ef " * 80), (404, "x" * 1300),
             (405, "q " * 300), (406, "a b"), (407, "A  b!"), (408, "..."), (409, "日本語 テスト 😀 " * 30),
             (None, rows[2][1]), (None, None), (410, prose(rng, 9000))]
    rows += [rows[0], rows[0], (1, rows[3][1])]
    return rows


DDL = "doc_id long, text string"


def frame(spark, rows):
    return spark.createDataFrame(rows, DDL)


def wide(spark, rows):
    """The same rows with columns whose names the operators use inside."""
    from pyspark.sql import functions as F
    names = ("_id", "_h", "spans", "base", "lines", "_drop", "ids", "good", "_letter", "start")
    return frame(spark, rows).select(
        *[F.lit(i).alias(n) for i, n in enumerate(names)], "doc_id", "text")
