"""Secret scan: fixed patterns, and zstandard novelty of strings in sensitive contexts.

The patterns give the base spans. Beyond them, every long string near a sensitive word is measured:
a compressor is primed with the text around it and with a dictionary of identifiers that the corpus
uses in such contexts, and the marginal cost is what the string adds to the compressed size. Words,
paths and repeated identifiers cost next to nothing; key material costs about as many bytes as it
carries, and is reported as a span of kind ``novel``.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm import batches as B
from tickweave.llm.frames import keyed_texts, materialize

# fixed values: the patterns, and the shortest length of a finding of each
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 12, 18, 16
KINDS = ("assign", "access", "hex", "novel")

# fixed values: words that make a context sensitive
SENSITIVE = re.compile(
    r"passw(?:or)?d|passphrase|secret|token|api[_-]?key|credential|authorization|bearer|private"
    r"[_-]?key|access[_-]?key|client[_-]?id|AKIA|-----BEGIN", re.IGNORECASE | re.ASCII)
STRING = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
INSIDE = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")
IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]{2,}")

REACH = 64              # characters between a sensitive word and a candidate
AROUND = 256            # characters of surrounding text the compressor is primed with, each side
DICTIONARY_BYTES = 16 << 10
MIN_NOVELTY = 0.75      # marginal compressed bytes per byte, of 6 bits of content
SLACK = 0.97            # a sample of fewer symbols may cost that much less
# fixed values: bits a character of strings that hold a digit and no other characters
ALPHABETS = [(re.compile(expr), bits) for expr, bits in (
    (r"[0-9]+", np.log2(10)), (r"[0-9A-F]+|[0-9a-f]+", 4.0), (r"[2-7A-Z]+|[2-7a-z]+", 5.0),
    (r"[0-9A-Z]+|[0-9a-z]+", np.log2(36)))]
DIGIT = re.compile(r"[0-9]")
RUN = re.compile(r"[A-Za-z0-9]+")
LEVEL = 3


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Leftmost non-overlapping matches of each kind that are long enough, by start then kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
             if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)
                  if m.end() - m.start() >= MIN_ACCESS]
    # a run of hex digits is maximal, so the length may sit in the pattern
    found += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]
    return [(start, end, KINDS[kind]) for start, kind, end in sorted(found)]


LONG_HEX = re.compile(r"[0-9a-f]{%d,}" % MIN_HEX)


def candidates(text: str, base: list[tuple[int, int, str]]):
    """Spans of long strings near sensitive words, and their surroundings without the strings.

    Surroundings hold no candidate, no base span and no other copy of a candidate's string.
    """
    spans, done, ahead = [], 0, 0   # no string starts between the last one and ``ahead``
    starts = [start for start, _, _ in base]
    reached = list(accumulate((end for _, end, _ in base), max))   # the furthest end so far
    for word in SENSITIVE.finditer(text):
        low, high = max(0, word.start() - REACH), word.end() + REACH
        if ahead > high:
            continue
        first = max(low, done)
        while first > done and text[first - 1] in INSIDE:   # a string that reaches into the window
            first -= 1
        for m in STRING.finditer(text, first):
            if m.start() > high:
                ahead = m.start()
                break
            done = m.end()
            before = bisect_left(starts, m.end())
            if before and reached[before - 1] > m.start():   # meets a base span
                continue
            spans.append((m.start(), m.end()))
        else:
            break   # no more strings
    if not spans:
        return []
    strings = {text[start:end] for start, end in spans}
    blanks = sorted(spans + [(start, end) for start, end, _ in base])
    reached = list(accumulate((end for _, end in blanks), max))
    return [(start, end, surroundings(text, start, end, blanks, reached, strings))
            for start, end in spans]


def surroundings(text: str, start: int, end: int, blanks, reached, strings: set[str]) -> str:
    """The text ``AROUND`` a span without ``blanks`` (by start) and copies of ``strings``.

    ``reached`` has the furthest end of the blanks up to each, so those before the text are skipped.
    """
    low, high = max(0, start - AROUND), min(len(text), end + AROUND)
    # a string that the border cuts may be the rest of a copy
    while 0 < low < start and text[low - 1] in INSIDE and text[low] in INSIDE:
        low += 1
    while end < high < len(text) and text[high] in INSIDE and text[high - 1] in INSIDE:
        high -= 1
    kept, at = [], low
    for first, last in blanks[bisect_right(reached, low):bisect_left(blanks, (high,))]:
        if last > at:
            kept.append(text[at:max(at, first)])
            at = last
    kept.append(text[at:high])
    around = STRING.sub(lambda m: " " if m.group() in strings else m.group(), " ".join(kept))
    return around.replace(text[start:end], " ")


def least_novelty(string: str) -> float:
    """The marginal cost a byte from which a string is novel: what its own alphabets can carry.

    Each run of letters and digits has the smallest alphabet that it fits; runs without a digit may
    be words, and they and the separators count as base64.
    """
    bits = 6.0 * len(string)
    for run in RUN.findall(string):
        if DIGIT.search(run):
            own = next((b for expr, b in ALPHABETS if expr.fullmatch(run)), 6.0)
            bits -= (6.0 - own) * len(run)
    share = bits / (6.0 * len(string))
    return MIN_NOVELTY * (share if share == 1.0 else share * SLACK)


class Novelty:
    """Marginal compressed bytes of a string after its surroundings and the identifiers."""

    def __init__(self, dictionary: bytes):
        self.dictionary = dictionary

    def cost(self, string: str, around: str) -> float:
        primed = self.dictionary + around.encode()
        coder = zstandard.ZstdCompressor(
            level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False,
            dict_data=zstandard.ZstdCompressionDict(
                primed, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
        raw = string.encode()
        # the same frame around nothing costs the same headers
        return (len(coder.compress(raw)) - len(coder.compress(b""))) / len(raw)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, base spans and candidates; reads every whole text once."""
    found = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])
    seen = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("string", pa.string()),
                      ("around", pa.string())])
    schema = pa.schema([("doc_id", pa.int64()), ("base", pa.list_(found)),
                        ("candidates", pa.list_(seen))])

    def run(stream):
        for piece in B.text_slices(stream):
            base, more = [], []
            for text in piece.rows.column(1).to_pylist():
                spans = base_spans(text or "")
                base.append(spans)
                more.append([(s, e, text[s:e], a) for s, e, a in candidates(text or "", spans)])
            base = [[dict(zip(("start", "end", "kind"), x)) for x in spans] for spans in base]
            more = [[dict(zip(("start", "end", "string", "around"), x)) for x in spans]
                    for spans in more]
            yield pa.RecordBatch.from_arrays(
                [piece.rows.column(0), pa.array(base, schema.field(1).type),
                 pa.array(more, schema.field(2).type)], schema=schema)

    return keyed_texts(docs, id_col, text_col).select("doc_id", "text").mapInArrow(
        run, "doc_id long, base array<struct<start:long,end:long,kind:string>>, "
             "candidates array<struct<start:long,end:long,string:string,around:string>>")


def identifier_dictionary(scanned: DataFrame) -> bytes:
    """The identifiers most used around candidates, the commonest last (nearest to the data).

    Counted over the distinct surroundings of all documents, so copies count once; the list that
    comes back ends at ``DICTIONARY_BYTES``, the dictionary's size.
    """
    words = scanned.select(F.explode("candidates.around").alias("around")).distinct().select(
        F.explode(F.array_distinct(F.regexp_extract_all(
            "around", F.lit(IDENTIFIER.pattern), F.lit(0)))).alias("word"))
    ranked = words.groupBy("word").count().orderBy(F.desc("count"), "word").limit(
        DICTIONARY_BYTES // 4)
    kept, size = [], 0
    for row in ranked.collect():
        size += len(row["word"]) + 1
        if size > DICTIONARY_BYTES:
            break
        kept.append(row["word"])
    return " ".join(reversed(kept)).encode()


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id`` and ``spans``, an array of (start, end, kind, novelty) by start and kind.

    Positions count code points, ends are exclusive. ``novelty`` is null for the base kinds. A null
    text is empty and has no spans; a null id is kept; repeated rows give repeated results.
    """
    scanned = materialize(scan(docs, id_col, text_col))
    novelty = Novelty(identifier_dictionary(scanned))
    novel = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()),
                       ("novelty", pa.float64())])
    schema = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(novel))])
    rank = {kind: i for i, kind in enumerate(KINDS)}

    def score(stream):
        for batch in stream:
            rows = []
            for base, more in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                spans = [dict(x, novelty=None) for x in base]
                for x in more:
                    cost = novelty.cost(x["string"], x["around"])
                    if cost >= least_novelty(x["string"]):
                        spans.append({"start": x["start"], "end": x["end"], "kind": "novel",
                                      "novelty": cost})
                rows.append(sorted(spans, key=lambda x: (x["start"], rank[x["kind"]])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, schema.field(1).type)], schema=schema)

    return scanned.mapInArrow(
        score, "doc_id long, spans array<struct<start:long,end:long,kind:string,novelty:double>>")


def spans_text(spans, kinds=KINDS) -> "F.Column":
    """``kind:start:end`` of the spans of some kinds, comma-joined in their order."""
    own = F.filter(spans, lambda x: x["kind"].isin(list(kinds)))
    return F.array_join(F.transform(own, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def count_of(spans, kind: str):
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")
