"""Cross-entropy difference scoring with matched n-gram models.

A target model (documents labelled good) and a background model (all documents) are word bigram
models of the same form over one vocabulary, and a bigram's estimate is smoothed with the unigram's,

    p(w | v) = (c(v, w) + MU * p(w)) / (c(v) + MU),    p(w) = (c(w) + 1) / (n + V),

where V is the number of distinct words of all documents. Every token's loss
under the target less its loss under the background is averaged over a document: low scores look
like the target.

Counts are exact: words and bigrams are keys of 64 bits, and no two share a count but by a collision
of whole hashes. A word precedes another as often as it occurs, less the documents that it ends, so
c(v) needs no keys of its own, only a count of ends beside that of the word. Documents are dealt by
id and text into parts of about ``PART_BYTES`` of text. A part sends each distinct key once with its
own counts, so a bigram that every document has is one entry a part; keys meet in shards, a range of
hashes each of about ``SHARD_BYTES`` of text, and every part gets the sums of its keys back, in their
order. No table of counts passes through the driver or is held whole by a task: what comes back are
three totals.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm import batches as B
from tickweave.llm.frames import NO_ID, arrow_schema, keyed_texts, materialize

MU = 16.0
PART_BYTES = 4 << 20      # text of one part
SHARD_BYTES = 1 << 20     # text whose keys a shard gets, on average; its keys take 2 to 4 MB
MIN_SHARDS = 64
U64 = np.uint64
BOUNDARY = U64(0x51ED270B9F1C7A35)   # the word before the first of a document
BIGRAM, WORD, START = range(3)       # the lowest two bits of a key
STEP = U64(0x9E3779B97F4A7C15)


def token_keys(piece: B.Slice):
    """Row and keys (word, word before, bigram) of every token of a slice."""
    words = B.find_words(piece.data, piece.offsets, B.ALPHANUMERIC, lower=True)
    row = np.repeat(np.arange(len(words.counts)), words.counts)
    first = words.first[:-1][words.counts > 0]
    before = np.empty_like(words.code)
    before[1:] = words.code[:-1]
    before[first] = BOUNDARY
    word = kind_key(B.mix(words.code + U64(1)), WORD)
    head = np.empty_like(word)
    head[1:] = word[:-1]
    head[first] = START_KEY
    return row, word, head, kind_key(B.mix(before * STEP + words.code), BIGRAM)


def kind_key(code: np.ndarray, kind: int) -> np.ndarray:
    return code & ~U64(3) | U64(kind)


START_KEY = kind_key(BOUNDARY, START)


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shards are ranges: keys in their order are in the order of shards."""
    return ((keys >> U64(32)) * U64(shards) >> U64(32)).astype(np.int64)


def planes(values: np.ndarray) -> bytes:
    """The bytes the largest value needs, then all first bytes before all second ones, and so on."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    raw = np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8)
    return bytes([width]) + raw[:, :width].T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    width = int(raw[0])
    out = np.zeros(((len(raw) - 1) // width, 8), np.uint8)
    out[:, :width] = raw[1:].reshape(width, -1).T
    return out.view("<u8").ravel()


def added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in their order and the sums of their counts (models x keys)."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(fresh)
    sums = np.add.reduceat(counts[:, order], at, axis=1) if len(at) else counts
    return keys[at], sums


def runs(stream, column: str):
    """The value and the batches of each run of equal values of a column of longs."""
    held, value = [], None
    for batch in stream:
        if not batch.num_rows:
            continue
        own = batch.column(batch.schema.get_field_index(column)).to_numpy()
        cuts = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1), len(own)]
        for low, high in zip(cuts, cuts[1:]):
            if held and value != own[low]:
                yield int(value), held
                held = []
            value = own[low]
            held.append(batch.slice(low, high - low))
    if held:
        yield int(value), held


def slice_counts(piece: B.Slice, labelled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a slice; occurrences in all and good documents, ends of all and good ones."""
    row, word, _, bigram = token_keys(piece)
    good = np.isin(np.asarray(piece.rows.column(2)), labelled)
    last = np.flatnonzero(np.append(row[1:] != row[:-1], True)[:len(row)])
    ending = good[row[last]]
    found = np.concatenate([word, bigram, np.full(len(last), START_KEY)])
    of_good = np.concatenate([good[row], good[row], ending]).astype(np.int64)
    keys, counts = added(found, np.stack([np.ones(len(found), np.int64), of_good]))
    ends = np.zeros_like(counts)
    at = np.searchsorted(keys, word[last])
    np.add.at(ends[0], at, 1)
    np.add.at(ends[1], at, ending)
    return keys, np.concatenate([counts, ends])


def packed_counts(keys, counts, spans) -> list[list[bytes]]:
    """The columns ``COUNTS`` of some spans of keys; only words have ends."""
    word = keys & U64(3) == U64(WORD)
    return [[planes(row[a:b][word[a:b]] if m >= 2 else row[a:b]) for a, b in spans]
            for m, row in enumerate(counts)]


def unpacked_counts(keys: np.ndarray, columns) -> np.ndarray:
    """Counts x keys from the columns ``COUNTS`` of all spans, in their order."""
    word = keys & U64(3) == U64(WORD)
    out = np.zeros((len(COUNTS), len(keys)), np.int64)
    for m, column in enumerate(columns):
        own = [from_planes(x.as_buffer()) for x in column]
        out[m, word if m >= 2 else slice(None)] = np.concatenate([np.zeros(0, U64), *own])
    return out


COUNTS = ("all", "good", "all_ends", "good_ends")


def count_parts(texts: DataFrame, shards: int) -> DataFrame:
    """``shard, part, keys`` and ``COUNTS``: distinct keys of each part with its counts."""
    ddl = "shard long, part long, keys binary, " + ", ".join(f"{c} binary" for c in COUNTS)
    schema = arrow_schema(ddl)

    def run(stream):
        for part, held in runs(stream, "part"):
            none = np.zeros(0, U64), np.zeros((len(COUNTS), 0), np.int64)
            (keys, counts), waiting, size = none, [], 0
            labelled = np.concatenate([
                np.asarray(b.column(2))[np.asarray(b.column(1)) == 0] for b in held])
            for piece in B.text_slices(held):
                waiting.append(slice_counts(piece, labelled))
                size += len(waiting[-1][0])
                if size > 1 << 20:   # a part of very long texts
                    keys, counts = together([(keys, counts), *waiting])
                    waiting, size = [], 0
            keys, counts = together([(keys, counts), *waiting])
            own = shard_of(keys, shards)
            borders = np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1, [len(own)]])
            spans = list(zip(borders[:-1], borders[1:])) if len(keys) else []
            for first in range(0, len(spans), 256):
                some = spans[first:first + 256]
                yield B.batch_of(
                    schema, [int(own[a]) for a, _ in some], [part] * len(some),
                    [planes(keys[a:b]) for a, b in some],
                    *packed_counts(keys, counts, some))

    return texts.mapInArrow(run, ddl)


def together(several) -> tuple[np.ndarray, np.ndarray]:
    return added(np.concatenate([k for k, _ in several]),
                 np.concatenate([c for _, c in several], axis=1))


def add_up(counted: DataFrame) -> DataFrame:
    """``part, shard`` and ``COUNTS``: the sums over all parts of each part's keys, in their order.

    One more row per shard, of part -1, has the shard's distinct words and tokens of both models.
    """
    ddl = "part long, shard long, " + ", ".join(f"{c} binary" for c in COUNTS)
    schema = arrow_schema(ddl)

    def run(stream):
        for shard, held in runs(stream, "shard"):
            table = pa.Table.from_batches(held)
            parts = table.column("part").to_pylist()
            packed = [from_planes(x.as_buffer()) for x in table.column("keys")]
            borders = np.concatenate([[0], np.cumsum([len(x) for x in packed])])
            own = np.concatenate(packed)
            counts = unpacked_counts(own, [table.column(c) for c in COUNTS])
            del table, packed, held
            keys, sums = added(own, counts)
            del counts
            word = keys & U64(3) == U64(WORD)
            tokens = sums[:2, word].sum(axis=1)
            yield B.batch_of(schema, [-1], [shard], [planes(np.array([word.sum(), tokens[0]]))],
                             [planes(tokens[1:])], [b""], [b""])
            for first in range(0, len(parts), 64):
                some = range(first, min(first + 64, len(parts)))
                low, high = borders[some[0]], borders[some[-1] + 1]
                asked = own[low:high]
                yield B.batch_of(
                    schema, [parts[i] for i in some], [shard] * len(some),
                    *packed_counts(asked, sums[:, np.searchsorted(keys, asked)],
                                   [(borders[i] - low, borders[i + 1] - low) for i in some]))

    return counted.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, ddl)


class Models:
    """Vocabulary size and tokens of both models, and the loss of a token from its counts."""

    def __init__(self, words: int, tokens: tuple[int, int]):
        self.words, self.tokens = words, tokens

    def losses(self, model: int, word, head, bigram) -> np.ndarray:
        """Negative log2 probability of each token."""
        single = (word + 1.0) / (self.tokens[model] + self.words)
        return -np.log2((bigram + MU * single) / (head + MU))


def totals(sums: DataFrame) -> Models:
    """Distinct words and the tokens of both models, added up over the shards."""
    ddl = "words long, tokens long, good long"
    schema = arrow_schema(ddl)

    def run(stream):
        for batch in stream:
            first = [from_planes(x.as_buffer()) for x in batch.column(0)]
            good = [from_planes(x.as_buffer()) for x in batch.column(1)]
            yield B.batch_of(schema, [int(x[0]) for x in first], [int(x[1]) for x in first],
                             [int(x[0]) for x in good])

    found = sums.filter("part = -1").select("all", "good").mapInArrow(run, ddl).agg(
        *(F.coalesce(F.sum(c), F.lit(0)) for c in ("words", "tokens", "good"))).first()
    return Models(found[0], (found[1], found[2]))


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """Per row: ``doc_id``, ``n_tokens``, ``target_loss``, ``background_loss`` and ``score``.

    Losses are bits per token; ``score`` is their difference (target less background). The target
    are documents that some label row marks with 1. Words are maximal runs of ASCII letters and
    digits and non-ASCII characters, A-Z lowered. A text without words, or null, has no tokens and
    null losses; a null id is kept and never labelled. Rows that repeat an id count each by itself,
    all of them as target if the id is marked; repeated rows count as often as they occur and get
    equal results. Without any target document the target model is uniform and scores only mirror
    the background.
    """
    source = keyed_texts(docs, id_col, text_col)
    size = source.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts, shards = size // PART_BYTES + 1, max(MIN_SHARDS, size // SHARD_BYTES + 1)
    # by id and text, so that rows which repeat an id do not meet in one part
    dealt = F.pmod(F.xxhash64("_id", "_h"), F.lit(parts)).alias("part")
    texts = source.select(dealt, F.lit(1).alias("kind"), "_id", "text")
    good = labels.filter(F.col(f"`{label_col}`") == 1).select(
        F.col(f"`{id_col}`").cast("long").alias("_id")).filter(F.col("_id") > NO_ID).distinct()
    # every part that has a labelled id hears of it
    marks = source.select("_id", dealt).distinct().join(good.hint("merge"), "_id", "left_semi").select(
        "part", F.lit(0), "_id", F.lit(None).cast("string"))
    meeting = texts.union(marks).repartition("part").sortWithinPartitions("part")
    sums = materialize(add_up(count_parts(meeting, shards)))
    models = totals(sums)

    nothing = lambda kind: F.lit(None).cast(kind)
    replies = sums.filter("part >= 0").select(
        "part", F.col("shard").alias("place"), nothing("long"), nothing("string"), *COUNTS)
    asked = source.select(
        dealt, F.lit(-1).cast("long").alias("place"), "doc_id", "text",
        *(nothing("binary").alias(c) for c in COUNTS))
    ddl = ("doc_id long, n_tokens long, target_loss double, background_loss double, "
           "score double")
    schema = arrow_schema(ddl)

    def run(stream):
        for _, held in runs(stream, "part"):
            table = pa.Table.from_batches(held)
            place = table.column("place").to_numpy()
            own = table.filter(pa.array(place < 0)).combine_chunks().to_batches()
            answers = table.filter(pa.array(place >= 0)).sort_by("place")
            keys = np.zeros(0, U64)
            for piece in B.text_slices(own):
                keys = np.union1d(keys, np.concatenate(token_keys(piece)[1:]))   # starts are heads
            counts = unpacked_counts(keys, [answers.column(c) for c in COUNTS]).astype(np.float64)
            heads = counts[:2] - counts[2:]
            del table, held, answers
            for piece in B.text_slices(own):
                row, word, head, bigram = token_keys(piece)
                at = [np.searchsorted(keys, k) for k in (word, head, bigram)]
                rows = piece.rows.num_rows
                count = np.bincount(row, minlength=rows)
                with np.errstate(invalid="ignore"):
                    means = [np.bincount(row, models.losses(
                        m, counts[m][at[0]], heads[m][at[1]], counts[m][at[2]]), rows) / count
                        for m in (1, 0)]
                empty = count == 0
                target, background = (pa.array(m, mask=empty) for m in means)
                yield B.batch_of(schema, piece.rows.column(2), count, target, background,
                                 pa.array(means[0] - means[1], mask=empty))

    return asked.union(replies).repartition("part").sortWithinPartitions("part").mapInArrow(run, ddl)
