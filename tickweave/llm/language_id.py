"""Language identification with a byte convolutional network.

Text is lowered (ASCII), mapped to 64 byte classes and cut into windows of 256 bytes. Filters of
widths 2, 3 and 4 slide over one-hot classes, each is max-pooled over the window, and a softmax
layer turns the pooled features into language probabilities; a document averages its windows. The
network is trained in numpy on a bounded sample of labelled texts and applied inside Spark tasks.

A filter over one-hot input is a sum of table rows, so a window costs table lookups: pairs of
neighbouring classes are looked up once and serve all widths.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.llm import batches as B
from tickweave.llm.frames import fresh, quoted, ship_code

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8                # per width
CLASSES = 64
SAMPLE_PER_LANGUAGE = 400  # distinct labelled texts the network is fitted on, per language
WINDOWS_PER_DOCUMENT = 4   # training windows of each of them, spread over the whole text
MAX_LANGUAGES = 200        # bound of the output layer
EPOCHS = 6
MIN_STEPS = 400            # small samples are gone over more often
UNKNOWN = "und"


def byte_classes() -> np.ndarray:
    """256 bytes to 64 classes: space and line ends, letters, digits, other ASCII, 32 for the rest."""
    table = np.full(256, 28, np.uint8)              # other ASCII
    table[[0x20, 0x09, 0x0A, 0x0D, 0x0B, 0x0C]] = 0
    table[0x61:0x7B] = np.arange(1, 27)
    table[0x41:0x5B] = np.arange(1, 27)
    table[0x30:0x3A] = 27
    high = np.arange(128)
    table[0x80:] = 32 + high % 32                   # lead bytes meet continuation bytes in pairs
    table[0xC0:] = 29                               # lead bytes of two
    table[0xE0:] = 30                               # of three
    table[0xF0:] = 31                               # of four
    return table


TABLE = byte_classes()


@dataclass
class Network:
    """Filter tables by width, offset and class; output weights over the pooled features."""

    languages: list[str]
    filters: dict[int, np.ndarray]   # width -> (width, CLASSES, FILTERS)
    bias: np.ndarray                 # (len(WIDTHS) * FILTERS,)
    weights: np.ndarray              # (features, languages)
    offset: np.ndarray               # (languages,)

    def responses(self, windows: np.ndarray):
        """Max and its place of every filter over each row of (count, WINDOW) classes."""
        pooled, places = [], []
        for width in WIDTHS:
            table = self.filters[width]
            span = windows.shape[1] - width + 1
            total = table[0][windows[:, :span]]
            for j in range(1, width):
                total = total + table[j][windows[:, j:j + span]]
            places.append(total.argmax(axis=1))
            pooled.append(np.take_along_axis(total, places[-1][:, None], 1)[:, 0])
        return np.concatenate(pooled, 1) + self.bias, places

    def probabilities(self, pooled: np.ndarray) -> np.ndarray:
        scores = np.maximum(pooled, 0) @ self.weights + self.offset
        scores -= scores.max(axis=1, keepdims=True)
        np.exp(scores, out=scores)
        return scores / scores.sum(axis=1, keepdims=True)

    def fast(self):
        """Pooled features through pair tables (the same sums, fewer lookups)."""
        one, two, three = (self.filters[w] for w in WIDTHS)

        def pairs(table):
            return (table[0][:, None] + table[1][None]).reshape(CLASSES * CLASSES, -1)

        # width 2, the first pair of width 3 and both pairs of width 4, side by side
        ahead = np.concatenate([pairs(one), pairs(three[:2])], 1).astype(np.float32)
        first3 = pairs(two[:2]).astype(np.float32)
        # the third position of width 3 joins the pair table of the next position
        last = (np.zeros((CLASSES, 1, FILTERS)) + two[2][None]).reshape(CLASSES * CLASSES, -1)
        back = np.concatenate([last, pairs(three[2:])], 1).astype(np.float32)

        def pooled(windows: np.ndarray) -> np.ndarray:
            index = windows[:, :-1].astype(np.int32) * CLASSES + windows[:, 1:]
            low = np.take(ahead, index, axis=0)
            high = np.take(back, index, axis=0)
            mid = np.take(first3, index, axis=0)
            w2 = low[:, :, :FILTERS].max(axis=1)
            mid[:, :-1] += high[:, 1:, :FILTERS]
            w3 = mid[:, :-1].max(axis=1)
            low[:, :-2, FILTERS:] += high[:, 2:, FILTERS:]
            w4 = low[:, :-2, FILTERS:].max(axis=1)
            return np.concatenate([w2, w3, w4], 1) + self.bias

        return pooled


def windows_of(classes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Windows of WINDOW classes from the given starts; what lies beyond ``end`` is spaces."""
    at = start[:, None] + np.arange(WINDOW)
    inside = at < end[:, None]
    return np.where(inside, classes[np.minimum(at, len(classes) - 1)], 0).astype(np.uint8)


def training_windows(text: Column) -> Column:
    """Up to WINDOWS_PER_DOCUMENT windows of WINDOW bytes, spread over the whole text."""
    raw = F.encode(text, "utf-8")
    room = F.greatest(F.lit(0), F.octet_length(text) - WINDOW)
    steps = F.least(F.lit(WINDOWS_PER_DOCUMENT - 1), F.floor(room / WINDOW).cast("int"))
    return F.transform(F.sequence(F.lit(0), steps), lambda k: F.substring(
        raw, F.coalesce(F.floor(room.cast("long") * k / F.nullif(steps, F.lit(0))), F.lit(0)).cast("int")
        + 1, F.lit(WINDOW)))


def train(pieces: list[bytes], labels: list[str], seed: int = 7) -> Network | None:
    """Fit the network to windows of bytes by mini-batch Adam; equal inputs give an equal network."""
    languages = sorted(set(labels))
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    windows = np.zeros((len(pieces), WINDOW), np.uint8)   # what a window lacks is spaces
    for row, piece in zip(windows, pieces):
        row[:len(piece)] = TABLE[np.frombuffer(piece, np.uint8)]
    place = {language: i for i, language in enumerate(languages)}
    target = np.array([place[label] for label in labels])
    # every language weighs the same
    weight = 1.0 / np.bincount(target, minlength=len(languages))[target]
    weight *= len(weight) / weight.sum()

    features = len(WIDTHS) * FILTERS
    net = Network(languages, {w: rng.normal(0, 0.5, (w, CLASSES, FILTERS)) for w in WIDTHS},
                  np.zeros(features), rng.normal(0, 0.3, (features, len(languages))),
                  np.zeros(len(languages)))
    params = {**{f"f{w}": net.filters[w] for w in WIDTHS},
              "bias": net.bias, "weights": net.weights, "offset": net.offset}
    first = {k: np.zeros_like(v) for k, v in params.items()}
    second = {k: np.zeros_like(v) for k, v in params.items()}
    step = 0
    batches = max(1, len(windows) // 64)
    for _ in range(max(EPOCHS, -(-MIN_STEPS // batches))):
        order = rng.permutation(len(windows))
        for part in np.array_split(order, batches):
            step += 1
            grads = gradients(net, windows[part], target[part], weight[part])
            for name, value in params.items():
                grad = grads[name]
                first[name] = 0.9 * first[name] + 0.1 * grad
                second[name] = 0.999 * second[name] + 0.001 * grad * grad
                value -= 0.02 * (first[name] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[name] / (1 - 0.999 ** step)) + 1e-8)
    return net


def gradients(net: Network, windows: np.ndarray, target: np.ndarray, weight: np.ndarray) -> dict:
    pooled, places = net.responses(windows)
    error = net.probabilities(pooled)
    error[np.arange(len(target)), target] -= 1
    error *= weight[:, None] / len(target)
    active = np.maximum(pooled, 0)
    out = {"weights": active.T @ error, "offset": error.sum(0)}
    back = (error @ net.weights.T) * (pooled > 0)
    out["bias"] = back.sum(0)
    filters = np.arange(FILTERS)
    for i, width in enumerate(WIDTHS):
        own = back[:, i * FILTERS:(i + 1) * FILTERS]
        grad = np.zeros_like(net.filters[width])
        for j in range(width):
            seen = np.take_along_axis(windows, places[i] + j, 1)
            np.add.at(grad[j], (seen, np.broadcast_to(filters, seen.shape)), own)
        out[f"f{width}"] = grad
    return out


def held_out(id_col: str) -> Column:
    """Whether a row is kept from training: crc32 of the id as text, modulo 3, is 1."""
    text = quoted(id_col).cast("long").cast("string")
    return F.coalesce(F.crc32(text.cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang") -> Network | None:
    """Train on about SAMPLE_PER_LANGUAGE texts of each of at most MAX_LANGUAGES languages.

    Only rows that are not held out, with id, language and a text that is not empty, are eligible.
    Equal texts of a language are one, however many rows and ids they have. A text is in the sample
    if its hash falls below the share that its language needs, so no language has to come together
    anywhere, and a language of fewer texts gives them all. Windows are cut in the tasks: the driver
    gets at most WINDOWS_PER_DOCUMENT windows of each text, whatever its length.
    """
    rows = docs.filter(~held_out(id_col)).filter(quoted(id_col).cast("long").isNotNull()).select(
        quoted(text_col).cast("string").alias("text"), quoted(lang_col).alias("lang"),
        F.xxhash64(quoted(text_col).cast("string")).alias("h")).filter(
        "lang is not null and octet_length(text) > 0")
    counts = rows.select("lang", "h").distinct().groupBy("lang").count().orderBy(
        F.desc("count"), "lang").limit(MAX_LANGUAGES)
    share = counts.select("lang", (F.lit(SAMPLE_PER_LANGUAGE) / F.col("count")).alias("share"))
    place = F.pmod("h", F.lit(1 << 30)) / F.lit(1 << 30)
    sample = rows.join(F.broadcast(share), "lang").filter(place < F.col("share")).select(
        "lang", "h", training_windows(F.col("text")).alias("windows")).distinct().collect()
    sample = sorted((r["h"], r["lang"], [bytes(w) for w in r["windows"]]) for r in sample)
    return train([w for _, _, windows in sample for w in windows],
                 [lang for _, lang, windows in sample for _ in windows])


def predict(docs: DataFrame, network: Network | None, text_col: str = "text",
            lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """Append the predicted language and its probability (0 for ``und``).

    Every window of the whole text counts with its share of the bytes. A null text or one without a
    letter is ``und``; so is everything when nothing could be learned. Equal texts get equal results
    and every row is kept, repeated ones too.
    """
    ship_code(docs.sparkSession)
    has_letter = F.coalesce(quoted(text_col).rlike(r"\p{L}"), F.lit(False))
    kept = [c for c in docs.columns if c not in (lang_out, score_out)]
    source = docs.select(*[quoted(c) for c in kept], has_letter.alias(*fresh(kept, "_letter")))
    fields = source.schema.fields[:-1]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    where = kept.index(text_col)
    languages = np.array((network.languages if network else []) + [UNKNOWN], object)

    def run(stream):
        pooled = network.fast() if network else None
        for piece in B.text_slices(rename(stream, where)):
            letter = np.asarray(piece.rows.column(len(kept)).to_numpy(zero_copy_only=False), bool)
            best, score = classify(piece, letter, network, pooled)
            arrays = [*piece.rows.columns[:-1], pa.array(languages[best], pa.string()),
                      pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, lang_out, score_out])

    return source.mapInArrow(run, f"{ddl}, `{lang_out}` string, `{score_out}` double")


def rename(stream, where: int):
    """Call the text column ``text`` for the slicer, whatever its name."""
    for batch in stream:
        names = [f"c{i}" for i in range(batch.num_columns)]
        names[where] = "text"
        yield pa.RecordBatch.from_arrays(batch.columns, names=names)


BLOCK = 1024  # windows handled together


def classify(piece: B.Slice, letter: np.ndarray, network: Network | None, pooled):
    """Index of the best language and its averaged probability for each row of a slice."""
    count = len(letter)
    unknown = len(network.languages) if network else 0
    best, score = np.full(count, unknown), np.zeros(count)
    sizes = np.where(letter, piece.lengths, 0)
    if network is None or not sizes.sum():
        return best, score
    classes = TABLE[piece.data]
    per_row = -(-sizes // WINDOW)
    row = np.repeat(np.arange(count), per_row)
    start = piece.offsets[:-1][row] + B.ramp(per_row) * WINDOW
    end = piece.offsets[1:][row]
    # the last window of a longer text is moved back to be full
    full = np.maximum(piece.offsets[:-1][row], np.minimum(start, end - WINDOW))
    share = np.minimum(end - start, WINDOW).astype(float)
    total = np.zeros((count, unknown))
    for at in range(0, len(row), BLOCK):
        part = slice(at, at + BLOCK)
        chances = network.probabilities(pooled(windows_of(classes, full[part], end[part])))
        np.add.at(total, row[part], chances * share[part, None])
    known = sizes > 0
    total[known] /= sizes[known, None]
    best[known] = total[known].argmax(axis=1)
    score[known] = np.clip(total[known].max(axis=1), 0.0, 1.0)
    return best, score
