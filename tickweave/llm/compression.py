"""Quality classifier by compression.

Two zstandard dictionaries are trained, one on pieces of documents labelled good and one on pieces
of documents labelled bad. Every whole text is compressed in blocks with each of them; the
difference of the two sizes per byte of text says which kind it resembles. A logistic curve turns
it into a probability. The curve also sees the smaller size per byte, because a text that repeats
itself compresses well with any dictionary; its four numbers are fitted on labelled documents that
neither dictionary was trained on.

Defined cases: a null text counts as empty; an empty text has both sizes 0 and gets the curve's
value there; every row gets a row, repeated rows and null ids included; a document with several
labels is learned once with each distinct label; labels other than 0 and 1 teach nothing. Without
any label all scores are 0.5, with labels of one kind only that kind's share (0 or 1). Columns
other than id, text and label are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm import batches as B
from tickweave.llm.frames import arrow_schema, keyed_texts, materialize, quoted
from tickweave.llm.language_id import held_out

BLOCK = 1024             # bytes compressed at a time, so that dictionaries weigh the same anywhere
LEVEL = 3
DICTIONARY_BYTES = 112 << 10
PIECE = 256              # characters of a training piece, from a hashed place of the whole text
SAMPLE_PIECES = 16_384   # bound of the training pieces of each label, one a text, drawn by hash
SAMPLE_DOCUMENTS = 16_384  # bound of the documents of each label that fit the curve, drawn by hash
MEASURED = "_id long, _h long, doc_id long, n_bytes long, good_bytes long, bad_bytes long"


@dataclass
class Dictionaries:
    good: bytes
    bad: bytes

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        found = []
        for content in (self.good, self.bad):
            known = zstandard.ZstdCompressionDict(content, zstandard.DICT_TYPE_AUTO)
            known.precompute_compress(level=LEVEL)
            found.append(zstandard.ZstdCompressor(
                level=LEVEL, dict_data=known, write_checksum=False, write_content_size=False,
                write_dict_id=False))
        return found


def train_dictionary(pieces: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary; few or short pieces, on which training fails, are one as they are."""
    if sum(map(len, pieces)) > 2 * size:
        try:
            return zstandard.train_dictionary(size, pieces, k=1024, d=8).as_bytes()
        except zstandard.ZstdError:
            pass
    return b"\n".join(pieces)[-size:] or b"\n" * 8


def learned_labels(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """Distinct ``(_id, label)`` of the rows that may teach: not held out, label 0 or 1."""
    label = quoted(label_col).cast("int")
    return labels.filter(~held_out(id_col)).select(
        quoted(id_col).cast("long").alias("_id"), label.alias("label")).filter(
        "_id is not null and label in (0, 1)").distinct()


#: documents are dealt to the dictionaries or to the curve by their text, copies to the same side
FOR_CURVE = "pmod(shiftright(_h, 20), 2) = 1"


def training_pieces(docs: DataFrame, labels: DataFrame, everything: bool) -> dict[int, list[bytes]]:
    """At most SAMPLE_PIECES pieces of distinct texts of each label, cut in the executors."""
    room = F.greatest(F.char_length("text") - PIECE, F.lit(0)) + 1
    at = F.pmod(F.xxhash64("_h"), room).cast("int") + 1
    cut = docs.filter("_id is not null and length(text) > 0").select(
        "_id", "_h", F.substring("text", at, F.lit(PIECE)).alias("piece"))
    if not everything:
        cut = cut.filter(f"NOT ({FOR_CURVE})")
    known = cut.join(labels, "_id").dropDuplicates(["label", "_h"])
    out = {}
    for label in (0, 1):
        drawn = known.filter(F.col("label") == label).orderBy(F.xxhash64("_h"), "_h").limit(SAMPLE_PIECES)
        out[label] = [r["piece"].encode() for r in drawn.select("piece").collect()]
    return out


def fit_dictionaries(docs: DataFrame, labels: DataFrame) -> tuple[Dictionaries, bool] | None:
    """Dictionaries of keyed ``docs`` and learned ``labels``, and whether they saw all documents.

    Half of the documents is kept for the curve. Where that half leaves a label without pieces,
    all documents train both. ``None`` if a label has none even then.
    """
    for everything in (False, True):
        pieces = training_pieces(docs, labels, everything)
        if all(len(found) >= (1 if everything else 32) for found in pieces.values()):
            return Dictionaries(train_dictionary(pieces[1]), train_dictionary(pieces[0])), everything
    return None


def measure(docs: DataFrame, dictionaries: Dictionaries) -> DataFrame:
    """Sizes of every whole text of keyed ``docs`` under both dictionaries, in blocks of BLOCK bytes."""
    schema = arrow_schema(MEASURED)

    def run(stream):
        good, bad = dictionaries.compressors()
        for piece in B.text_slices(stream):
            sizes = np.zeros((2, len(piece.lengths)), np.int64)
            for row in range(len(piece.lengths)):
                low, high = int(piece.offsets[row]), int(piece.offsets[row + 1])
                for at in range(low, high, BLOCK):
                    block = piece.data[at:min(at + BLOCK, high)]
                    sizes[0, row] += len(good.compress(block))
                    sizes[1, row] += len(bad.compress(block))
            keys = [piece.rows.column(i) for i in range(3)]
            yield B.batch_of(schema, *keys, pa.array(piece.lengths), pa.array(sizes[0]), pa.array(sizes[1]))

    return docs.select("_id", "_h", "doc_id", "text").mapInArrow(run, MEASURED)


def features() -> list:
    """The normalised difference and the compressed share, as columns of a measured table."""
    size = F.greatest(F.col("n_bytes"), F.lit(1))
    return [((F.col("bad_bytes") - F.col("good_bytes")) / size).alias("difference"),
            (F.least("good_bytes", "bad_bytes") / size).alias("share")]


@dataclass
class Curve:
    """Probability of label 1: logistic in both features, clipped where labels were seen."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray   # per feature, and the constant

    def column(self, *inputs):
        total = F.lit(float(self.weights[-1]))
        for value, mid, width, weight in zip(inputs, self.centre, self.scale, self.weights):
            total = total + (value - F.lit(float(mid))) / F.lit(float(width)) * F.lit(float(weight))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.least(total, F.lit(500.0)), F.lit(-500.0))))


def fit_curve(values: np.ndarray, label: np.ndarray, weight: np.ndarray) -> Curve:
    """Weighted logistic regression by Newton steps with a slight ridge."""
    centre, scale = values.mean(0), values.std(0) + 1e-9
    inputs = np.c_[(values - centre) / scale, np.ones(len(values))]
    weight = weight / weight.mean()
    found = np.zeros(inputs.shape[1])
    ridge = np.diag([1e-2 * len(values) / 100, 1e-2 * len(values) / 100, 1e-6])
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(inputs @ found, -500, 500)))
        slope = inputs.T @ (weight * (chance - label)) + ridge @ found
        bend = (inputs * (weight * chance * (1 - chance))[:, None]).T @ inputs + ridge
        step = np.linalg.solve(bend + 1e-9 * np.eye(len(found)), slope)
        found -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return Curve(centre, scale, found)


def calibration_rows(measured: DataFrame, labels: DataFrame, everything: bool):
    """Features, labels and weights of at most SAMPLE_DOCUMENTS documents of each label.

    Copies of one text count once. A drawn document weighs as many as its label has for each drawn one.
    """
    rows = measured if everything else measured.filter(FOR_CURVE)
    known = rows.filter("_id is not null").join(labels, "_id").select(
        "_h", "label", *features()).dropDuplicates(["_h", "label"])
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    values, target, weight = [], [], []
    for label, count in sorted(counts.items()):
        drawn = known.filter(F.col("label") == label).orderBy(F.xxhash64("_h"), "_h").limit(
            SAMPLE_DOCUMENTS).select("difference", "share").collect()
        values += [[r["difference"], r["share"]] for r in drawn]
        target += [label] * len(drawn)
        weight += [count / len(drawn)] * len(drawn)
    return np.array(values, float).reshape(-1, 2), np.array(target, float), np.array(weight, float)


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality") -> DataFrame:
    """``doc_id, n_bytes, good_bytes, bad_bytes, score`` of every row of ``docs``.

    ``labels`` has ``id_col`` and ``label_col``; only its rows that are not held out are read. The
    samples behind both dictionaries and the curve are bounded by SAMPLE_PIECES and
    SAMPLE_DOCUMENTS, drawn by hashes of the texts over all labelled documents.
    """
    keyed = keyed_texts(docs, id_col, text_col).withColumn("_id", F.col("doc_id"))
    known = materialize(learned_labels(labels, id_col, label_col))
    fitted = fit_dictionaries(keyed, known)
    if fitted is None:
        seen = known.agg(F.avg("label").alias("share")).first()["share"]
        level = 0.5 if seen is None else float(seen)
        return keyed.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                            F.lit(0).cast("long").alias("good_bytes"), F.lit(0).cast("long").alias("bad_bytes"),
                            F.lit(level).alias("score"))
    dictionaries, everything = fitted
    measured = materialize(measure(keyed, dictionaries))
    values, target, weight = calibration_rows(measured, known, everything)
    if len(set(target)) < 2:
        values, target, weight = calibration_rows(measured, known, True)
    curve = fit_curve(values, target, weight)
    return measured.select("doc_id", "n_bytes", "good_bytes", "bad_bytes",
                           curve.column(*features()).alias("score"))
