"""The compression classifier: a plain model of its sizes, held-out accuracy, the awkward cases."""

import random
import zlib

import zstandard
from pyspark.sql import functions as F

from tests.llm.texts import frame, prose, wide
from tickweave.llm import compression, language_id
from tickweave.llm.frames import keyed_texts

LABELS = "doc_id long, quality int, toxic int"


def labelled(size=400, seed=1):
    """Prose is good; shouting and tables are bad."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(size):
        text = prose(rng, rng.randrange(5, 90))
        good = rng.random() < 0.6
        if not good:
            text = " ".join(w.upper() + "!!" for w in text.split()) if i % 2 else text.replace(" ", " | ")
        rows.append((i, text))
        labels.append((i, int(good), 0))
    return rows, labels


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_held_out_accuracy(spark):
    rows, labels = labelled()
    truth = {i: q for i, q, _ in labels}
    # held-out labels are turned round: nothing may learn from them
    shown = [(i, 1 - q if held(i) else q, 0) for i, q, _ in labels]
    got = compression.score_quality(frame(spark, rows), spark.createDataFrame(shown, LABELS)).collect()
    assert len(got) == len(rows)
    assert all(0 <= r["score"] <= 1 for r in got)
    right = [(r["score"] >= 0.5) == bool(truth[r["doc_id"]]) for r in got if held(r["doc_id"])]
    assert len(right) > 100 and sum(right) / len(right) > 0.95


def test_sizes_and_scores_against_a_plain_model(spark):
    rows, labels = labelled(150, 3)
    rows += [(900, None), (901, ""), (902, "long " * 40_000 + "END!!"), (None, "no id"), rows[0], rows[0]]
    labels += [(0, 1 - labels[0][1], 0), (1, 7, 0), (2, None, 0), (None, 1, 0)]
    docs, marks = frame(spark, rows), spark.createDataFrame(labels, LABELS)
    keyed = keyed_texts(docs, "doc_id", "text").withColumn("_id", F.col("doc_id"))
    known = compression.learned_labels(marks)
    assert known.filter("_id = 0").count() == (0 if held(0) else 2)
    dictionaries, everything = compression.fit_dictionaries(keyed, known)
    measured = compression.measure(keyed, dictionaries)
    values, target, weight = compression.calibration_rows(measured, known, everything)
    curve = compression.fit_curve(values, target, weight)

    def plain(text):
        data, sizes = (text or "").encode(), []
        for content in (dictionaries.good, dictionaries.bad):
            tool = zstandard.ZstdCompressor(
                level=compression.LEVEL, dict_data=zstandard.ZstdCompressionDict(content),
                write_checksum=False, write_content_size=False, write_dict_id=False)
            sizes.append(sum(len(tool.compress(data[at:at + compression.BLOCK]))
                             for at in range(0, len(data), compression.BLOCK)))
        return len(data), *sizes

    expected = sorted((-1 if i is None else i, *plain(text)) for i, text in rows)
    got = compression.score_quality(docs, marks).collect()
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_bytes"], r["good_bytes"],
                   r["bad_bytes"]) for r in got) == expected
    for r in got:
        size = max(1, r["n_bytes"])
        inputs = [(r["bad_bytes"] - r["good_bytes"]) / size, min(r["good_bytes"], r["bad_bytes"]) / size]
        total = sum((x - m) / s * w for x, m, s, w in zip(inputs, curve.centre, curve.scale, curve.weights))
        assert abs(r["score"] - 1 / (1 + 2.718281828459045 ** -(total + curve.weights[-1]))) < 1e-9


def test_weights_restore_the_share_of_each_label(spark, monkeypatch):
    rows, labels = labelled(300, 5)
    keyed = keyed_texts(frame(spark, rows), "doc_id", "text").withColumn("_id", F.col("doc_id"))
    known = compression.learned_labels(spark.createDataFrame(labels, LABELS))
    dictionaries, everything = compression.fit_dictionaries(keyed, known)
    measured = compression.measure(keyed, dictionaries)
    _, target, _ = compression.calibration_rows(measured, known, everything)
    monkeypatch.setattr(compression, "SAMPLE_DOCUMENTS", 10)
    _, drawn, weight = compression.calibration_rows(measured, known, everything)
    assert len(drawn) == 20
    assert abs(weight[drawn == 1].sum() - (target == 1).sum()) < 1e-9
    assert abs(weight[drawn == 0].sum() - (target == 0).sum()) < 1e-9


def test_little_or_nothing_to_learn(spark):
    rows, labels = labelled(30, 4)
    docs = frame(spark, rows)

    def scores(marks, texts=docs):
        return [r["score"] for r in compression.score_quality(texts, spark.createDataFrame(marks, LABELS)).collect()]

    assert set(scores([])) == {0.5}
    assert set(scores([(i, 1, 0) for i, _, _ in labels])) == {1.0}
    assert set(scores([(i, 0, 0) for i, _, _ in labels])) == {0.0}
    assert scores(labels, frame(spark, [])) == []
    assert len(scores(labels)) == 30


def test_clashing_columns_and_copies(spark):
    rows, labels = labelled(120, 6)
    marks = spark.createDataFrame(labels, LABELS)
    plain = compression.score_quality(frame(spark, rows), marks).collect()
    assert sorted(compression.score_quality(wide(spark, rows), marks).collect()) == sorted(plain)
    # a thousand copies of one labelled text weigh as much as one
    copies = rows + [(5000 + i, rows[0][1]) for i in range(1000)]
    more = marks.union(spark.createDataFrame([(5000 + i, labels[0][1], 0) for i in range(1000)], LABELS))
    again = {r["doc_id"]: r["score"] for r in compression.score_quality(frame(spark, copies), more).collect()}
    one = {r["doc_id"]: r["score"] for r in plain}
    if not held(0):
        assert max(abs(again[i] - one[i]) for i in one) < 1e-9
    assert len(again) == 1120


def test_query(spark):
    from tickweave.llm import queries
    got = queries.op13_quality_classifier(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert got.count() == docs.count()
    assert language_id.held_out  # the fold is shared with language ID
