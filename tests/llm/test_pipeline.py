"""The pipeline's stages on a small corpus, each against its operator's rule."""

import corpus_pipeline
from tests.llm.texts import words


def write_tables(spark, folder):
    import random
    from tests.llm.texts import prose
    rng = random.Random(8)
    own = {"en": "the of and ing tion wh", "de": "sch ung ü der keit ß"}
    rows = []
    for i in range(120):
        lang = "en" if i % 2 else "de"
        r = random.Random(i)
        text = " ".join("".join(r.choices(own[lang].split(), k=3)) for _ in range(80))
        rows.append((i, f"{text}\nthe same footer on each page", lang, "s", len(text)))
    passage = prose(rng, 30)
    rows += [(200, rows[3][1], "en", "s", 1), (201, rows[3][1] + " more", "en", "s", 1),
             (202, f"{passage} thetion", "en", None, None), (203, "12 !", "en", "s", 4),
             (204, None, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"
                          ).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet")
    return {r[0]: r[1] for r in rows}


def test_stages(spark, tmp_path):
    folder = str(tmp_path)
    texts = write_tables(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        path = f"{folder}/{len(seen)}"
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        seen.append({r["doc_id"]: r for r in docs.collect()})
    language, lines, near, clean, encoded = seen
    assert 203 not in language and 204 not in language and set(range(120)) <= set(language)
    footer = "the same footer on each page"
    # a copy keeps its text for the join; of the rest only the first page keeps the footer
    with_footer = {i for i, r in lines.items() if footer in (r["text"] or "")}
    assert with_footer == {0, 200, 201}
    assert len(near) == len(lines) - 2 and 200 not in near and 201 not in near
    assert 202 in near and 202 not in clean and len(clean) == len(near) - 1
    assert set(encoded) == set(clean)
    assert all(r["round_trip"] and r["n_ids"] == len(r["ids"]) for r in encoded.values())
    assert all(words(clean[i]["text"]) == words(texts[i].replace(footer, "")) for i in clean if i)
    assert corpus_pipeline.run(spark, folder).count() == len(encoded)


def test_clashing_columns_stay(spark):
    rows = [(1, "the same line of all\none with many words of its own", 77, "x"),
            (2, "the same line of all\nand two with words of its own too", 78, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines long, n_dropped string")
    got = corpus_pipeline.drop_lines(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect())) == [
        rows[0], (2, "and two with words of its own too", 78, "y")]
