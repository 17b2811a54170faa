"""A training-text pipeline: five stages from raw documents to piece ids.

Each stage takes ``(spark, docs, sf_dir)``, where ``docs`` is all that the stage before kept, and
returns a DataFrame; ``run`` writes each result as Parquet below ``spark.checkpoint.dir`` and reads
it again as the next stage's input. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.llm import language_id, line_templates, lsh_forest, pieces, winnowing
from tickweave.llm.frames import NO_ID, fresh, materialize, table

#: the least averaged probability of the predicted language that is accepted
MIN_LANGUAGE_SCORE = 0.5
#: a document that shares this part of its tokens with one before it is left to the join that follows
COPY_SHARE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter or without a clear language go."""
    network = language_id.fit(docs)
    lang, score = fresh(docs.columns, "_lang", "_score")
    predicted = language_id.predict(docs, network, lang_out=lang, score_out=score)
    clear = (F.col(lang) != language_id.UNKNOWN) & (F.col(score) >= MIN_LANGUAGE_SCORE)
    return predicted.filter(clear).drop(lang, score)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that recur across documents stay in the first of them only."""
    lines, dropped = fresh(docs.columns, "_lines", "_dropped")
    cleaned = line_templates.drop_recurring_lines(
        docs, leave_copies=COPY_SHARE, lines_out=lines, dropped_out=dropped)
    changed = F.col(dropped) > 0
    columns = [F.when(changed, F.length("text")).otherwise(F.col(c)).cast("long").alias(c)
               if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns]
    return cleaned.select(*columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar ones stays."""
    return lsh_forest.one_per_class(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth of their words inside benchmark windows go."""
    judged = winnowing.judged_rows(docs, table(spark, sf_dir, "benchmark"))
    key_id, key_h = fresh(docs.columns, "_id", "_h")
    bad = judged.filter("contaminated").select(
        F.col("_id").alias(key_id), F.col("_h").alias(key_h)).distinct()
    ident = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    return docs.join(bad, (ident == F.col(key_id)) & (
        F.xxhash64(F.col("text").cast("string")) == F.col(key_h)), "left_anti")


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text that is left, with the check that they decode to it."""
    return pieces.encode_documents(docs)


STAGES = [
    ("language ID", identify_language),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("SentencePiece encoding and decoding", encode_pieces),
]

#: the network, the search and the encoder have no SQL form; tests compare with plain models
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
