"""The registered query of each operator, over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.llm import (
    compression, curves, language_id, line_templates, lm_scoring, lsh_forest, pieces, prefix_trie, secrets,
    spelling, suffixes, superkmers, winnowing,
)
from tickweave.llm.frames import table
from tickweave.llm.oracles import ORACLES


def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, folder, "documents"), digest=True)


def op3_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return lsh_forest.jaccard_join(table(spark, folder, "documents"))


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return superkmers.remove_repeats(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.score_documents(
        table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_templates.drop_recurring_lines(docs)


def op6_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    asked = vectors.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"))
    return curves.nearest_neighbours(vectors, asked)


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = winnowing.contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    base = secrets.KINDS[:3]
    found = secrets.find_secrets(table(spark, folder, "documents"))
    return found.select(
        "doc_id", *[secrets.count_of("spans", k).alias(f"n_{k}") for k in base],
        F.sha2(secrets.spans_text("spans", base), 256).alias("base_sha256"),
        secrets.spans_text("spans").alias("spans"))


def op9_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encode_documents(table(spark, folder, "documents"))


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    network = language_id.fit(docs)
    return language_id.predict(docs.select("doc_id", "text"), network).select(
        "doc_id", language_id.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, folder, "documents"))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, folder, "conversations"))


def op13_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    found = compression.score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.select(
        "doc_id", language_id.held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, folder)


QUERIES = {
    "pipeline": pipeline,
    "op1_secret_scan": op1_secret_scan,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_line_dedup": op5_line_dedup,
    "op6_nearest_neighbours": op6_nearest_neighbours,
    "op7_decontamination": op7_decontamination,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_language_id": op10_language_id,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_quality_classifier": op13_quality_classifier,
}

def all_queries() -> dict:
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    return dict(ORACLES)
