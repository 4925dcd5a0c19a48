"""Queries that apply each operator to its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintage.llm import conversations, decontaminate, jaccard, language, lines, negatives, neighbours, pages, quality, simhash, suffixes, tokens, toxicity
from vintage.llm.common import load


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    trees = language.fit(docs.where(~language.held_out()))
    return language.predict(docs, trees).select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(load(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, load(spark, sf_dir, "labels")))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    coded = tokens.encode_decode(load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce(F.array_size(F.split("text", "\n", -1)), F.lit(0)).alias("n_lines"))
    return lines.dedup_lines(docs).select(
        "doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.col("n_removed").cast("long").alias("n_removed"), F.sha2("text", 256).alias("kept_sha256")
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return toxicity.predict(docs, toxicity.fit(docs, load(spark, sf_dir, "labels")))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = suffixes.remove_repeats(load(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = load(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 20 = 0"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = load(spark, sf_dir, "pages")
    return pages.extract(table, pages.fit(table))


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(load(spark, sf_dir, "documents"), words=4, percent=85)


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.conversation_tree(load(spark, sf_dir, "conversations"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = load(spark, sf_dir, "embeddings").withColumn("label", label)
    return negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


QUERIES = {
    "op1_language": op1_language,
    "op2_simhash": op2_simhash,
    "op3_quality": op3_quality,
    "op4_decontaminate": op4_decontaminate,
    "op5_bpe": op5_bpe,
    "op6_line_dedup": op6_line_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_neighbours": op9_neighbours,
    "op10_html": op10_html,
    "op11_ngram_join": op11_ngram_join,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES: dict[str, str] = {
    "op6_line_dedup": lines.ORACLE,
    "op11_ngram_join": jaccard.ORACLE,
    "op12_conversation_trie": conversations.ORACLE,
    "op13_hard_negatives": negatives.ORACLE,
}
