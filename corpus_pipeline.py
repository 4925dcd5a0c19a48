"""From raw documents to token ids: five stages over the whole corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintage.llm import decontaminate, lines, simhash, tokens, toxicity
from vintage.llm.common import cut, load

TOKENIZER = "byte_bpe_50k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not call toxic."""
    chain = toxicity.fit(docs, load(spark, sf_dir, "labels"))
    return toxicity.clean_documents(docs, chain)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later occurrences of three lines; n_chars follows. A document of which nothing is left goes."""
    left = lines.dedup_lines(docs)
    changed = F.col("n_removed") > 0
    emptied = changed & (F.trim(F.translate("text", "\n\t\r", "   ")) == "")
    return left.where(~emptied).select(*(F.when(changed, F.length("text")).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else c for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of three bits between SimHashes of three-word shingles connect."""
    return simhash.one_of_each(docs, words=3)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, verbatim or with other numbers and names."""
    return decontaminate.clean_documents(docs, load(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded texts."""
    import public_tokenizers

    coded = tokens.encode_decode(docs, public_tokenizers.path(TOKENIZER))
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("bpe", encode),
]

#: The classifier and the tokenizer are beyond SQL; tests hold the stages against their input, near duplicates against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet to the shared folder and read by the next."""
    docs = load(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
