"""Corpus cleaning pipeline over ``documents``.

``STAGES`` are (name, function) pairs; each function takes (spark, docs,
sf_dir) and returns a DataFrame. ``run`` applies them in order: each stage's
rows are written as Parquet into the cluster's shared folder and read again as
the next stage's documents. Texts go to Python workers once a stage, in Arrow
batches of bounded bytes.

Defined results of every stage: an empty table gives an empty table; rows of
equal id, and repeated rows, are documents of their own (the n-gram join keeps
one of equal texts); nulls in columns other than ``text`` are kept as they are.
A null or empty text scores like any text without known words, has no near
copies, no repeated passage and no benchmark item, and has no tokens; a null
id stays, and comes last where the least id is kept.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from procura.llm import byte_bpe, decontamination, ngram_join, substring_dedup, toxicity
from procura.llm.common import bounded_batches, read_table, stored
from procura.llm.queries import RANKS, TOXIC, toxicity_model

#: Near duplicates of the pipeline: words of a shingle, least Jaccard similarity in per cent.
SHINGLE, PERCENT = 5, 80


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    bounded_batches(spark)
    scored = toxicity.score(docs, "text", toxicity_model(spark, docs, sf_dir))
    return scored.where(F.col("score") < TOXIC).select(docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of least id, of every class of near duplicates."""
    bounded_batches(spark)
    return ngram_join.one_of_each(docs, "doc_id", "text", SHINGLE, PERCENT)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the sentences that another document has first."""
    bounded_batches(spark)
    cleaned = substring_dedup.remove_repeats(docs, "doc_id", "text")
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    bounded_batches(spark)
    return decontamination.decontaminate(docs, "text", read_table(spark, sf_dir, "benchmark"), "item_id", "text")


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed token ids of every document, and digests of them and of what they decode to."""
    bounded_batches(spark)
    coded = byte_bpe.encode_decode(docs, "text", public_tokenizers.path(RANKS), public_tokenizers.PATTERN, ["doc_id", "lang", "source"])
    return coded.select("doc_id", "lang", "source", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("ngram_join", without_near_copies),
    ("substring_dedup", without_repeated_passages),
    ("decontamination", without_benchmark),
    ("byte_bpe", tokenized),
]

#: Hash and similarity stages on whole texts have no SQL form; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
