"""A corpus pipeline of five stages; each stage's rows are written and read again as the next one's documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.llm import langid, line_dedup, ngram_join, pack, suffix_dedup, toxicity
from tickweave.session import materialize


def _resized(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of the documents, the character count as the text now is."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the toxicity model does not reject; remainder 1 of 3 of the labels is never learnt."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.learn(docs, labels.where(langid.fold("doc_id", 3) != 1))
    return toxicity.score(docs, model).where(F.col("predicted") == 0).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that repeat earlier three-line windows."""
    return _resized(line_dedup.dedup_lines(docs), docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingle sets link at a Jaccard similarity of 0.8."""
    return ngram_join.keep_one(docs, k=5, num=80, den=100)


def cut_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the bytes under 50-byte strings that start in smaller documents."""
    return _resized(suffix_dedup.remove_repeats(docs), docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of 2,048 tokens."""
    return pack.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", drop_near_copies),
    ("suffix_dedup", cut_repeated_strings),
    ("packing", pack_sequences),
]

#: A learnt model and a tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline's rows over the whole documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline", name)
    return docs
