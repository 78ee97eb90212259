"""A corpus pipeline over the table documents: language, quality, near copies, shared passages, packing."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from orderloom.llm import chunkdedup, langid, packing, simhash, weakrules
from orderloom.llm.common import release
from orderloom.session import configure, shared_folder

CAPACITY = 2048


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified (operator 2); it is learned from the documents' own lang."""
    return langid.keep_identified(docs)


def judge_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base filter and are probably good (operator 7)."""
    return weakrules.keep_good(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of smallest id, of each group of near copies (operator 4; five words, similarity 0.8)."""
    return simhash.one_of_each(docs, words=5, similarity=0.8)


def cut_shared_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that a document of smaller id has too (operator 1)."""
    release(spark)
    return chunkdedup.without_repeats(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2048 tokens (operator 6)."""
    release(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), CAPACITY, end_id=0)


STAGES = [
    ("language ID", identify_language),
    ("quality rules", judge_quality),
    ("SimHash near-dedup", drop_near_copies),
    ("substring dedup", cut_shared_passages),
    ("best-fit packing", pack_sequences),
]

# The stages are models, fingerprints and tokenizers, which SQL can't express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents; each one's rows are written as Parquet and read by the next."""
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex[:12]}"
    for number, (_, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        path = f"{folder}/{number}"
        made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
    return docs
