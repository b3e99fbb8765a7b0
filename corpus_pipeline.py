"""From raw documents to token ids: five stages, each one operator of ``tidemark.llm``.

Every stage takes what its predecessor kept, as written and read again, and returns the columns
of ``documents``; the last returns token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, forced_bpe, ppm_langid, simhash_vptree, suffix_dedup
from tidemark.llm.common import scratch, table
from tidemark.llm.queries import WORD_BPE
from tidemark.session import fresh_dir, remove


def tell_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose language cannot be told: without text or without letters."""
    return ppm_langid.known_language(docs, ppm_langid.fit(docs.where(ppm_langid.fold() != 1)))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates, the one of the smallest id."""
    return simhash_vptree.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts strings of 200 bytes that stand in more than one place."""
    return suffix_dedup.without_repeats(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids`` of what is left."""
    return forced_bpe.encode(docs, WORD_BPE)


STAGES = [
    ("language ID", tell_language),
    ("SimHash near-dedup", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("benchmark decontamination", drop_leaks),
    ("BPE encoding", encode),
]

#: SQL has neither the trees nor the tokenizer; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole pipeline over ``documents``; each stage is written as Parquet and read again.

    What a stage has staged is removed once it is written, what it has written once the next is.
    The last stage's folder stays: the result reads it.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = fresh_dir(spark, name.replace(" ", "-"))
        with scratch(spark):
            found = stage(spark, docs, sf_dir)
            found.write.parquet(path)
        docs = spark.read.schema(found.schema).parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
