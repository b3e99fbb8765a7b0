"""One query for each operator over its whole table, and the pipeline."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    conversation_repair,
    decontaminate,
    forced_bpe,
    host_rules,
    mixture_packing,
    plane_store,
    ppm_langid,
    preference,
    simhash_vptree,
    suffix_dedup,
    token_alignment,
    warc,
    weak_quality,
)
from tidemark.llm.common import scratch_dir, table

Query = Callable[[SparkSession, str], DataFrame]
#: The vocabularies; the files must be readable on every executor.
BYTE_BPE = os.environ.get("TIDEMARK_BYTE_BPE", public_tokenizers.path("byte_bpe_50k.json"))
PIECE_BPE = os.environ.get("TIDEMARK_PIECE_BPE", public_tokenizers.path("piece_bpe_32k.model"))
WORD_BPE = os.environ.get("TIDEMARK_WORD_BPE", public_tokenizers.path("word_bpe_49k.json"))


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each benchmark item that a document leaks."""
    return decontaminate.leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op2_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, size and checksum of each document's ids, from a store written and read back."""
    folder = scratch_dir(spark, "token-planes")
    plane_store.write(table(spark, sf_dir, "documents"), folder, BYTE_BPE)
    return plane_store.digests(spark, folder)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without repeated 200-byte strings."""
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op4_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of each document; its source is its host."""
    return host_rules.judge(table(spark, sf_dir, "documents")).drop("host_rate")


def op5_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each answered conversation against the same with its partner's last answer."""
    own = preference.conversations(table(spark, sf_dir, "conversations"))
    found = preference.format_pairs(preference.partner_pairs(own))
    return found.select(
        "pair_id",
        "n_common",
        "prompt",
        "chosen",
        "rejected",
        preference.mask_text("chosen_mask"),
        preference.mask_text("rejected_mask"),
    )


def op6_forced_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of each document."""
    return forced_bpe.round_trip(table(spark, sf_dir, "documents"), WORD_BPE)


def op7_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weak label, score and verdict of each document."""
    return weak_quality.classify(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifiers and digests of the records derived from each page's response record."""
    found = warc.derivatives(warc.responses(table(spark, sf_dir, "pages")))
    return found.drop("metadata_record", "conversion_record")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of each document."""
    found = simhash_vptree.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", simhash_vptree.hexadecimal().alias("fingerprint"), "component_id"
    )


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of each document; a third of them is held out of the learning."""
    docs = table(spark, sf_dir, "documents")
    held_out = ppm_langid.fold() == 1
    trees = ppm_langid.fit(docs.where(~held_out))
    found = ppm_langid.predict(docs, trees)
    return found.select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "bits_per_byte"
    )


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place and checksum of each piece of a document in sequences of 4096 tokens."""
    found = mixture_packing.pack(table(spark, sf_dir, "documents"), WORD_BPE, end_id=2)
    return found.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agreement of two tokenizers on each document, weighed by corpus-wide pair counts."""
    return token_alignment.align(table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_BPE)


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired digest of each damaged conversation."""
    report, _ = conversation_repair.repair(table(spark, sf_dir, "conversations"), damaged=True)
    return report


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_decontaminate,
        op2_planes,
        op3_suffix_dedup,
        op4_host_rules,
        op5_preference,
        op6_forced_bpe,
        op7_weak_quality,
        op8_warc,
        op9_simhash,
        op10_language,
        op11_packing,
        op12_alignment,
        op13_repair,
    )
}
ORACLE: dict[str, str] = {
    "op3_suffix_dedup": suffix_dedup.ORACLE,
    "op4_host_rules": host_rules.ORACLE,
    "op5_preference": preference.ORACLE,
}
