"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
from cases import TEXTS, documents, key

import corpus_pipeline
from tidemark.llm import (
    decontaminate,
    forced_bpe,
    host_rules,
    plane_store,
    ppm_langid,
    simhash_vptree,
    suffix_dedup,
    weak_quality,
)
from tidemark.llm.queries import BYTE_BPE, QUERIES
from tidemark.session import fresh_dir

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def planes(docs):
    folder = fresh_dir(docs.sparkSession, "planes")
    plane_store.write(docs, folder, BYTE_BPE, block=500)
    return plane_store.digests(docs.sparkSession, folder)


PER_ROW = {
    "planes": planes,
    "repeats": suffix_dedup.remove_repeats,
    "rules": host_rules.judge,
    "round trip": lambda d: forced_bpe.round_trip(d, WORD_BPE),
    "encode": lambda d: forced_bpe.encode(d, WORD_BPE),
    "weak": weak_quality.classify,
    "near": simhash_vptree.near_duplicates,
    "language": lambda d: ppm_langid.predict(d, ppm_langid.fit(d)),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_a_row_for_every_row(spark, name):
    assert PER_ROW[name](documents(spark)).count() == len(TEXTS)


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_table(spark, name):
    assert PER_ROW[name](documents(spark, [])).collect() == []


@pytest.mark.parametrize("name", PER_ROW)
def test_all_null(spark, name):
    assert PER_ROW[name](documents(spark, [(None,) * 4] * 3)).count() == 3


def test_leaks_of_the_cases(spark):
    items = spark.createDataFrame(
        [(1, "no id here é"), (2, None), (3, ""), (None, "one"), (4, "nowhere to be found at all")],
        "item_id long, text string",
    )
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(documents(spark), items).collect()}
    assert found == {(None, 1), (4, None), (6, None), (8, None)}
    assert decontaminate.leaks(documents(spark, []), items).collect() == []
    assert decontaminate.leaks(documents(spark), items.limit(0)).collect() == []


def test_stages_keep_columns_and_take_the_cases(spark, small):
    for rows in (None, []):
        docs = documents(spark, rows)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            found = stage(spark, docs, small)
            assert found.columns == docs.columns, name
            found.collect()


def test_every_operator_has_its_query():
    numbers = sorted(int(x[2:].split("_")[0]) for x in QUERIES)
    assert numbers == list(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5


def test_one_row_of_each_group_stays(spark):
    """Null ids and ids that several texts share do not take groups from each other."""
    rng = np.random.default_rng(9)
    own = [" ".join(f"w{x}" for x in rng.integers(0, 5000, 60)) for _ in range(6)]
    rows = [
        (5, own[0]), (5, own[1]), (5, own[1]),
        (None, own[2]), (None, own[3]), (None, own[4]), (None, own[4]), (None, own[5]),
        (7, own[5]), (3, own[5]), (None, None), (1, ""), (None, " "),
    ]
    docs = documents(spark, [(i, t, "en", "a") for i, t in rows])
    found = simhash_vptree.keep_one(docs)
    assert found.schema == docs.schema
    kept = sorted(((r["doc_id"], r["text"]) for r in found.collect()), key=key)
    want = [(5, own[0]), (5, own[1]), *((None, x) for x in own[2:5]), (3, own[5]), (1, "")]
    assert kept == sorted(want, key=key)


@pytest.mark.parametrize("lang", ["en", None])
def test_letterless_texts_go_with_or_without_labels(spark, lang):
    rows = [(i, t, lang, "a") for i, t in enumerate([None, "", " \n", "12 ½ $", "a word", "é"])]
    docs = documents(spark, rows)
    found = ppm_langid.known_language(docs, ppm_langid.fit(docs))
    assert found.schema == docs.schema
    assert sorted(r["doc_id"] for r in found.collect()) == [4, 5]


@pytest.mark.parametrize("copies", [200, 10_000])
def test_no_language_is_lost_to_copies(spark, copies):
    """Four languages with two texts each, in thousands of rows without ids."""
    texts = {f"L{k}": [chr(97 + 5 * k) * 4 + " " + chr(99 + 5 * k) * 7, chr(98 + 5 * k) * 9] for k in range(4)}
    rows = [(None, texts[lang][k % 2], lang, "a") for lang in texts for k in range(copies)]
    docs = documents(spark, rows)
    sample = ppm_langid.bounded_sample(docs.select("doc_id", "text", "lang"), 2_000, "doc_id", "lang")
    assert sorted((r["lang"], r["text"]) for r in sample.collect()) == sorted(
        (lang, t) for lang, own in texts.items() for t in own
    )
    trees = ppm_langid.fit(docs)
    assert trees.langs == sorted(texts)
    found = ppm_langid.predict(docs.limit(1), trees).collect()
    assert found[0]["lang_pred"] in texts


def test_the_sample_is_bounded_on_both_sides(spark):
    rows = [(k, f"text {k}", "en", "a") for k in range(900)] + [(k, f"texte {k}", "fr", "a") for k in range(5)]
    docs = documents(spark, rows).select("doc_id", "text", "lang")
    found = ppm_langid.bounded_sample(docs, 100, "doc_id", "lang").groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in found} == {"en": 100, "fr": 5}
