"""Alignment against a plain computation with both libraries."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from cases import LONG, TEXTS, documents, key
from tokenizers import Tokenizer

from tidemark.llm import token_alignment as ta
from tidemark.llm.plane_store import byte_letters
from tidemark.llm.queries import BYTE_BPE, PIECE_BPE, QUERIES


def plain(rows):
    """The contract's rows from (doc_id, text), byte by byte."""
    a_of = Tokenizer.from_file(BYTE_BPE)
    a_of.encode_special_tokens = True
    b_of = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    byte = {c: b for b, c in byte_letters().items()}

    def bytes_b(i):
        piece = b_of.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_of.is_byte(i) else piece.replace("▁", " ").encode()

    aligned = []
    for _, text in rows:
        whole = (" " + (text or "")).encode()
        a = a_of.encode(" " + (text or ""), add_special_tokens=False).ids
        b = b_of.encode(text or "", num_threads=1)
        own_a = [bytes(byte[c] for c in a_of.id_to_token(i)) for i in a]
        own_b = [bytes_b(i) for i in b]
        if not text or b"".join(own_a) != whole or b"".join(own_b) != whole:
            aligned.append(([], [], [], ""))
            continue
        at_a = [i for i, x in enumerate(own_a) for _ in x]
        at_b = [j for j, x in enumerate(own_b) for _ in x]
        links = list(dict.fromkeys(zip(at_a, at_b, strict=True)))
        groups, i, j = [], 0, 0
        for k in range(1, len(whole) + 1):
            end = k == len(whole)
            if end or (at_a[k] != at_a[k - 1] and at_b[k] != at_b[k - 1]):
                p, q = (len(a), len(b)) if end else (at_a[k], at_b[k])
                groups.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
                i, j = p, q
        aligned.append((a, b, [(a[i], b[j]) for i, j in links], ";".join(groups)))
    count = Counter(x for _, _, links, _ in aligned for x in set(links))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = []
    for (doc_id, _), (a, b, links, groups) in zip(rows, aligned, strict=True):
        best = sum(count[x] == most[x[0]] for x in links)
        digest = hashlib.sha256(groups.encode()).hexdigest() if a else ""
        n_groups = groups.count(";") + 1 if a else 0
        out.append((doc_id, len(a), len(b), n_groups, len(links), best, sum(count[x] for x in links), digest))
    return sorted(out, key=key)


def test_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    found = QUERIES["op12_alignment"](spark, small)
    assert sorted(map(tuple, found.collect()), key=key) == plain(rows)


ODD = [
    "special <|endoftext|> inside", "▁ already there", "  two  spaces and\ttabs\n\nlines ", " lead",
    "日本語のテキスト 🙂 é é ½ ﬁ", "\x00 nul \x01", "<0x41> <unk> <s> </s>", "a" * 300, "　wide space",
    "don't DON'T 12345 3.14 \r\n end", "it's", "it's", "...!!!", "﻿mark", "x​y",
]


@pytest.mark.parametrize("strip, batch", [(ta.STRIP, ta.BATCH), (8, 40)])
def test_odd_texts(spark, monkeypatch, strip, batch):
    """Whole and strip by strip, in one batch and in many."""
    monkeypatch.setattr(ta, "STRIP", strip)
    monkeypatch.setattr(ta, "BATCH", batch)
    rng = np.random.default_rng(6)
    words = ["the", "Text", "é", "ß", "12", "!", "\n", " ", "▁", "日", "can't", "<|endoftext|>", "\t"]
    texts = [*ODD, *("".join(str(w) + " " * int(rng.integers(3)) for w in rng.choice(words, 12)) for _ in range(60))]
    rows = [(k, t) for k, t in enumerate(texts)]
    docs = documents(spark, [(k, t, "en", "a") for k, t in rows])
    found = ta.align(docs, BYTE_BPE, PIECE_BPE).collect()
    assert sorted(map(tuple, found), key=key) == plain(rows)


def test_cases(spark):
    rows = [(t[0], t[1]) for t in TEXTS]
    found = ta.align(documents(spark), BYTE_BPE, PIECE_BPE).collect()
    assert sorted(map(tuple, found), key=key) == plain(rows)
    assert ta.align(documents(spark, []), BYTE_BPE, PIECE_BPE).collect() == []
    nulls = ta.align(documents(spark, [(None,) * 4] * 3), BYTE_BPE, PIECE_BPE).collect()
    assert [tuple(r) for r in nulls] == [(None, 0, 0, 0, 0, 0, 0, "")] * 3


def test_strips_change_nothing(monkeypatch):
    aligner = ta.load(BYTE_BPE, PIECE_BPE)
    assert aligner.cuttable
    want = aligner.align(LONG.encode())
    monkeypatch.setattr(ta, "STRIP", 1000)
    found = aligner.align(LONG.encode())
    assert (found.n_a, found.n_b, found.n_groups, found.groups) == (want.n_a, want.n_b, want.n_groups, want.groups)
    assert (found.pairs == want.pairs).all() and (found.times == want.times).all()


def test_each_distinct_text_is_aligned_once(spark, monkeypatch):
    rows = [(k, "a copy of one text", "en", "a") for k in range(500)] + [(900, "another", "en", "a")]
    docs = documents(spark, rows)
    plan = ta.align(docs, BYTE_BPE, PIECE_BPE)
    found = {r["doc_id"]: r for r in plan.collect()}
    assert len(found) == 501 and found[3]["count_sum"] == found[3]["n_links"] * 500
    texts = docs.groupBy("text").count().withColumnsRenamed({"count": "copies"})
    batches = ta.align_texts(
        texts.selectExpr("unhex(sha2(text, 256)) AS key", "cast(text AS binary) AS text", "copies"), BYTE_BPE, PIECE_BPE
    )
    assert sum(len(r["texts"]) for r in batches.collect()) == 2
