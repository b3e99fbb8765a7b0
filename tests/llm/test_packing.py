"""Packing: every id once, sequences full, sources on target."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import TEXTS, documents
from tokenizers import Tokenizer

from tidemark.llm import forced_bpe
from tidemark.llm import mixture_packing as mix
from tidemark.llm.common import spaced_strips
from tidemark.llm.queries import QUERIES, WORD_BPE


def library_ids(texts):
    made = Tokenizer.from_file(WORD_BPE)
    made.no_truncation()
    made.no_padding()
    return [[*made.encode(x or "", add_special_tokens=False).ids, 2] for x in texts]


def check_places(pieces, length):
    """Sequences are gapless from 0 and all but one are full."""
    by_sequence = defaultdict(list)
    for p in pieces:
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    sizes = []
    for own in by_sequence.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at and n > 0
            at += n
        sizes.append(at)
    assert sorted(sizes)[1:] == [length] * (len(sizes) - 1)
    assert max(sizes) <= length


def test_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    pieces = QUERIES["op11_packing"](spark, small).collect()
    ids = dict(zip([d["doc_id"] for d in docs], library_ids([d["text"] for d in docs]), strict=True))
    seen = Counter()
    for p in pieces:
        own = ids[p["doc_id"]]
        part = own[p["start"] : p["start"] + p["length"]]
        assert p["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        assert len(part) == p["length"] and p["doc_tokens"] == len(own)
        seen.update((p["doc_id"], k) for k in range(p["start"], p["start"] + p["length"]))
    assert len(seen) == sum(map(len, ids.values())) and set(seen.values()) == {1}
    check_places(pieces, mix.LENGTH)


def test_sources_are_on_target_in_every_window(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    pieces = mix.pack(docs, WORD_BPE, 2, length=512, block=4, slack=16).collect()
    check_places(pieces, 512)
    total = Counter()
    for p in pieces:
        total[p["source"]] += p["length"]
    tokens = sum(total.values())
    taken, by_window = Counter(), defaultdict(Counter)
    for p in pieces:
        by_window[p["sequence_id"]][p["source"]] += p["length"]
    # what a source is ahead or behind after any window stays within a few settled documents
    for w in range(len(by_window)):
        taken.update(by_window[w])
        for source, n in total.items():
            aim = n * min(512 * (w + 1), tokens) / tokens
            assert abs(taken[source] - aim) < 64
    # each block is exactly on target
    blocks = len(by_window) // 4
    taken = Counter()
    for w in range(4 * (blocks - 1)):
        taken.update(by_window[w])
        if w % 4 == 3:
            for source, n in total.items():
                assert abs(taken[source] - n * 512 * (w + 1) / tokens) < 1


def test_weights(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    pieces = mix.pack(
        docs, WORD_BPE, 2, weights={"src0": 3, "src1": 1}, length=512, block=4, slack=0
    ).collect()
    check_places(pieces, 512)
    first = Counter()
    for p in pieces:
        if p["sequence_id"] < 8:
            first[p["source"]] += p["length"]
    assert abs(first["src0"] - 3 * first["src1"]) <= 8


@pytest.mark.parametrize("totals, weights", [([500, 20, 3000], [1, 1, 1]), ([700, 700, 3], [700, 700, 3]), ([90, 10], [1, 9])])
def test_mixture(totals, weights):
    made = mix.Mixture(totals, weights, 8, 4)
    last = [0] * len(totals)
    for x in range(0, sum(totals) + 1, 32):
        now = made.taken(x)
        assert sum(now) == x
        assert all(a <= b <= n for a, b, n in zip(last, now, totals, strict=True))
        last = now
    assert made.taken(sum(totals)) == totals
    for s, n in enumerate(totals):
        cut = [x for q in range(0, n, 7) for x in made.cut(s, q, min(7, n - q))]
        assert sum(x[2] for x in cut) == n
        sent = Counter()
        for block, _, size in cut:
            sent[block] += size
        for block, size in sent.items():
            assert size == made.known(block + 1)[s] - made.known(block)[s]


@pytest.mark.parametrize("slack", [0, 5, 40])
def test_fill(slack):
    rng = np.random.default_rng(3)
    row = 0
    queues = []
    for n in (4, 0, 60, 9):
        own = []
        for _ in range(n):
            own.append((row, 0, int(rng.integers(1, 60))))
            row += 1
        queues.append(own)
    sent = Counter()
    places = []
    for row, place, n, window, offset in mix.fill(queues, 64, slack):
        sent.update((row, k) for k in range(place, place + n))
        places.append({"sequence_id": window, "offset": offset, "length": n})
    assert len(sent) == sum(x[2] for q in queues for x in q) and set(sent.values()) == {1}
    check_places(places, 64)


def test_cases(spark):
    docs = documents(spark)
    pieces = mix.pack(docs, WORD_BPE, 2).collect()
    want = Counter()
    for (i, _, _, source), ids in zip(TEXTS, library_ids([t[1] for t in TEXTS]), strict=True):
        want[i, source] += len(ids)
    found = Counter()
    for p in pieces:
        found[p["doc_id"], p["source"]] += p["length"]
    assert found == want
    check_places(pieces, mix.LENGTH)
    assert mix.pack(documents(spark, []), WORD_BPE, 2).collect() == []
    nulls = mix.pack(documents(spark, [(None,) * 4] * 3), WORD_BPE, 2).collect()
    assert [p["length"] for p in nulls] == [1] * 3 and {p["sequence_id"] for p in nulls} == {0}


def test_many_small_sources_share_a_queue(spark):
    rows = [(i, f"some words of text {i}", "en", f"s{i}") for i in range(600)]
    rows += [(1000 + i, "words of the hot source " * 5, "en", "hot") for i in range(600)]
    pieces = mix.pack(documents(spark, rows), WORD_BPE, 2, length=128, block=8).collect()
    check_places(pieces, 128)
    hot, total = Counter(), Counter()
    for p in pieces:
        total[p["sequence_id"]] += p["length"]
        if p["source"] == "hot":
            hot[p["sequence_id"]] += p["length"]
    share = sum(hot.values()) / sum(total.values())
    assert all(abs(hot[w] - share * n) < 2 * mix.SLACK for w, n in total.items())


def test_padded_sequences(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    packed = mix.pack(docs, WORD_BPE, 2)
    made = mix.sequences(packed, pad_id=7).orderBy("sequence_id").collect()
    assert all(len(r["ids"]) == 4 * mix.LENGTH for r in made)
    last = np.frombuffer(made[-1]["ids"], "<u4")
    assert set(last[made[-1]["n_tokens"] :]) == {7}
    assert sum(r["n_tokens"] for r in made) == sum(r["length"] for r in packed.collect())


def test_strips():
    text = b"a bc  d\nee " + b"x" * 50 + b" tail of it"
    for limit in range(1, 30):
        own = list(spaced_strips(text, limit))
        assert b"".join(own) == text
        assert all(x.startswith(b" ") and x[1:2] != b" " for x in own[1:])
    assert list(spaced_strips(b"")) == []


def latin_texts():
    """Texts of all characters up to U+017F, rich in apostrophes and contractions."""
    rng = random.Random(11)
    pool = [chr(c) for c in range(0x180) if chr(c) != "<"]
    pool += [*"'stmdrevl" * 20, *" \n\t" * 5, *"Il0'" * 10]
    made = ["".join(rng.choices(pool, k=rng.randint(0, 60))) for _ in range(3000)]
    return [*made, "", "'", "''", "'s", "''s", "'l", "a'r", "5's", "\xa0'ves", "\u0130'S", "&'re&", "\xbd\xbd"]


def test_latin_words():
    texts = [x.lower() for x in latin_texts()]
    raw = mix.STOP.join([*(x.encode() for x in texts), b""])
    found = mix.latin_words(raw).to_pylist()
    want = [[*(w.encode() for w in forced_bpe.LATIN.findall(x)), mix.STOP] for x in texts]
    assert found == [w for own in want for w in own]


@pytest.mark.parametrize("limit", [1, 500, 1 << 20])
def test_word_ids(limit):
    texts = latin_texts()[::4]
    # other letters, special tokens and long texts in between
    texts[5:5] = ["a <|endoftext|> b", "<|no", "\u65e5\u672c it's", "\u201cdon\u2019t\u201d 'tis", "it's two words " * 90_000]
    found = mix.load(WORD_BPE)([x.encode() for x in texts], limit)
    want = library_ids(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [x[:-1] for x in want]


def test_words_of_many_texts_are_looked_up_once():
    made = mix.WordIds(WORD_BPE)
    asked = Counter()

    class Asked(dict):
        def __getitem__(self, word):
            asked[word] += 1
            return made._word(word)

    made.known = Asked()
    found = made([b"one two, Two three"] * 50)
    assert len(set(found)) == 1 and len(found[0]) == 4 * 5
    assert asked == dict.fromkeys([b"one", b"two", b",", b"three", mix.STOP], 1)
