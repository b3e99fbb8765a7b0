"""Work that is divided into bounded pieces gives the same results."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from tidemark.llm import decontaminate, ppm_langid, simhash_vptree, suffix_dedup


def test_strips_count_and_code_alike(monkeypatch):
    rng = np.random.default_rng(4)
    texts = [bytes(rng.integers(97, 103, n).astype(np.uint8)) for n in (0, 1, 3, 40, 700, 2)]

    def counted():
        out = Counter()
        for size, grams, n in ppm_langid.count_grams(texts, 3):
            out.update({(size, g): k for g, k in zip(grams.tolist(), n.tolist(), strict=True)})
        return out

    whole = counted()
    trees = ppm_langid.grow([("a", *k, n) for k, n in whole.items()])
    lengths = ppm_langid.code_lengths(texts, trees)
    monkeypatch.setattr(ppm_langid, "STEP", 16)
    assert counted() == whole
    assert whole == Counter(
        (size, int.from_bytes(t[k : k + size], "big"))
        for t in texts for size in range(1, 5) for k in range(len(t) - size + 1)
    )
    assert (ppm_langid.code_lengths(texts, trees) == lengths).all()


def test_many_languages_take_what_they_know(monkeypatch):
    """Tables grow with the known (string, language) pairs, not with strings times languages."""
    import pickle

    rng = np.random.default_rng(18)

    def held(n):
        rows = []
        for k in range(n):  # two bytes of its own for each language
            text = bytes(rng.integers(2 * (k % 100), 2 * (k % 100) + 2, 400).astype(np.uint8))
            for size, grams, counts in ppm_langid.count_grams([text], 3):
                rows += [(f"l{k:03}", size, *x) for x in zip(grams.tolist(), counts.tolist(), strict=True)]
        return ppm_langid.grow(rows), len(rows)

    (few, few_pairs), (many, many_pairs) = held(10), held(100)
    bytes_a_pair = [len(pickle.dumps(x)) / n for x, n in ((few, few_pairs), (many, many_pairs))]
    assert bytes_a_pair[1] < 1.2 * bytes_a_pair[0]
    texts = [bytes(rng.integers(2 * k, 2 * k + 2, 300).astype(np.uint8)) for k in (0, 5, 99)] + [b""]
    lengths = ppm_langid.code_lengths(texts, many)
    assert lengths[:3].argmin(axis=1).tolist() == [0, 5, 99]
    monkeypatch.setattr(ppm_langid, "STEP", 7)
    assert (ppm_langid.code_lengths(texts, many) == lengths).all()


def test_windows_in_ranges(monkeypatch):
    own = [f"w{k}" for k in range(60)]
    text = " ".join(["x"] * 40 + own * 3 + ["y"] * 40).encode()
    finder = decontaminate.Finder(decontaminate.prepare([(1, " ".join(own)), (2, " ".join(own[:20]))]))
    whole = list(finder.find(text))
    monkeypatch.setattr(decontaminate, "WINDOWS", 7)
    assert list(finder.find(text)) == whole and len(whole) == 2


def test_copies_of_an_item_are_one(spark):
    item = " ".join(f"w{k}" for k in range(30))
    items = spark.createDataFrame([(1, item)] * 5 + [(2, item)], "item_id long, text string")
    docs = spark.createDataFrame([(7, f"so {item} it is")], "doc_id long, text string")
    found = decontaminate.leaks(docs, items).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(7, 1), (7, 2)]


def test_ranges_are_merged(spark):
    rng = np.random.default_rng(6)
    rows = [(int(r), int(a), int(a + n)) for r, a, n in zip(*(rng.integers(1, m, 400) for m in (9, 2000, 60)), strict=True)]
    found = suffix_dedup.merged(spark.createDataFrame(rows, "rid long, lo int, hi int")).collect()
    own = {r["rid"]: sorted((x["lo"], x["hi"]) for x in r["ranges"]) for r in found}
    for rid in {r for r, _, _ in rows}:
        places = {k for r, a, b in rows if r == rid for k in range(a, b)}
        assert {k for a, b in own[rid] for k in range(a, b)} == places
        assert all(b < a for (_, b), (a, _) in zip(own[rid], own[rid][1:], strict=False))


def test_copies_within_a_text_are_combined():
    """Every context is either kept or covered by the runs, and only copies are covered."""
    rng = np.random.default_rng(8)
    texts = [b"ab " * 400, bytes(rng.integers(97, 100, 900).astype(np.uint8)) * 2, b"x" * 500, b"short"]
    texts.append(bytes(rng.integers(97, 120, 1500).astype(np.uint8)))
    own, h, lo, hi = suffix_dedup.contexts(texts, 200)
    c = np.array([hash(texts[k][a : b + 200]) for k, a, b in zip(own.tolist(), lo.tolist(), hi.tolist(), strict=True)])
    at, n, runs = suffix_dedup.combine_copies(own, h, c, lo, hi, 200)
    seen = Counter(zip(own.tolist(), h.tolist(), c.tolist(), strict=True))
    assert {(int(own[k]), int(h[k]), int(c[k])): int(m) for k, m in zip(at, n, strict=True)} == seen
    rest = sorted(set(range(len(own))) - set(at.tolist()))
    want = {(int(own[k]), p) for k in rest for p in range(lo[k], hi[k] + 200)}
    assert {(k, p) for k, a, b in zip(*(x.tolist() for x in runs), strict=True) for p in range(a, b + 200)} == want
    assert len(at) < 40 and len(rest) > 500
    empty = np.zeros(0, np.int64)
    assert all(len(x) == 0 for x in suffix_dedup.combine_copies(*(empty,) * 5, 200)[:2])


def lookups(item, text):
    """Leaks of one item in a text."""
    return list(decontaminate.Finder(decontaminate.prepare([(1, " ".join(item))])).find(" ".join(text).encode()))


def test_least_similar_leaks_are_found():
    """Items cut at an end, altered, or with parts moved, to a similarity of just 0.8."""
    rng = np.random.default_rng(11)
    far = []
    for trial in range(400):
        n = int(rng.integers(22, 120))
        own = [f"w{x}" for x in rng.integers(0, 3000, n)]
        spare = n - 4 - decontaminate.least_shared(n, n, 5, 0.8)  # shingles that may be lost
        filler = [f"f{x}" for x in rng.integers(0, 3000, 100)]
        texts = [own[spare:], own[: n - spare]]  # the window shifted by the words cut off is the best
        if spare >= 4:
            at = int(rng.integers(4, n - 4))
            texts.append(own[at:] + own[:at])  # four shingles at the seam
        if spare >= 5:
            altered = list(own)
            for k in rng.choice(np.arange(4, n - 4, 5), spare // 5, replace=False).tolist():
                altered[k] = f"changed{k}"
            texts.append(altered)
        for kept in texts:
            found = lookups(own, filler[:50] + kept + filler[50:])
            assert len(found) == 1 and found[0][4] >= 0.8, (trial, n)
            far.append(found[0][3])
    assert max(far) > decontaminate.BITS // decontaminate.block_bits_for(0.8) and len(far) > 1200


def test_fingerprints_tell_items_apart():
    """The index proposes few of the items that a window is not like, the radius none."""
    rng = np.random.default_rng(14)
    made = [[f"w{x}" for x in rng.integers(0, 300, 40)] for _ in range(400)]
    items = decontaminate.prepare([(k, " ".join(x)) for k, x in enumerate(made)])
    radius, width = decontaminate.radius_for(0.8), decontaminate.block_bits_for(0.8)
    index = decontaminate.MultiIndex(items.fps, radius, width)
    assert sorted((w, k) for w, k, _ in index.within(items.fps)) == [(k, k) for k in range(400)]
    values = index.values(items.fps)
    shared = [int((values[k + 1 :] == values[k]).any(axis=1).sum()) for k in range(400)]
    assert sum(shared) < 0.04 * 400 * 399 / 2


def test_index_is_certain_below_its_blocks():
    """Every pair that differs in fewer bits than there are blocks, and no pair beyond the radius."""
    rng = np.random.default_rng(15)
    fps = rng.integers(0, 1 << 63, (300, decontaminate.BITS // 64)).astype("<u8")
    blocks = decontaminate.BITS // 12
    for radius, k in ((blocks - 1, blocks - 1), (blocks - 1, 1), (3, 3), (2, 3)):
        moved = np.unpackbits(fps.view(np.uint8), axis=1, bitorder="little")
        for row in moved:
            row[rng.choice(decontaminate.BITS, k, replace=False)] ^= 1
        moved = np.packbits(moved, axis=1, bitorder="little").view("<u8")
        found = list(decontaminate.MultiIndex(fps, radius, 12).within(moved))
        assert sorted(found) == ([(x, x, k) for x in range(300)] if k <= radius else [])


def test_windows_that_turn_are_fingerprints():
    rng = np.random.default_rng(16)
    for top in (3, 1000):
        keys = rng.integers(0, top, 90).astype(np.uint64)
        for width in (1, 7, 90):
            found = decontaminate.window_fingerprints(keys, width)
            want = [decontaminate.fingerprint(keys[k : k + width]) for k in range(91 - width)]
            assert (found == np.array(want)).all()


def test_chance_of_a_bit_is_bounded():
    """Exactly, for windows of any number of shingles that are just alike."""
    from math import comb

    def sums(n):
        return [(2 * k - n, comb(n, k) / 2**n) for k in range(n + 1)]

    for similarity in (0.5, 0.8, 0.95):
        for n in range(1, 70):
            shared = decontaminate.least_shared(n + 4, n + 4, 5, similarity)
            over = [(p, sum(q for b, q in sums(n - shared) if a + b > 0)) for a, p in sums(shared)]
            assert sum(2 * p * up * (1 - up) for p, up in over) <= decontaminate.bit_chance(similarity) + 1e-9


def test_repeated_items_and_texts():
    """Lines repeated in items and texts count as often as they stand there."""
    line = [f"w{k}" for k in range(12)]
    assert [x[0] for x in lookups(line * 5, line * 40)] == [1]
    assert lookups(line * 5, line * 3) == []
    assert lookups(line, ["x"] * 9 + line * 3)[0][1:] == (9, 12, 0, 1.0)


def test_blocks_of_items_find_alike(spark, monkeypatch):
    """Many blocks give the leaks of one, and take as many Python stages side by side, none chained."""
    rng = np.random.default_rng(17)
    made = [" ".join(f"w{x}" for x in rng.integers(0, 500, 30)) for _ in range(40)]
    items = spark.createDataFrame(list(enumerate(made)), "item_id long, text string")
    rows = [(k if k % 5 else None, f"so {made[k]} it is" if k % 2 else "nothing of it", k) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, at long")
    whole = sorted(map(str, decontaminate.leaks(docs, items).collect()))
    kept = sorted(map(str, decontaminate.without_leaks(docs, items).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 9)
    assert sorted(map(str, decontaminate.leaks(docs, items).collect())) == whole and len(whole) == 20
    assert sorted(map(str, decontaminate.without_leaks(docs, items).collect())) == kept and len(kept) == 20


def test_windows_are_proposed_by_count():
    rng = np.random.default_rng(12)
    for _ in range(200):
        n, width, least = (int(rng.integers(1, x)) for x in (60, 12, 6))
        held = n + width - 1
        places = np.sort(rng.choice(held, int(rng.integers(1, held + 1)), replace=False))
        want = [s for s in range(n) if ((places >= s) & (places < s + width)).sum() >= least]
        assert decontaminate.proposed(places, least, width, n).tolist() == want


def test_long_texts_in_strips(spark, monkeypatch):
    """Each window is in one context, of the anchor that it has without strips."""
    rng = np.random.default_rng(13)
    texts = [bytes(rng.integers(97, 101, n).astype(np.uint8)) for n in (3000, 150, 0, 1199, 1200, 200)]
    texts += [texts[0][500:1400] + b"xyz" * 300, b"a" * 2500]

    def windows():
        found = [x.tolist() for x in suffix_dedup.contexts(texts, 200)]
        return sorted((k, p, h) for k, h, a, b in zip(*found, strict=True) for p in range(a, b + 1))

    whole = windows()
    assert [x[:2] for x in whole] == [(k, p) for k, t in enumerate(texts) for p in range(len(t) - 199)]
    for strip in (1000, 37):
        monkeypatch.setattr(suffix_dedup, "STRIP", strip)
        assert windows() == whole


def test_a_text_of_any_length_is_taken():
    """Zeros take no memory until they are read; the whole text would need 28 bits and more."""
    text = bytes((1 << 28) + 300)
    seen = []

    class Stop(Exception):
        pass

    def some(texts, length):
        seen.append(len(texts[0]))
        if len(seen) == 3:
            raise Stop
        return (np.zeros(0, np.int64),) * 4

    with pytest.MonkeyPatch.context() as patch, pytest.raises(Stop):
        patch.setattr(suffix_dedup, "strip_contexts", some, raising=False)
        suffix_dedup.contexts([text], 200)
    assert seen == [suffix_dedup.STRIP + 199] * 3


def test_every_context_of_the_sample_is_kept(spark):
    """Two languages of one three-byte script, with more contexts than 8 192 each."""
    rng = np.random.default_rng(14)
    blocks = [np.arange(0x4E00 + 4096 * k, 0x4E00 + 4096 * k + 4000) for k in range(4)]
    follow = {"a": (1, 2, 3, 0), "b": (2, 3, 0, 1)}

    def draw(lang):
        out, own = [], 0
        for _ in range(500):
            own = follow[lang][own] if rng.random() < 0.5 else int(rng.integers(0, 4))
            out.append(chr(int(rng.choice(blocks[own]))))
        return "".join(out)

    rows = [(k, draw("ab"[k % 2]), "ab"[k % 2], "s", 0) for k in range(160)]
    columns = "doc_id long, text string, lang string, source string, n long"
    trees = ppm_langid.fit(spark.createDataFrame(rows[:120], columns))
    counts = Counter()
    for lang in "ab":
        for size, grams, n in ppm_langid.count_grams([r[1].encode() for r in rows[:120] if r[2] == lang], 3):
            counts.update({(lang, size, g): k for g, k in zip(grams.tolist(), n.tolist(), strict=True)})
    for lang in "ab":
        assert len({g >> 8 for own, size, g in counts if (own, size) == (lang, 4)}) > 8192
    texts = [r[1].encode() for r in rows]
    whole = ppm_langid.grow([(*k, n) for k, n in counts.items()])
    assert (ppm_langid.code_lengths(texts, trees) == ppm_langid.code_lengths(texts, whole)).all()
    found = ppm_langid.predict(spark.createDataFrame(rows[120:], columns), trees).collect()
    assert sum(r["lang_pred"] == "ab"[r["doc_id"] % 2] for r in found) == 40


def test_stars_join_what_links_join():
    rng = np.random.default_rng(1)
    for _ in range(100):
        n, m = int(rng.integers(1, 30)), int(rng.integers(0, 40))
        a, b = rng.integers(-n, n, m), rng.integers(-n, n, m)
        root = {x: x for x in range(-n, n)}
        for _ in range(2 * n):
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                root[x] = root[y] = min(root[x], root[y])
        u, v = simhash_vptree.stars(iter([(a[: m // 2], b[: m // 2]), (a[m // 2 :], b[m // 2 :])]))
        assert dict(zip(u.tolist(), v.tolist(), strict=True)) == {x: c for x, c in root.items() if c != x}


@pytest.mark.parametrize("shards", [1, 32, 1024])
def test_copies_of_fingerprints_are_bounded(monkeypatch, shards):
    """At any size a fingerprint has a copy a block, and every link meets in a shard."""
    monkeypatch.setattr(simhash_vptree, "SHARD", 64)
    rng = np.random.default_rng(2)
    points = rng.integers(0, 1 << 64, 48 * shards, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (3, 16 * shards)).astype(np.uint64)
    near = points[: 16 * shards] ^ np.bitwise_or.reduce(flips)
    points = np.concatenate([points, near])
    bits = simhash_vptree.part_bits(len(points), 3)
    assert bits == (shards - 1).bit_length()
    naming = simhash_vptree.naming_bits(points, bits, 3)
    trees = simhash_vptree.part_trees(points, 2 * 64, naming, 3)
    which, shard = simhash_vptree.to_parts(points, trees, naming, 3)
    assert np.bincount(which).min() >= 1 and len(which) <= 10 * len(points)
    assert np.bincount(np.unique(shard, return_inverse=True)[1]).max() <= 4 * 64
    own = [set() for _ in points]
    for k, s in zip(which.tolist(), shard.tolist(), strict=True):
        own[k].add(s)
    assert all(own[k] & own[48 * shards + k] for k in range(16 * shards))


def test_uneven_parts_are_split(monkeypatch):
    """A few crowds of fingerprints, whose bits hardly part them, among bits that all share."""
    monkeypatch.setattr(simhash_vptree, "SHARD", 64)
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 64, 6, dtype=np.uint64) & ~np.uint64(0xFF00FF00FF00FF)
    flips = np.uint64(1) << rng.integers(0, 64, (6, 1800)).astype(np.uint64)
    flips = np.where(rng.random(flips.shape) < 0.6, flips, np.uint64(0))
    points = np.unique(centres[rng.integers(0, 6, 1800)] ^ np.bitwise_xor.reduce(flips))
    naming = simhash_vptree.naming_bits(points[::2], simhash_vptree.part_bits(len(points), 3), 3)
    trees = simhash_vptree.part_trees(points[::2], 64, naming, 3)
    assert trees
    which, shard = simhash_vptree.to_parts(points, trees, naming, 3)
    order = np.argsort(shard, kind="stable")
    groups = np.split(order, np.nonzero(np.diff(shard[order]))[0] + 1)
    assert max(map(len, groups)) < len(points) / 2
    root = {x: x for x in points.tolist()}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for group in groups:
        for a, b in simhash_vptree.links(points[which[group]], 3):
            assert (np.bitwise_count(a ^ b) <= 3).all()
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                root[top(x)] = top(y)
    for x in points:
        for y in points[np.bitwise_count(points ^ x) <= 3].tolist():
            assert top(int(x)) == top(y)


@pytest.mark.parametrize("n", [0, 1, 40, 500])
def test_long_texts_have_all_shingles(monkeypatch, n):
    rng = np.random.default_rng(4)
    gaps = [" ", "  ", "\n", "\t \x0b", "\u00a0"]
    text = "".join(f"W{rng.integers(0, 90)}{gaps[rng.integers(0, 5)]}" for _ in range(n)).encode()
    text = b" " * 9 + text + b" " * 300
    whole = [simhash_vptree.shingles(text, k) for k in (1, 3, 700)]
    prints = simhash_vptree.simhashes([text, b"a b", text], 3, 42)
    for strip in (1, 7, 64):
        monkeypatch.setattr(simhash_vptree, "STRIP", strip)
        for k, want in zip((1, 3, 700), whole, strict=True):
            assert [x for run in simhash_vptree.shingle_runs(text, k) for x in run] == want
        assert (simhash_vptree.simhashes([text, b"a b", text], 3, 42) == prints).all()
