"""Benchmark decontamination by SimHash over item-sized windows.

A document leaks an item of ``m`` words if one of its windows of ``m`` words is alike: the
weighted Jaccard similarity of their five-word shingles (sum of the lesser counts over sum of the
greater) is at least ``similarity``. Three steps find such windows.

Windows that hold fewer of any items' shingles than the similarity takes cannot be alike; only the
others are looked at. This asks whether a shingle is known, not whose it is.

The fingerprint of such a window, over its shingles, is looked up in a multi-index of the items of
that size: the bits in blocks, an item is proposed if it has one block's value. Fingerprints that
differ in fewer bits than there are blocks are found for certain. A repeated shingle counts as
another feature each time, so that similarity ``s`` bounds the cosine by ``2 s / (1 + s)`` and the
chance of a bit to differ by the angle over pi. Radius and block size follow from that: of leaks
that are no more alike than they must be, ``LOSS`` at most lie beyond the radius or share no block.

What is proposed and within the radius is compared exactly.

Items are broadcast in blocks of bounded size, one pass over the documents each; documents are
never shuffled.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import REMEMBERED, Memory, arrow_map, pieces, stage, utf8

SHINGLE, SIMILARITY = 5, 0.8
#: Bits of a fingerprint, and the share of the least similar leaks that it may lose.
BITS, LOSS = 1152, 1e-6
#: Items and bytes of text of a block, about.
BLOCK_ITEMS, BLOCK_BYTES = 65_536, 16 << 20
#: Windows whose fingerprints are held at once, and pairs that they propose.
WINDOWS, PAIRS = 1_024, 1 << 20
WORD = re.compile(r"\w+")

SALTS = np.arange(1, BITS // 64 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
ODD = np.uint64(0xD6E8FEB86659FD93)


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def word_hashes(own: list[str]) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh64_digest, own)), ">u8").astype(np.uint64)


def shingle_keys(hashes: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit key of every ``length`` neighbouring words, given their hashes."""
    n = len(hashes) - length + 1
    key = np.zeros(max(n, 0), np.uint64)
    for k in range(length):
        key = (key ^ hashes[k : k + n]) * SALTS[0]
        key ^= key >> np.uint64(31)
    return key


def shingle_counts(own: list[str], length: int) -> Counter:
    return Counter(zip(*(own[k:] for k in range(length)), strict=False))


def weighted_similarity(a: Counter, b: Counter) -> float:
    least = sum(min(n, b[x]) for x, n in a.items() if x in b)
    return least / (sum(a.values()) + sum(b.values()) - least)


def least_shared(n: int, m: int, length: int, similarity: float) -> int:
    """Shingles that windows of ``n`` and ``m`` words share at least if they are alike."""
    both = max(0, n - length + 1) + max(0, m - length + 1)
    return max(1, math.ceil(similarity * both / (1 + similarity) - 1e-9))


def bit_chance(similarity: float) -> float:
    """The chance of a bit to differ between fingerprints of windows just so alike."""
    return math.acos(min(1.0, 2 * similarity / (1 + similarity))) / math.pi


def radius_for(similarity: float) -> int:
    """Bits within which all but ``LOSS`` of the windows lie that are just so alike."""
    p = bit_chance(similarity)
    beyond, chance = 1.0, (1 - p) ** BITS
    for r in range(BITS):
        beyond -= chance
        if beyond <= LOSS:
            return r
        chance *= (BITS - r) / (r + 1) * p / (1 - p)
    return BITS


def block_bits_for(similarity: float) -> int:
    """The widest blocks of which all but ``LOSS`` of the windows just so alike share one."""
    same = 1 - bit_chance(similarity)
    fit = [w for w in range(1, 17) if (1 - same**w) ** (BITS // w) <= LOSS]
    return max(fit, default=1)


def feature_bits(keys: np.ndarray) -> np.ndarray:
    """For each key the bits of its hash, as 0 and 1."""
    x = keys[:, None] + SALTS
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return np.unpackbits(x.astype("<u8", copy=False).view(np.uint8), axis=1, bitorder="little")


def packed(counts: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints from the counts of each bit among ``n`` features: set in over half."""
    return np.packbits(2 * counts > n, axis=1, bitorder="little").view("<u8")


def told_apart(keys: np.ndarray) -> np.ndarray:
    """The keys, each repetition of one made another."""
    order = np.argsort(keys, kind="stable")
    place = np.arange(len(keys))
    new = np.append(True, keys[order][1:] != keys[order][:-1])
    nth = np.empty(len(keys), np.uint64)
    nth[order] = place - np.maximum.accumulate(np.where(new, place, 0))
    return keys ^ (nth * ODD)


def bit_counts(keys: np.ndarray) -> np.ndarray:
    out = np.zeros(BITS, np.int32)
    for k in range(0, len(keys), WINDOWS):
        out += feature_bits(keys[k : k + WINDOWS]).sum(axis=0, dtype=np.int32)
    return out


def fingerprint(keys: np.ndarray) -> np.ndarray:
    """SimHash of a window's shingles, repetitions counted."""
    return packed(bit_counts(told_apart(keys))[None], len(keys))[0]


def window_fingerprints(keys: np.ndarray, width: int) -> np.ndarray:
    """SimHash of every window of ``width`` shingles."""
    n = len(keys) - width + 1
    held = Counter(keys[:width].tolist())
    leaves, enters = np.zeros(n - 1, np.uint64), np.zeros(n - 1, np.uint64)
    for k, (old, new) in enumerate(zip(keys[: n - 1].tolist(), keys[width:].tolist(), strict=True)):
        held[old] -= 1
        leaves[k], enters[k] = held[old], held[new]
        held[new] += 1
    turn = feature_bits(keys[width:] ^ (enters * ODD)).astype(np.int32)
    turn -= feature_bits(keys[: n - 1] ^ (leaves * ODD))
    first = bit_counts(told_apart(keys[:width]))
    return packed(np.concatenate([first[None], turn]).cumsum(axis=0), width)


def proposed(places: np.ndarray, least: int, width: int, n: int) -> np.ndarray:
    """Those of ``n`` windows of ``width`` shingles that hold at least so many of the places."""
    # the count changes only where a place enters or leaves, so whole runs pass or fail
    edges = np.unique(np.concatenate([places - width + 1, places + 1]).clip(0, n))
    count = np.searchsorted(places, edges + width) - np.searchsorted(places, edges)
    ends, enough = np.append(edges[1:], n), count >= least
    runs = [np.arange(a, b) for a, b in zip(edges[enough], ends[enough], strict=True)]
    return np.concatenate([np.zeros(0, np.int64), *runs])


@dataclass(frozen=True)
class Items:
    """A block of benchmark items: their words, joined, and fingerprints."""

    ids: list[int]
    texts: list[str]
    fps: np.ndarray
    #: By number of words the items of that size.
    sizes: dict[int, np.ndarray]
    #: By shingle length the sorted keys of all items' shingles.
    keys: dict[int, np.ndarray]


def prepare(rows: list[tuple[int, str]]) -> Items:
    """Items without words match nothing; those of fewer than five words are one shingle."""
    kept = [(i, own) for i, own in ((i, words(t or "")) for i, t in rows) if own]
    fps = np.zeros((len(kept), BITS // 64), "<u8")
    sizes: dict[int, list[int]] = {}
    keys: dict[int, list[np.ndarray]] = {}
    for at, (_, own) in enumerate(kept):
        length = min(SHINGLE, len(own))
        held = shingle_keys(word_hashes(own), length)
        fps[at] = fingerprint(held)
        sizes.setdefault(len(own), []).append(at)
        keys.setdefault(length, []).append(held)
    return Items(
        [i for i, _ in kept],
        [" ".join(own) for _, own in kept],
        fps,
        {m: np.array(sizes[m]) for m in sorted(sizes)},
        {length: np.unique(np.concatenate(held)) for length, held in keys.items()},
    )


class MultiIndex:
    """Fingerprints by the value of each of their blocks of ``width`` bits."""

    def __init__(self, fps: np.ndarray, radius: int, width: int):
        self.fps, self.radius, self.width = fps, radius, width
        values = self.values(fps)
        order = np.argsort(values, axis=None, kind="stable")
        self.sorted, self.owner = values.ravel()[order], order // values.shape[1]

    def values(self, fps: np.ndarray) -> np.ndarray:
        """Number and value of each block of each fingerprint, as one integer."""
        bits = np.unpackbits(fps.view(np.uint8), axis=1, bitorder="little")
        blocks = BITS // self.width
        own = bits[:, : blocks * self.width].reshape(len(fps), blocks, self.width)
        powers = 1 << np.arange(self.width, dtype=np.int32)
        return (own @ powers) + (np.arange(blocks, dtype=np.int32) << self.width)

    def within(self, fps: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(window, item, distance) of pairs that share a block and are within the radius."""
        values = self.values(fps)
        lo = np.searchsorted(self.sorted, values)
        n = np.searchsorted(self.sorted, values, "right") - lo
        part = np.cumsum(n.sum(axis=1)) // PAIRS
        for k in np.unique(part).tolist():
            a, b = np.searchsorted(part, [k, k + 1]).tolist()
            many, begin = n[a:b].ravel(), lo[a:b].ravel()
            skipped = np.repeat(np.cumsum(many) - many, many)
            item = self.owner[np.arange(many.sum()) - skipped + np.repeat(begin, many)]
            window = np.repeat(np.arange(a, b), n[a:b].sum(axis=1))
            pair = np.unique(window * len(self.fps) + item)
            window, item = pair // len(self.fps), pair % len(self.fps)
            distance = np.bitwise_count(fps[window] ^ self.fps[item]).sum(axis=1, dtype=np.int32)
            near = distance <= self.radius
            yield from zip(
                window[near].tolist(), item[near].tolist(), distance[near].tolist(), strict=True
            )


class Finder:
    """Leaks of a block of items in texts."""

    def __init__(self, items: Items, similarity: float = SIMILARITY):
        self.items, self.similarity = items, similarity
        self.radius, self.width = radius_for(similarity), block_bits_for(similarity)
        self.indexes = Memory(self.index, most=256)
        #: A first look at whether a key may be known.
        self.flags = {}
        for length, keys in items.keys.items():
            flags = np.zeros(1 << max(10, (16 * len(keys)).bit_length()), bool)
            flags[(keys & np.uint64(len(flags) - 1)).astype(np.int64)] = True
            self.flags[length] = flags

    def index(self, size: tuple[int]) -> MultiIndex:
        return MultiIndex(self.items.fps[self.items.sizes[size[0]]], self.radius, self.width)

    def known(self, keys: np.ndarray, length: int) -> np.ndarray:
        """Places of shingles that some item has."""
        flags, own = self.flags[length], self.items.keys[length]
        maybe = np.nonzero(flags[(keys & np.uint64(len(flags) - 1)).astype(np.int64)])[0]
        at = np.minimum(np.searchsorted(own, keys[maybe]), len(own) - 1)
        return maybe[own[at] == keys[maybe]]

    def pairs(self, own: list[str]) -> Iterator[tuple[int, int, int, int]]:
        """Item, first word, words and distance of the windows whose fingerprints are near."""
        hashes = word_hashes(own)
        for length in self.items.keys:
            if len(own) < length:
                continue
            keys = shingle_keys(hashes, length)
            places = self.known(keys, length)
            for m, members in self.items.sizes.items():
                if min(SHINGLE, m) != length:
                    continue
                size = min(m, len(own))
                least = least_shared(size, m, length, self.similarity)
                if len(places) < least:
                    break  # larger items take more
                width = size - length + 1
                starts = proposed(places, least, width, len(own) - size + 1)
                seen: set[bytes] = set()
                for first, last in _ranges(starts.tolist()):
                    fps = window_fingerprints(keys[first : last + width], width)
                    new = []  # equal windows have one result, the first counts
                    for w in range(len(fps)):
                        own_digest = xxhash.xxh3_128_digest(keys[first + w : first + w + width])
                        if own_digest not in seen:
                            seen.add(own_digest)
                            new.append(w)
                    for w, k, distance in self.indexes[m,].within(fps[new]):
                        yield int(members[k]), first + new[w], size, distance
                    if len(seen) > REMEMBERED:
                        seen.clear()

    def find(self, text: bytes) -> Iterator[tuple[int, int, int, int, float]]:
        """Item, first word, words, distance and similarity of the best window of each leak."""
        own = words(text.decode("utf-8", "replace"))
        best: dict[int, tuple] = {}
        counts: dict[int, Counter] = {}
        for item, at, size, distance in self.pairs(own):
            theirs = self.items.texts[item].split(" ")
            length = min(SHINGLE, len(theirs))
            if item not in counts:
                counts[item] = shingle_counts(theirs, length)
            alike = weighted_similarity(shingle_counts(own[at : at + size], length), counts[item])
            if alike >= self.similarity:
                rank = (-alike, distance, at, size)
                best[item] = min(best.get(item, rank), rank)
        for item, (alike, distance, at, size) in sorted(best.items()):
            yield self.items.ids[item], at, size, distance, -alike


def _ranges(places: list[int]) -> Iterator[tuple[int, int]]:
    """First and last of runs of neighbours, at most ``WINDOWS`` in each."""
    first = last = None
    for x in places:
        if last is not None and (x != last + 1 or x - first >= WINDOWS):
            yield first, last
            first = x
        first, last = x if first is None else first, x
    if first is not None:
        yield first, last


def item_blocks(
    items: DataFrame, id_col: str = "item_id", text_col: str = "text"
) -> Iterator[Items]:
    """The items in blocks of about ``BLOCK_ITEMS`` items and ``BLOCK_BYTES`` of text.

    Rows of equal id and text are one item, so that copies cannot crowd into one block.
    """
    own = items.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).distinct()
    size = own.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    blocks = max(1, -(-size["n"] // BLOCK_ITEMS), -(-(size["b"] or 0) // BLOCK_BYTES))
    for k in range(blocks):
        part = own.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k)
        yield prepare([(r["id"], r["text"]) for r in part.sort("id", "text").collect()])


def leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """``doc_id, item_id, start_word, n_words, distance, similarity``: a row for each leak.

    For each document row and item the best window: the most alike, then the nearest, then the
    first. Words are runs of ``\\w``, lower-cased. A document shorter than an item is one window.
    Null and empty texts, and items without words, leak nothing; null ids are passed on; documents
    of equal id are judged one by one, items of equal id and text once. Only the named columns are
    read.
    """
    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("text"))
    spark, out = docs.sparkSession, None
    for block in item_blocks(items, item_id, item_text):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            finder = Finder(shared.value, similarity)
            for batch in batches:
                rows = []
                for first, texts in pieces(batch.column(1)):
                    for row, text in enumerate(texts, first):
                        rows += [(batch.column(0)[row].as_py(), *x) for x in finder.find(text)]
                columns = list(zip(*rows, strict=True)) or [()] * 6
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], NAMES
                )

        part = arrow_map(kept, run, SCHEMA)
        out = part if out is None else out.union(part)
    return out


NAMES = ["doc_id", "item_id", "start_word", "n_words", "distance", "similarity"]
SCHEMA = (
    "doc_id long, item_id long, start_word int, n_words int, distance int, similarity double"
)


def without_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that leak no item, all columns as they were."""
    blocks = list(item_blocks(items))
    if len(blocks) > 1:
        # one pass a block over written rows, not a chain of Python workers in every task
        numbered = stage(
            docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("at")),
            "numbered",
        )
        own = numbered.select("at", F.col(f"doc.{text_col}").alias("text"))
        leaked = leaks(own, items, id_col="at").select(F.col("doc_id").alias("at")).distinct()
        return numbered.join(leaked, "at", "left_anti").select("doc.*")
    place = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(blocks[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(shared.value)
        for batch in batches:
            texts = batch.column(place).cast(pa.binary())
            clean = [next(finder.find(x), None) is None for _, own in pieces(texts) for x in own]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return arrow_map(docs, run, docs.schema)
