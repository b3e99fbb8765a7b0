"""Alignment of the tokens of two tokenizers over the same bytes.

Tokenizer A is byte-level BPE, B a sentencepiece model; both cut the bytes of a text (with one
space before it) into tokens. Where tokens of both end is the end of a group. Tokens whose bytes
overlap are linked, and a pair of ids counts in as many documents as hold it linked.

Copies of a text align alike, so texts are shuffled by their whole text, each distinct one is
tokenised and aligned once, and counts are weighted by its number of copies. Corpus-wide counts are
looked up by batch: a task's texts share a dictionary of the pairs they hold, so a pair travels
once per batch and not once per text that has it. Measures are joined to document ids at the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import plane_store
from tidemark.llm.common import arrow_map, importable, spaced_strips, stage, utf8

#: Bytes of text in a batch; a longer text is a batch of its own.
BATCH = 8 << 20
#: Bytes of a text that are tokenised at once.
STRIP = 1 << 18
SPACE = "▁"

BATCHES = (
    "batch long, pairs array<long>, docs array<long>, "
    "texts array<struct<key: binary, n_a: long, n_b: long, n_groups: long, n_links: long, "
    "groups: string, links: binary>>"
)
MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


@dataclass(frozen=True)
class Aligned:
    """Measures of a text, and its different links with how often each occurs."""

    n_a: int
    n_b: int
    n_groups: int
    groups: str
    pairs: np.ndarray
    times: np.ndarray


NOTHING = Aligned(0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))


class Spelling:
    """Byte strings by number, joined by gathering them from one array."""

    def __init__(self, strings: list[bytes]):
        self.flat = np.frombuffer(b"".join(strings), np.uint8)
        self.sizes = np.array(list(map(len, strings)), np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def join(self, numbers: np.ndarray) -> bytes:
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        shift = np.repeat(self.starts[numbers] - (ends - sizes), sizes)
        return self.flat[np.arange(len(shift)) + shift].tobytes()


class Aligner:
    """Both tokenizers, and the bytes of each of their tokens."""

    def __init__(self, byte_level: str, sentences: str):
        import sentencepiece

        # strings of special tokens are ordinary text here
        self.a = plane_store.Encoder(byte_level)
        self.a.special = []
        self.a.library.encode_special_tokens = True
        byte = {c: b for b, c in enumerate(self.a.letters)}
        vocab = self.a.library.get_vocab(with_added_tokens=False)
        tokens_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            tokens_a[i] = bytes(byte[c] for c in token)
        self.b = sentencepiece.SentencePieceProcessor(model_file=sentences)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        tokens_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
            for i, p in enumerate(pieces)
        ]
        # a text may be cut before a space if no token spans the place
        self.cuttable = not any(SPACE in p.lstrip(SPACE) for p in pieces)
        self.bytes_a, self.bytes_b = Spelling(tokens_a), Spelling(tokens_b)
        # each id with every sign that may follow it
        most = max(len(tokens_a), len(tokens_b))
        self.shown = Spelling([f"{i}{sign}".encode() for i in range(most) for sign in ",|;"])

    def tokens(self, strip: bytes) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of a strip that begins with a space, or None if their bytes are not the strip's."""
        text = strip.decode("utf-8", "replace")
        a = np.frombuffer(self.a(text), "<u4").astype(np.int64)
        b = np.array(self.b.encode(text[1:], out_type=int), np.int64)
        same = self.bytes_a.join(a) == strip and self.bytes_b.join(b) == strip
        return (a, b) if same else None

    def align(self, text: bytes) -> Aligned:
        if not text:
            return NOTHING
        whole = b" " + text
        n_a = n_b = n_groups = 0
        digest = hashlib.sha256()
        pairs = np.zeros(0, np.int64)
        times = np.zeros(0, np.int64)
        # a limit beyond the text leaves it whole
        for strip in spaced_strips(whole, STRIP if self.cuttable else len(whole)):
            ids = self.tokens(strip)
            if ids is None:
                return NOTHING
            a, b = ids
            ends_a, ends_b = np.cumsum(self.bytes_a.sizes[a]), np.cumsum(self.bytes_b.sizes[b])
            ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
            ends = ends[np.diff(ends, prepend=0) > 0]
            held = a[np.searchsorted(ends_a, ends)] << 32 | b[np.searchsorted(ends_b, ends)]
            found, n = np.unique(held, return_counts=True)
            if len(pairs):
                pairs, place = np.unique(np.concatenate([pairs, found]), return_inverse=True)
                times = np.bincount(place, np.concatenate([times, n])).astype(np.int64)
            else:
                pairs, times = found, n
            # tokens of each that end with a token of the other
            cuts_a = np.nonzero(ends_b[np.searchsorted(ends_b, ends_a)] == ends_a)[0] + 1
            cuts_b = np.nonzero(ends_a[np.searchsorted(ends_a, ends_b)] == ends_b)[0] + 1
            if n_groups:
                digest.update(b";")
            digest.update(self.spelled(a, b, cuts_a, cuts_b))
            n_a, n_b, n_groups = n_a + len(a), n_b + len(b), n_groups + len(cuts_a)
        return Aligned(n_a, n_b, n_groups, digest.hexdigest(), pairs, times)

    def spelled(self, a: np.ndarray, b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray) -> bytes:
        """The groups as ``a1,a2|b1;a3|b2,b3``, all tokens with the sign behind them in one order."""
        own_a, own_b = 3 * a, 3 * b
        own_a[cuts_a - 1] += 1
        own_b[cuts_b - 1] += 2
        sizes_a, sizes_b = np.diff(cuts_a, prepend=0), np.diff(cuts_b, prepend=0)
        # a group's tokens of A stand behind all groups before it, those of B behind these too
        at = np.empty(len(a) + len(b), np.int64)
        at[np.arange(len(a)) + np.repeat(cuts_b - sizes_b, sizes_a)] = own_a
        at[np.arange(len(b)) + np.repeat(cuts_a, sizes_b)] = own_b
        return self.shown.join(at)[:-1]


@lru_cache(2)
def load(byte_level: str, sentences: str) -> Aligner:
    return Aligner(byte_level, sentences)


def pack_links(place: np.ndarray, times: np.ndarray) -> bytes:
    """Places in the batch's dictionary, ascending, as steps, and how often each link occurs."""
    return np.concatenate([np.diff(place, prepend=0), times]).astype("<u4").tobytes()


def unpack_links(links: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, times = np.frombuffer(links, "<u4").astype(np.int64).reshape(2, -1)
    return np.cumsum(steps), times


def one_batch(batch: int, texts: list[tuple[bytes, int, Aligned]]) -> pa.RecordBatch:
    """The row of a batch from (key, copies, alignment) of each text."""
    held = [x.pairs for _, _, x in texts]
    pairs, place = np.unique(np.concatenate(held), return_inverse=True)
    copies = np.repeat([n for _, n, _ in texts], list(map(len, held)))
    docs = np.zeros(len(pairs), np.int64)
    np.add.at(docs, place, copies)
    places = np.split(place, np.cumsum(list(map(len, held)))[:-1])
    rows = [
        (key, x.n_a, x.n_b, x.n_groups, int(x.times.sum()), x.groups, pack_links(at, x.times))
        for (key, _, x), at in zip(texts, places, strict=True)
    ]
    names = ["key", "n_a", "n_b", "n_groups", "n_links", "groups", "links"]
    kinds = [pa.binary(), *[pa.int64()] * 4, pa.string(), pa.binary()]
    own = pa.StructArray.from_arrays(
        [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names
    )
    one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
    return pa.RecordBatch.from_arrays(
        [pa.array([batch]), one(pa.array(pairs)), one(pa.array(docs)), one(own)],
        ["batch", "pairs", "docs", "texts"],
    )


def align_texts(texts: DataFrame, byte_level: str, sentences: str) -> DataFrame:
    """A row per batch of distinct texts (columns ``key, text, copies``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        aligner = load(byte_level, sentences)
        batch = TaskContext.get().partitionId() << 32
        held, size = [], 0
        for rows in batches:
            for key, text, copies in zip(*rows.columns, strict=True):
                raw = text.as_py()
                if held and size + len(raw) > BATCH:
                    yield one_batch(batch, held)
                    batch, held, size = batch + 1, [], 0
                held.append((key.as_py(), copies.as_py(), aligner.align(raw)))
                size += len(raw)
        if held:
            yield one_batch(batch, held)

    return arrow_map(texts.select("key", "text", "copies"), run, BATCHES)


def pair_counts(batches: DataFrame) -> DataFrame:
    """``pair, n, best``: documents that hold a pair of ids linked, and whether no other pair of
    its A id is in more."""
    held = batches.select(F.explode(F.arrays_zip("pairs", "docs")).alias("x"))
    counts = held.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.docs").alias("n"))
    counts = stage(counts.withColumn("a", F.shiftright("pair", 32)), "pair-counts")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def measures(batches: DataFrame, counts: DataFrame) -> DataFrame:
    """``key`` and the measures of each distinct text."""
    asked = batches.select("batch", F.posexplode("pairs").alias("place", "pair"))
    found = asked.join(counts, "pair").select("batch", "place", "n", "best")

    def run(texts: pa.Table, found: pa.Table) -> pa.Table:
        n = np.zeros(found.num_rows, np.int64)
        best = np.zeros(found.num_rows, bool)
        place = found["place"].to_numpy()
        n[place] = found["n"].to_numpy()
        best[place] = found["best"].to_numpy()
        rows = []
        for x in texts["texts"].combine_chunks().flatten().to_pylist():
            at, times = unpack_links(x["links"])
            measured = (int(times[best[at]].sum()), int((times * n[at]).sum()))
            rows.append((x["key"], x["n_a"], x["n_b"], x["n_groups"], x["n_links"], *measured, x["groups"]))
        kinds = [pa.binary(), *[pa.int64()] * 6, pa.string()]
        return pa.Table.from_arrays(
            [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)],
            ["key", *MEASURES, "groups_sha256"],
        )

    importable(batches.sparkSession)
    schema = f"key binary, {', '.join(f'{x} long' for x in MEASURES)}, groups_sha256 string"
    own = batches.select(F.col("batch").alias("own"), "texts").groupBy("own")
    return own.cogroup(found.groupBy("batch")).applyInArrow(run, schema)


def align(
    docs: DataFrame, byte_level: str, sentences: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id`` and, for every row of ``docs``, the agreement of the tokenizers on its text.

    ``n_a, n_b, n_groups, n_links`` count tokens, groups and links; ``n_best`` the links whose
    documents are the most of any link of their A id, ties included; ``count_sum`` adds up the
    documents of all links; ``groups_sha256`` is the digest of the groups' ids. Null and empty
    texts, and those whose tokens of A or B do not give back their bytes, have zeros and an empty
    string. Rows of equal or null id stay rows of their own. An empty table gives an empty result.
    Other columns are not read.
    """
    texts = docs.select(utf8(text_col).alias("text"))
    distinct = texts.groupBy("text").agg(F.count("*").alias("copies"))
    distinct = distinct.withColumn("key", F.unhex(F.sha2("text", 256)))
    batches = stage(align_texts(distinct, byte_level, sentences), "aligned-batches")
    # written, so that copies of one text, a third of the rows perhaps, can be split in the join
    found = stage(measures(batches, pair_counts(batches)), "alignment-measures")
    own = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.unhex(F.sha2(utf8(text_col), 256)).alias("key"),
    )
    return own.join(found, "key").drop("key")
