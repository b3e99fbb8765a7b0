"""Token ids in bit or byte planes.

Ids of all documents, each closed by an end id, form one stream in ascending id order. The stream
is cut into parts (one per task) and parts into blocks of a fixed number of ids. A block is
transposed into planes - the first byte, or bit, of every id, then the second, and so on - and
each plane is compressed with zstandard on its own: high planes of small ids are all but empty.

A store is a folder of Parquet files, so that it can lie in any file system Spark reaches and is
committed as a whole:

``chunks``
    a row per block: ``part``, ``chunk`` (place in the part), ``first`` (ids of the part before
    it), ``n``, ``planes`` (one compressed byte string each) and ``docs`` (id, row and number of
    ids in this block of every document that touches it)
``parts``
    the chunk index above: ``part``, ``start`` (ids of all parts before it), ``n_tokens``,
    ``n_chunks``, ``min_id``, ``max_id``
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Memory, arrow_map, byte_letters, pieces, utf8

#: Ids of a block, and the level of compression.
BLOCK, LEVEL = 65_536, 3
BEYOND = re.compile(r"[^\x00-ſ]")
#: The vocabulary's own pattern, for characters up to U+017F.
_L, _N, _S = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ſ", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
LATIN = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
)
CHUNKS = (
    "part int, chunk int, first long, n int, planes array<binary>, "
    "docs array<struct<id: long, row: long, n: int>>"
)


class Encoder:
    """Ids by the tokenizers library, each distinct piece of text encoded once.

    Byte-level vocabularies split a text into pieces before merging, so the ids of a text are
    those of its pieces, which the library's model gives one by one. Texts beyond Latin letters,
    or with the strings of special tokens, go to the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, models

        self.library = Tokenizer.from_file(path)
        self.special = [x.content for x in self.library.get_added_tokens_decoder().values()]
        # the file's model once more, without a cache: pieces come here once
        with open(path, encoding="utf-8") as file:
            made = json.load(file)["model"]
        merges = [tuple(x.split(" ") if isinstance(x, str) else x) for x in made["merges"]]
        self.model = models.BPE(made["vocab"], merges, cache_capacity=0)
        self.letters = list(map(byte_letters().__getitem__, range(256)))
        self.known = Memory(self._piece)

    def _piece(self, piece: str) -> bytes:
        if piece.isascii() and piece[1:].isalpha():  # letters stand for themselves
            shown = self.letters[ord(piece[0])] + piece[1:]
        else:
            shown = "".join(map(self.letters.__getitem__, piece.encode()))
        return array("I", [x.id for x in self.model.tokenize(shown)]).tobytes()

    def __call__(self, text: str) -> bytes:
        """Ids of a text as 32-bit integers."""
        if BEYOND.search(text) or any(x in text for x in self.special):
            return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.known.__getitem__, LATIN.findall(text)))


@lru_cache(2)
def load(path: str) -> Encoder:
    return Encoder(path)


def shuffle_planes(ids: np.ndarray, bits: bool = False) -> list[bytes]:
    """Compressed byte planes of a block of 32-bit ids, or its 32 bit planes."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if bits:
        planes = np.packbits(np.unpackbits(raw, axis=1, bitorder="little").T, axis=1)
    else:
        planes = np.ascontiguousarray(raw.T)
    pack = zstandard.ZstdCompressor(level=LEVEL)
    return [pack.compress(x.tobytes()) for x in planes]


def join_planes(planes: list[bytes], n: int) -> np.ndarray:
    """The ids of a block; four planes are bytes, thirty-two are bits."""
    unpack = zstandard.ZstdDecompressor()
    rows = np.stack([np.frombuffer(unpack.decompress(x), np.uint8) for x in planes])
    if len(planes) == 32:
        bits = np.unpackbits(rows, axis=1)[:, :n]
        raw = np.packbits(bits.T, axis=1, bitorder="little")
    else:
        raw = np.ascontiguousarray(rows.T)
    return raw.reshape(-1).view("<u4")


class Blocks:
    """Cuts a stream of documents into blocks."""

    def __init__(self, part: int, size: int, bits: bool):
        self.part, self.size, self.bits = part, size, bits
        self.chunk = self.first = self.held = 0
        self.ids: list[np.ndarray] = []
        self.docs: list[dict] = []

    def add(self, doc_id: int | None, row: int, ids: np.ndarray) -> Iterator[tuple]:
        at = 0
        while at < len(ids):
            own = ids[at : at + self.size - self.held]
            self.ids.append(own)
            self.docs.append({"id": doc_id, "row": row, "n": len(own)})
            self.held += len(own)
            at += len(own)
            if self.held == self.size:
                yield self.flush()

    def flush(self) -> tuple:
        block = np.concatenate(self.ids)
        out = (self.part, self.chunk, self.first, len(block), shuffle_planes(block, self.bits), self.docs)
        self.chunk, self.first, self.held = self.chunk + 1, self.first + len(block), 0
        self.ids, self.docs = [], []
        return out


def _chunk_batch(rows: list[tuple]) -> pa.RecordBatch:
    doc = pa.struct([("id", pa.int64()), ("row", pa.int64()), ("n", pa.int32())])
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.binary()), pa.list_(doc))
    columns = zip(*rows, strict=True) if rows else [()] * 6
    return pa.RecordBatch.from_arrays(
        [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)],
        ["part", "chunk", "first", "n", "planes", "docs"],
    )


def write(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 0,
    block: int = BLOCK,
    bits: bool = False,
) -> None:
    """Encode whole texts and write a store.

    Null texts count as empty and have the end id only. Null document ids come first; rows of
    equal id follow each other in order of a hash of their text. Ranges of ids are one task's
    work each, and a hot id is parted by that hash. No other column is read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), utf8(text_col).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = load(tokenizer)
        blocks, row = Blocks(TaskContext.get().partitionId(), block, bits), 0
        end = array("I", [end_id]).tobytes()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, texts in pieces(batch.column(1)):
                done = []
                for k, text in enumerate(texts, first):
                    own = encode(text.decode("utf-8", "replace")) + end
                    done += blocks.add(ids[k], row, np.frombuffer(own, "<u4"))
                    row += 1
                if done:
                    yield _chunk_batch(done)
        if blocks.held:
            yield _chunk_batch([blocks.flush()])

    chunks = arrow_map(ordered.select("id", "text"), run, CHUNKS)
    writer = chunks.write.option("compression", "none")
    writer.parquet(f"{folder}/chunks")
    spark = docs.sparkSession
    touched = F.transform("docs", lambda x: x["id"])
    parts = read_chunks(spark, folder).groupBy("part").agg(
        F.sum("n").cast("long").alias("n_tokens"),
        F.count("*").alias("n_chunks"),
        F.min(F.array_min(touched)).alias("min_id"),
        F.max(F.array_max(touched)).alias("max_id"),
    )
    # a row per task, not per document: a running total over them is small at any size
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long")
    parts.withColumn("start", start).write.parquet(f"{folder}/parts")


def read_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(CHUNKS).parquet(f"{folder}/chunks")


def read_parts(spark: SparkSession, folder: str) -> DataFrame:
    schema = "part int, n_tokens long, n_chunks long, min_id long, max_id long, start long"
    return spark.read.schema(schema).parquet(f"{folder}/parts")


def _per_piece(
    chunks: DataFrame, function: Callable[[bytes], object], name: str, kind: str
) -> DataFrame:
    """``part, row, at, id, n`` and a value for what each block holds of each document."""
    arrow_kind = {"long": pa.int64(), "binary": pa.binary()}[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, first, n, planes, docs in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                raw = memoryview(join_planes(planes, n).tobytes())
                sizes = [x["n"] for x in docs]
                ends = np.cumsum([0, *sizes])
                values = [function(raw[4 * a : 4 * b]) for a, b in zip(ends, ends[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(docs), pa.int32()),
                        pa.array([x["row"] for x in docs], pa.int64()),
                        pa.array(first + ends[:-1], pa.int64()),
                        pa.array([x["id"] for x in docs], pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(values, arrow_kind),
                    ],
                    ["part", "row", "at", "id", "n", name],
                )

    return arrow_map(
        chunks.select("part", "first", "n", "planes", "docs"),
        run,
        f"part int, row long, at long, id long, n long, {name} {kind}",
    )


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, ids``: the documents of a store, ids as little-endian 32-bit integers."""
    found = _per_piece(read_chunks(spark, folder), bytes, "raw", "binary")
    own = found.groupBy("part", "row").agg(
        F.first("id").alias("doc_id"),
        F.min("at").alias("at"),
        F.array_sort(F.collect_list(F.struct("at", "raw"))).alias("raws"),
    )
    joined = own.join(read_parts(spark, folder).select("part", "start"), "part")
    raw = F.aggregate("raws", F.lit(b""), lambda a, x: F.concat(a, x["raw"]))
    return joined.select("doc_id", (F.col("start") + F.col("at")).alias("start"), raw.alias("ids"))


def _times(matrix: list[int], vector: int) -> int:
    out = 0
    for row in matrix:
        if not vector:
            break
        if vector & 1:
            out ^= row
        vector >>= 1
    return out


@lru_cache(64)
def _zeros(power: int) -> list[int]:
    """What ``2 ** power`` zero bytes do to a CRC-32, as a matrix over bits."""
    if power == 0:
        one = [0xEDB88320] + [1 << k for k in range(31)]  # a zero bit
        for _ in range(3):
            one = [_times(one, x) for x in one]
        return one
    half = _zeros(power - 1)
    return [_times(half, x) for x in half]


def join_crc32(first: int, second: int, size: int) -> int:
    """CRC-32 of two byte strings in a row, the second of ``size`` bytes, from their own."""
    power = 0
    while size:
        if size & 1:
            first = _times(_zeros(power), first)
        size >>= 1
        power += 1
    return first ^ second


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document of a store.

    Blocks are read in any order by any task: a document in several blocks has the checksums of
    its pieces joined, so its ids need not meet.
    """
    found = _per_piece(read_chunks(spark, folder), zlib.crc32, "crc", "long")
    own = found.groupBy("part", "row").agg(
        F.first("id").alias("doc_id"),
        F.min("at").alias("at"),
        F.sum("n").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("at", "n", "crc"))).alias("pieces"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crcs = []
            for own in batch.column(4).to_pylist():
                crc = own[0]["crc"]
                for x in own[1:]:
                    crc = join_crc32(crc, x["crc"], 4 * x["n"])
                crcs.append(crc)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(crcs, pa.int64())],
                ["part", "doc_id", "at", "n_tokens", "ids_crc32"],
            )

    own = own.select("part", "doc_id", "at", "n_tokens", "pieces")
    own = arrow_map(own, run, "part int, doc_id long, at long, n_tokens long, ids_crc32 long")
    joined = own.join(read_parts(spark, folder).select("part", "start"), "part")
    return joined.select(
        "doc_id", (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )
