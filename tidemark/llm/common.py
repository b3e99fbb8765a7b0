"""Helpers of the operators: staged tables, Arrow batches in bounded pieces, stable choices."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.session import fresh_dir, remove

ROOT = str(Path(__file__).resolve().parents[2])
#: Bytes of text that a task turns into arrays at once; a longer text is a piece of its own.
PIECE_BYTES = 1 << 20

#: Words remembered by a task, and the longest word remembered.
REMEMBERED, LONG = 400_000, 64
#: A space between two bytes of ASCII that are not white space.
BETWEEN = re.compile(rb"[!-~] (?=[!-~])")

ArrowFunction = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def importable(spark: SparkSession) -> None:
    """Let the Python workers import this package."""
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])


def arrow_map(df: DataFrame, function: ArrowFunction, schema: StructType | str) -> DataFrame:
    """``mapInArrow`` with this package importable by the Python workers."""
    importable(df.sparkSession)
    return df.mapInArrow(function, schema)


@dataclass
class Scratch:
    """Folders and catalog tables staged for one result."""

    folders: list[str] = field(default_factory=list)
    tables: list[str] = field(default_factory=list)


_scratch: ContextVar[Scratch | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """What operators stage inside is removed at the end, also after a failure.

    Results are lazy and read what was staged, so they must be written inside. Where scopes are
    nested, each removes its own. Without one, staged folders and tables stay.
    """
    own = Scratch()
    token = _scratch.set(own)
    try:
        yield own
    finally:
        _scratch.reset(token)
        for name in own.tables:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        for path in own.folders:
            remove(spark, path)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new path below the shared folder, removed with the scope that it is made in."""
    path = fresh_dir(spark, purpose)
    if own := _scratch.get():
        own.folders.append(path)
    return path


def scratch_table(spark: SparkSession, purpose: str) -> tuple[str, str]:
    """A new table's name and path; the table is dropped with the scope that it is made in."""
    path = scratch_dir(spark, purpose)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    if own := _scratch.get():
        own.tables.append(name)
    return name, path


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the shared folder and read it: cuts lineage, survives lost executors."""
    path = scratch_dir(df.sparkSession, purpose)
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: str):
    """A text column as its UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def pieces(texts: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of a batch's texts of about ``limit`` bytes: index of the first, the texts."""
    first, size, piece = 0, 0, []
    for row in range(len(texts)):
        text = texts[row].as_py() or b""
        if piece and size + len(text) > limit:
            yield first, piece
            first, size, piece = row, 0, []
        piece.append(text)
        size += len(text)
    if piece:
        yield first, piece


def spaced_strips(text: bytes, limit: int = PIECE_BYTES) -> Iterator[bytes]:
    """A text in strips of about ``limit`` bytes, cut before single spaces between words.

    A strip after the first begins with that space. A word longer than ``limit`` stays whole.
    """
    at = 0
    while len(text) - at > limit:
        cut = BETWEEN.search(text, at + limit - 1)
        if not cut:
            break
        yield text[at : cut.start() + 1]
        at = cut.start() + 1
    if at or text:
        yield text[at:]


class Memory(dict):
    """A table that computes what it lacks and starts afresh when full."""

    def __init__(self, compute, most: int = REMEMBERED):
        super().__init__()
        self.compute, self.most = compute, most

    def __missing__(self, key):
        value = self.compute(key)
        if len(self) >= self.most:
            self.clear()
        if len(key) <= LONG:
            self[key] = value
        return value


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte: itself where printable, else from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}
