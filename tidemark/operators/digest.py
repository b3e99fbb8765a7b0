"""Reconciliation by digests: agreement is proved without moving rows.

Both sides are summed up by key bucket: the number of rows, and the sum and exclusive or of two
hashes of each row. These are free of order, so a map task adds up its own rows and sends a digest
per bucket. Buckets that agree hold the same rows; buckets that differ are parted into finer ones,
and so on, and only rows of differing buckets of the last level are compared one by one. Tables in
agreement cost one scan each and a shuffle of digests, whatever their size.

Rows of a bucket could differ and yet agree in all sums only by chance: two 64-bit hashes of each
row enter, one of them enough for a chance of 2 ** -64 a bucket.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.reconcile import compare_rows
from tidemark.schema import TableSpec
from tidemark.session import fresh_dir
from tidemark.sources.tables import conform

#: A level parts each bucket of the one above into this many, as a power of two. The first
#: level's differing buckets are held by the driver: 4096 numbers at most.
LEVEL_BITS = 12
#: Levels there are at most: 16 million buckets, or a million rows in each at 2e13 rows.
LEVELS = 2
#: Rows in differing buckets up to which they are compared without another level.
FEW_ROWS = 1_000_000
#: Column of the first level's bucket; in a table laid out by it the number of bits follows.
BUCKET = "digest_bucket"


@dataclass
class Difference:
    """What is left to compare: the first level's differing buckets, and those of the last level.

    ``levels`` is how many levels were needed, ``rows`` how many rows of both sides are in differing
    buckets, ``total`` how many the source has. ``buckets`` is empty if the tables agree; ``fine``
    is None if the last level is the first.
    """

    buckets: list[int]
    fine: DataFrame | None
    levels: int
    rows: int
    total: int


def _plain(column: str, kind: T.DataType) -> Column:
    """A value that hashes alike if it compares alike: there is one zero."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.col(column) + F.lit(0).cast(kind)
    return F.col(column)


def _hash(spec: TableSpec, columns: Iterable[str], seed: int) -> Column:
    """A hash that tells NULLs from each other's places, which ``xxhash64`` passes over."""
    parts = []
    for c in columns:
        parts += [_plain(c, spec.record[c].dataType), F.col(c).isNull()]
    return F.xxhash64(F.lit(seed), *parts)


def bucket_of(spec: TableSpec, bits: int) -> Column:
    """The key's bucket among ``2 ** bits``; finer buckets of a key lie inside coarser ones."""
    return F.shiftrightunsigned(_hash(spec, spec.key, 0), 64 - bits)


def digests(source: DataFrame, latest: DataFrame, spec: TableSpec, bucket: Column) -> DataFrame:
    """``bucket, n_source, n_latest, agrees`` for each key bucket of two tables.

    The latest table's hashes are taken off the source's, so that a bucket's digest is nothing if
    its rows agree. Hashes are added up in halves: a bucket of 2 ** 31 rows cannot overflow.
    """

    def hashed(rows: DataFrame, sign: int) -> DataFrame:
        own = (_hash(spec, spec.columns, seed).alias(name) for seed, name in ((1, "h1"), (2, "h2")))
        return rows.select(bucket.alias("bucket"), *own, F.lit(sign).alias("sign"))

    sign = F.col("sign")
    halves = [x for h in ("h1", "h2") for x in (F.shiftrightunsigned(h, 32), F.col(h).bitwiseAND(0xFFFFFFFF))]
    nothing = [F.sum(sign * x) == 0 for x in halves] + [F.bit_xor(h) == 0 for h in ("h1", "h2")]
    return (
        hashed(source, 1)
        .unionAll(hashed(latest, -1))
        .groupBy("bucket")
        .agg(
            F.count_if(sign == 1).alias("n_source"),
            F.count_if(sign == -1).alias("n_latest"),
            reduce(Column.__and__, nothing, F.sum(sign) == 0).alias("agrees"),
        )
    )


def _with_bucket(table: DataFrame, spec: TableSpec, bits: int) -> DataFrame:
    """The record columns and the first level's bucket, which a table may have as a column."""
    name = f"{BUCKET}{bits}"
    bucket = F.col(name).cast("long") if name in table.columns else bucket_of(spec, bits)
    return conform(table, spec, bucket.alias(BUCKET))


def differing(
    source: DataFrame,
    latest: DataFrame,
    spec: TableSpec,
    bits: int = LEVEL_BITS,
    levels: int = LEVELS,
    few_rows: int = FEW_ROWS,
) -> Difference:
    """Find the key buckets in which two tables differ, level by level.

    Another level is made only while differing buckets hold more than ``few_rows`` rows.
    """
    spark = source.sparkSession
    sides = [_with_bucket(t, spec, bits) for t in (source, latest)]
    # a row for each bucket of the first level
    found = digests(*sides, spec, F.col(BUCKET)).collect()
    buckets = sorted(r["bucket"] for r in found if not r["agrees"])
    rows = sum(r["n_source"] + r["n_latest"] for r in found if not r["agrees"])
    total = sum(r["n_source"] for r in found)
    fine, level = None, 1
    while level < levels and rows > few_rows:
        level += 1
        at = bucket_of(spec, bits * level)
        left = [_inside(t, buckets, fine, spec, bits * (level - 1)) for t in sides]
        finer = digests(*left, spec, at).where("NOT agrees")
        path = fresh_dir(spark, "digests")
        finer.select("bucket", "n_source", "n_latest").write.parquet(path)
        fine = spark.read.schema("bucket LONG, n_source LONG, n_latest LONG").parquet(path)
        rows = fine.agg(F.sum(F.col("n_source") + F.col("n_latest")).alias("n")).first()["n"] or 0
    return Difference(buckets, fine, level, rows, total)


def _inside(
    rows: DataFrame, buckets: list[int], fine: DataFrame | None, spec: TableSpec, bits: int
) -> DataFrame:
    """The rows of differing buckets: of the first level by a filter, which reaches the partitions
    of a table laid out by it; of the last by a semi join."""
    kept = rows.where(F.col(BUCKET).isin(buckets))
    if fine is not None:
        kept = kept.withColumn("bucket", bucket_of(spec, bits))
        kept = kept.join(fine.select("bucket"), "bucket", "left_semi")
    return kept.select(*spec.columns, BUCKET)


def rows_to_compare(
    source: DataFrame, latest: DataFrame, spec: TableSpec, found: Difference, bits: int = LEVEL_BITS
) -> tuple[DataFrame, DataFrame]:
    """The rows of either side that digests could not show to agree."""
    return tuple(
        _inside(_with_bucket(t, spec, bits), found.buckets, found.fine, spec, bits * found.levels)
        for t in (source, latest)
    )


def _report(spec: TableSpec, source: DataFrame, latest: DataFrame, options: dict) -> DataFrame:
    found = differing(source, latest, spec, **options)
    spark = source.sparkSession
    if not found.buckets:
        counts = spark.range(1).select(
            F.lit(0).cast("long").alias("num_missing"), F.lit(0).cast("long").alias("num_stale")
        )
    else:
        sides = rows_to_compare(source, latest, spec, found, options.get("bits", LEVEL_BITS))
        counts = compare_rows(*sides, spec).agg(
            F.count_if(F.col("in_latest") == 0).alias("num_missing"),
            F.count_if(F.col("in_source") == 0).alias("num_stale"),
        )
    settled = (F.col("num_missing") == 0) & (F.col("num_stale") == 0)
    return counts.select(
        settled.alias("result"),
        F.lit(spec.name).alias("name"),
        "num_missing",
        "num_stale",
        F.lit(found.total).cast("long").alias("num_total"),
    )


def reconcile_digest(
    tables: Iterable[tuple[TableSpec, DataFrame, DataFrame]], **options: int
) -> DataFrame:
    """The report of :func:`~tidemark.operators.reconcile.reconcile`, by way of digests.

    One row per (spec, source, latest). Digests are made when this is called; what they leave
    open is compared when the report is read. ``options`` go to :func:`differing`. Both tables
    must give the same rows whenever they are read.
    """
    return reduce(DataFrame.unionByName, (_report(*table, options) for table in tables))


def write_by_bucket(
    table: DataFrame, spec: TableSpec, path: str, mode: str = "errorifexists", bits: int = LEVEL_BITS
) -> None:
    """Write a table in folders by the first level's bucket, for readers that open a few of them."""
    name = f"{BUCKET}{bits}"
    placed = conform(table, spec, bucket_of(spec, bits).cast("int").alias(name))
    placed.repartition(name).write.mode(mode).partitionBy(name).parquet(path)


def read_by_bucket(spark: SparkSession, path: str, spec: TableSpec, bits: int = LEVEL_BITS) -> DataFrame:
    """A table written by :func:`write_by_bucket`, its bucket as a last column."""
    schema = T.StructType([*spec.record.fields, T.StructField(f"{BUCKET}{bits}", T.IntegerType())])
    return spark.read.schema(schema).parquet(path)
