"""Incremental refresh of the latest table from a high-water mark."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.envelope import FLOOR_TS, Mark, after_mark, epoch_millis, key_columns
from tidemark.operators.latest import latest_state, live
from tidemark.schema import DELETE, TableSpec
from tidemark.session import settings

# Parquet through the second reader interface, which answers aggregates from footers.
FOOTERS = {
    "spark.sql.sources.useV1SourceList": "",
    "spark.sql.parquet.aggregatePushdown": "true",
}
# The floor as epoch milliseconds.
FLOOR_MS = -62_135_596_800_000


def high_watermark(latest: DataFrame) -> DataFrame:
    """One row: the newest ``ts`` of the latest table, or the floor when it is empty."""
    return latest.agg(F.coalesce(F.max("ts"), F.expr(FLOOR_TS)).alias("ts"))


MARK_MS = "mark_ms"


def write_marked(latest: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a latest table with its times as whole milliseconds beside them.

    Parquet footers hold the greatest value of a column of whole numbers, and Spark can answer a
    maximum from them; it cannot for a column of timestamps. The column comes first: Spark finds
    it in a footer by its place among the columns that are read, so it must be the same there.
    """
    latest.select(epoch_millis("ts").alias(MARK_MS), "*").write.mode(mode).parquet(path)


def footer_mark(spark: SparkSession, path: str) -> DataFrame:
    """One row, ``mark_ms``: the newest time of a table written by :func:`write_marked`.

    It is NULL for an empty table. The maximum is pushed into the scan, which reads footers and
    no rows. Collect it, or use :func:`stored_mark`, before the settings it needs are changed.
    """
    with settings(spark, FOOTERS):
        return spark.read.schema(f"{MARK_MS} LONG").parquet(path).agg(F.max(MARK_MS).alias(MARK_MS))


def stored_mark(spark: SparkSession, path: str) -> int:
    """The mark of a table written by :func:`write_marked`, before all times if it is empty."""
    with settings(spark, FOOTERS):
        found = footer_mark(spark, path).first()[MARK_MS]
    return FLOOR_MS if found is None else found


def newer_than(changes: DataFrame, mark: Mark) -> DataFrame:
    """Changes strictly later than the mark."""
    return after_mark(changes, mark)


def changed_since(changes: DataFrame, spec: TableSpec, mark: Mark) -> DataFrame:
    """State (``record``, ``op``, ``ts``) of the keys that changed after the mark."""
    return latest_state(changes, spec, since=mark)


def changed_keys(changes: DataFrame, spec: TableSpec, mark: Mark | None = None) -> DataFrame:
    """Distinct keys that changed (after the mark, if one is given).

    A key changed if any of its changes is late enough, so nothing needs ranking, and the
    scan reads only the key leaves and ``ts_ms``. Keys are made distinct before the shuffle.
    """
    if mark is not None:
        changes = newer_than(changes, mark)
    keys = [c.alias(k) for k, c in zip(spec.key, key_columns(spec))]
    return changes.select(*keys).distinct()


def store_keys(changes: DataFrame, spec: TableSpec, mark: Mark, path: str) -> DataFrame:
    """The keys that changed after the mark, written and read back.

    Their size is known then. A join of a much larger table with them is planned with a Bloom
    filter of the keys on that table's scan, where Spark's thresholds allow (the table from
    ``spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold`` on), or with a
    broadcast of the keys if they are few.
    """
    spark = changes.sparkSession
    newer = newer_than(changes, mark)
    keys = [c.alias(k) for k, c in zip(spec.key, key_columns(spec), strict=True)]
    # the newest time of each key is kept: a filter by it tells the planner that keys are few
    found = newer.select(*keys, "ts_ms").groupBy(*spec.key).agg(F.max("ts_ms").alias("__newest"))
    found.write.parquet(path)
    stored = spark.read.schema(found.schema).parquet(path)
    floor = F.lit(-(1 << 63)).cast("long")
    return stored.where(F.col("__newest") > floor).select(*spec.key)


def rows_to_replace(latest: DataFrame, keys: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows of the latest table whose key is among ``keys``."""
    return latest.join(keys, list(spec.key), "left_semi")


def delete_changed(latest: DataFrame, keys: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows of the latest table whose key is not among ``keys``.

    An anti join rather than NOT IN: a NULL among the keys removes nothing.
    """
    return latest.join(keys, list(spec.key), "left_anti")


def delete_few(latest: DataFrame, keys: DataFrame, spec: TableSpec, path: str) -> DataFrame:
    """The same where few of many keys are in a table that is far larger.

    No filter can be put under an anti join. So the keys that the table has are found first, by a
    semi join, which can have one, and written to ``path``: what is left to take off is as many
    rows as will go, and small enough to be broadcast more often.
    """
    found = rows_to_replace(latest, keys, spec).select(*spec.key).distinct()
    found.write.parquet(path)
    gone = latest.sparkSession.read.schema(found.schema).parquet(path)
    return delete_changed(latest, gone, spec)


def insert_changed(latest: DataFrame, state: DataFrame, spec: TableSpec) -> DataFrame:
    """The latest table plus the live rows of ``state``."""
    columns = [*spec.columns, "ts"]
    return latest.select(*columns).unionByName(live(state).select(*columns))


def apply_delta(
    latest: DataFrame,
    changes: DataFrame,
    spec: TableSpec,
    marks: Literal["one", "two"] = "one",
) -> DataFrame:
    """The latest table brought up to date with the changes after its high-water mark.

    ``changes`` must be the whole log, or all of it from the mark on: a part of it may lack
    the delete that outranks an update. (A store that is fed in parts remembers deletes.)

    Removes every key that changed and inserts the new rows of those that still live, in one
    plan. ``marks="one"`` reads the mark once, ranks the changes once and joins them to
    ``latest``, which must hold each key once. ``marks="two"`` reads the mark again after the
    removal, as two separate statements would: if the newest rows were just deleted the mark
    falls, and late changes between the two marks are inserted beside the rows they should
    have replaced.
    """
    if marks not in ("one", "two"):
        raise ValueError(f"marks must be 'one' or 'two', not {marks!r}")
    mark = high_watermark(latest)
    if marks == "two":
        survivors = delete_changed(latest, changed_keys(changes, spec, mark), spec)
        state = changed_since(changes, spec, high_watermark(survivors))
        return insert_changed(survivors, state, spec)
    columns = [*spec.columns, "ts"]
    held = latest.select(*spec.key, F.struct(*columns).alias("__held"))
    state = changed_since(changes, spec, mark).select(
        *(F.col("record")[k].alias(k) for k in spec.key),
        F.struct("record.*", "ts").alias("__new"),
        F.coalesce(F.col("op") != DELETE, F.lit(False)).alias("__live"),
    )
    joined = held.join(state, list(spec.key), "full_outer")
    joined = joined.where(F.coalesce("__live", F.lit(True)))
    return joined.select(F.coalesce("__new", "__held").alias("row")).select("row.*")
