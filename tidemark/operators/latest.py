"""Latest state: the newest change of every key."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.envelope import (
    EPOCH,
    MILLISECOND,
    Mark,
    after_mark,
    change_record,
    change_ts,
    key_columns,
    order_expressions,
    order_values,
)
from tidemark.schema import DELETE, TableSpec


def with_record(changes: DataFrame) -> DataFrame:
    """The changes with the row they are about as a ``record`` struct."""
    return changes.withColumn("record", change_record())


def newest_changes(
    changes: DataFrame, spec: TableSpec, keys: Mapping[str, Column] | None = None
) -> DataFrame:
    """The newest change of every key: ``record``, ``op``, ``ts_ms``, its key and its order.

    Key and order columns are ``__key0``.. and ``__seq0``..; ``keys`` may give other columns that
    tell keys apart. The result stays partitioned by them, so that a join on them needs no other
    shuffle.

    ``row_number = 1`` is planned as a group limit before and after the shuffle, so a map
    task sends at most one row per key: a key with a third of the log costs no more to
    shuffle than any other. The record is formed first, so one image is sorted and sent, not
    two; the fields of ``source`` and ``transaction`` that do not decide are not read.
    """
    keys = keys or {f"__key{i}": c for i, c in enumerate(key_columns(spec))}
    seqs = {f"__seq{i}": c for i, c in enumerate(order_values(spec))}
    ranked = changes.select(
        change_record().alias("record"),
        "op",
        "ts_ms",
        *(c.alias(name) for name, c in {**keys, **seqs}.items()),
    )
    newest = Window.partitionBy(*keys).orderBy(
        *(F.desc_nulls_last(c) for c in ("ts_ms", *seqs))
    )
    return (
        ranked.withColumn("__rank", F.row_number().over(newest))
        .where(F.col("__rank") == 1)
        .drop("__rank")
    )


def latest_state(changes: DataFrame, spec: TableSpec, since: Mark | None = None) -> DataFrame:
    """One row (``record``, ``op``, ``ts``) per key, deletes included.

    ``since`` keeps only keys whose newest change is later than the mark. It is applied
    before ranking, where it prunes the scan: the newest change of a key passes the filter if
    any change of the key does, and a NULL time fails it either way.
    """
    if since is not None:
        changes = after_mark(changes, since)
    return newest_changes(changes, spec).select("record", "op", change_ts().alias("ts"))


def live_rows(state: DataFrame) -> DataFrame:
    """State without deleted keys. A NULL operation fails the test and so counts as a delete."""
    return state.where(F.col("op") != DELETE)


def live(state: DataFrame) -> DataFrame:
    """Live rows of a state, flat: the record columns and ``ts``."""
    return live_rows(state).select("record.*", "ts")


def latest_columns(latest: DataFrame, spec: TableSpec) -> DataFrame:
    """Record columns of the latest table, without ``ts``."""
    return latest.select(*spec.columns)


def create_latest_view(spark: SparkSession, view: str, table: str, spec: TableSpec) -> None:
    """Create or replace a catalog view that gives the latest state of a change-log table."""

    def field(image: str, column: str) -> str:
        return f"{image}.`{column}`"

    keys = ", ".join(
        f"IF(after IS NOT NULL, {field('after', k)}, {field('before', k)})" for k in spec.key
    )
    newest_first = ", ".join(
        f"{expr} DESC NULLS LAST"
        for expr in ("ts_ms", *order_expressions(spec))
    )
    spark.sql(
        f"""CREATE OR REPLACE VIEW {view} AS
        SELECT record, op, {EPOCH} + {MILLISECOND} * ts_ms AS ts
        FROM (SELECT coalesce(after, before) AS record, op, ts_ms,
                     row_number() OVER (PARTITION BY {keys} ORDER BY {newest_first}) AS age
              FROM {table})
        WHERE age = 1"""
    )
