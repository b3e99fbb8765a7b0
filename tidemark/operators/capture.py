"""Producing changes: statements against a source table and the events they cause."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.envelope import key_columns
from tidemark.schema import (
    CREATE,
    DELETE,
    SNAPSHOT,
    SOURCE_TYPE,
    TRANSACTION_TYPE,
    UPDATE,
    TableSpec,
    envelope_schema,
)
from tidemark.sources.tables import conform


def apply_dml(
    table: DataFrame,
    inserts: DataFrame | None = None,
    delete: Column | None = None,
    update: tuple[Column, Mapping[str, Column]] | None = None,
) -> DataFrame:
    """A table after DELETE, UPDATE and INSERT, in that order; each is optional.

    ``update`` is a predicate and the columns it sets. A predicate that is NULL for a row
    leaves the row alone.
    """
    if delete is not None:
        table = table.where(~F.coalesce(delete, F.lit(False)))
    if update is not None:
        predicate, values = update
        changed = {c: F.when(predicate, v).otherwise(F.col(c)) for c, v in values.items()}
        table = table.select(*(changed.get(c, F.col(c)).alias(c) for c in table.columns))
    if inserts is not None:
        table = table.unionByName(inserts)
    return table


def _envelope(
    images: DataFrame,
    spec: TableSpec,
    ts_ms: int | Column,
    pos: int | None,
    snapshot: bool,
    partitions: int,
) -> DataFrame:
    """Complete (``before``, ``after``, ``op``) to the full envelope."""
    known = {
        "ts_ms": F.lit(ts_ms),
        "snapshot": F.lit("true" if snapshot else "false"),
        "table": F.lit(spec.name),
        "pos": F.lit(pos),
    }
    source = F.struct(
        *(
            known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in SOURCE_TYPE.fields
        )
    )
    keys = [F.coalesce(F.col("after")[k], F.col("before")[k]) for k in spec.key]
    columns = {
        "before": F.col("before"),
        "after": F.col("after"),
        "source": source,
        "op": F.col("op"),
        "ts_ms": F.lit(ts_ms).cast("bigint"),
        "transaction": F.lit(None).cast(TRANSACTION_TYPE),
        "partition": F.pmod(F.hash(*keys), F.lit(partitions)),
    }
    return images.select(
        *(columns[f.name].alias(f.name) for f in envelope_schema(spec.record).fields)
    )


def snapshot_events(
    table: DataFrame, spec: TableSpec, ts_ms: int, pos: int | None = None, partitions: int = 1
) -> DataFrame:
    """The initial snapshot of a table: one read event per row."""
    rows = conform(table, spec)
    images = rows.select(
        F.lit(None).cast(spec.record).alias("before"),
        F.struct(*spec.columns).alias("after"),
        F.lit(SNAPSHOT).alias("op"),
    )
    return _envelope(images, spec, ts_ms, pos, True, partitions)


def capture_changes(
    old: DataFrame,
    new: DataFrame,
    spec: TableSpec,
    ts_ms: int,
    pos: int | None = None,
    partitions: int = 1,
) -> DataFrame:
    """The events that turn one snapshot of a table into another.

    The key must be unique within a snapshot, so the join meets each key at most once a side.
    """

    def image(table: DataFrame, name: str) -> DataFrame:
        return conform(table, spec).select(*spec.key, F.struct(*spec.columns).alias(name))

    before, after = F.col("before"), F.col("after")
    images = (
        image(old, "before")
        .join(image(new, "after"), list(spec.key), "full_outer")
        .where(~before.eqNullSafe(after))
        .withColumn(
            "op",
            F.when(before.isNull(), CREATE).when(after.isNull(), DELETE).otherwise(UPDATE),
        )
    )
    return _envelope(images, spec, ts_ms, pos, False, partitions)


def snapshot_with_changes(
    chunks: DataFrame,
    marks: DataFrame,
    changes: DataFrame,
    spec: TableSpec,
    chunk: Column | str,
    partitions: int = 1,
) -> DataFrame:
    """One change log from a snapshot read chunk by chunk and the changes that ran meanwhile.

    A table too large for one consistent read is read in chunks of keys, in any order and over
    any time. ``chunk`` tells a key's chunk, from columns named as the key. ``marks`` (``chunk,
    low, high``) holds for each chunk the time in epoch milliseconds just before and just after
    its rows were read, ``chunks`` the rows, and ``changes`` the log from the first low mark on.

    A row whose key changed between its chunk's marks is passed over: the log has an image of it
    that is as new or newer, or its delete. Any other row is what the table held at the low mark,
    so it becomes a read event of that time: older changes of its key come before it, all others
    after it. A chunk without marks fails the job. A key in a third of all changes is one key
    still: changed keys are made distinct before they are joined.
    """
    chunk = F.expr(chunk) if isinstance(chunk, str) else chunk
    marks = marks.select(
        F.col("chunk").alias("__chunk"), F.col("low").alias("__low"), F.col("high").alias("__high")
    )
    keys = [c.alias(k) for k, c in zip(spec.key, key_columns(spec), strict=True)]
    changed = changes.select("ts_ms", *keys).select("ts_ms", *spec.key, chunk.alias("__chunk"))
    changed = (
        changed.join(marks, "__chunk")
        .where(F.col("ts_ms").between(F.col("__low"), F.col("__high")))
        .select(*(F.col(k).alias(f"__{k}") for k in spec.key))
        .distinct()
    )
    rows = conform(chunks, spec, chunk.alias("__chunk")).join(marks, "__chunk", "left")
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in spec.key]
    fresh = rows.join(changed, same, "left_anti")
    lost = F.raise_error(F.concat(F.lit("no marks of chunk "), F.col("__chunk").cast("string")))
    images = fresh.select(
        F.lit(None).cast(spec.record).alias("before"),
        F.struct(*spec.columns).alias("after"),
        F.lit(SNAPSHOT).alias("op"),
        F.when(F.col("__low").isNull(), lost.cast("long")).otherwise(F.col("__low")).alias("__low"),
    )
    events = _envelope(images, spec, F.col("__low"), None, True, partitions)
    return changes.unionByName(events)
