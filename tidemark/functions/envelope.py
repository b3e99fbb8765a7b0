"""Column expressions over change envelopes: record, key, time and order.

All of them are built-in expressions, so they stay inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schema import TableSpec

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"
MILLISECOND = "interval '0.001' second"
# High-water mark of an empty table. Year 1, since Python cannot represent year 0.
FLOOR_TS = "timestamp_ntz'0001-01-01 00:00:00'"

LOG_FILE = "source.file"

Mark = DataFrame | Column | datetime | int


def change_record() -> Column:
    """The row a change is about: its new image, or the old one where a delete left no new one.

    Coalesces the struct as a whole. Coalescing field by field would revive the old value of
    a column that an update set to NULL.
    """
    return F.coalesce(F.col("after"), F.col("before"))


def key_columns(spec: TableSpec) -> list[Column]:
    """The key of a change, one column per key field.

    Equal to the field of :func:`change_record`, but reads only the key leaves of the two
    images: Parquet column pruning does not see through a coalesce of structs.
    """
    return [
        F.when(F.col("after").isNotNull(), F.col("after")[k]).otherwise(F.col("before")[k])
        for k in spec.key
    ]


def flat_key(spec: TableSpec, parts: Iterable[Column]) -> dict[str, Column]:
    """Key columns without NULL: a stand-in for each NULL part, and a mask of which parts are.

    Such keys are equal if and only if the parts are, NULLs included, so an ordinary equi-join
    meets them, and a table can be bucketed by them.
    """
    parts = dict(zip(spec.key, parts, strict=True))
    flat, mask = {}, F.lit(0)
    for i, (name, part) in enumerate(parts.items()):
        kind = spec.record[name].dataType
        dated = isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType))
        stand_in = F.lit("1970-01-01" if dated else "0").cast(kind)
        flat[f"__key{i}"] = F.coalesce(part, stand_in)
        mask = mask + F.when(part.isNull(), 1 << i).otherwise(0)
    return {**flat, "__nulls": mask}


def order_values(spec: TableSpec) -> list[Column]:
    """What decides between changes of one key and one ``ts_ms``, most significant first.

    The log position, then a hash of the change: the hash is reached only on a full tie, and
    then any order will do as long as it is the same on every run.
    """
    return [F.expr(x) for x in order_expressions(spec)]


def order_expressions(spec: TableSpec) -> list[str]:
    """The same as SQL.

    Log files are numbered, and a number outgrows its leading zeros: of two names the longer
    is the later, so ``binlog.1000000`` follows ``binlog.999999``.
    """
    place = [
        x for c in spec.tiebreak for x in ([f"length({c})", c] if c == LOG_FILE else [c])
    ]
    return [*place, "xxhash64(coalesce(after, before), op)"]


def change_order(spec: TableSpec) -> list[Column]:
    """Newest-first order of the changes of one key."""
    return [c.desc_nulls_last() for c in (F.col("ts_ms"), *order_values(spec))]


def change_ts(ts_ms: Column | str = "ts_ms") -> Column:
    """Epoch milliseconds as a UTC wall clock without zone.

    Epoch plus an interval never passes through the session time zone, so hours that a
    daylight-saving change repeats come out right.
    """
    ts_ms = F.col(ts_ms) if isinstance(ts_ms, str) else ts_ms
    return F.expr(EPOCH) + F.expr(MILLISECOND) * ts_ms


def epoch_millis(ts: Column | str = "ts") -> Column:
    """Inverse of :func:`change_ts`."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.call_function("div", ts - F.expr(EPOCH), F.expr(MILLISECOND))


def mark_millis(mark: Mark) -> Column:
    """A high-water mark as epoch milliseconds, comparable with the stored ``ts_ms``.

    Comparing the raw ``ts_ms`` lets the filter reach the Parquet scan. A one-row DataFrame
    (see ``high_watermark``) becomes a scalar subquery, which Spark evaluates first and
    pushes down as a literal.
    """
    if isinstance(mark, DataFrame):
        return mark.select(epoch_millis("ts").alias("mark_ms")).scalar()
    if isinstance(mark, int):
        return F.lit(mark).cast("bigint")
    if isinstance(mark, datetime):
        if mark.tzinfo is not None:
            raise ValueError("a mark is a UTC wall clock without zone")
        mark = F.lit(mark.isoformat(sep=" ")).cast("timestamp_ntz")
    return epoch_millis(mark)


DAY_MS = 86_400_000


def change_day(ts_ms: Column | str = "ts_ms") -> Column:
    """The UTC day of a change, counted from the epoch. Later times never have earlier days."""
    ts_ms = F.col(ts_ms) if isinstance(ts_ms, str) else ts_ms
    return F.floor(ts_ms / DAY_MS).cast("int")


def after_mark(changes: DataFrame, mark: Mark) -> DataFrame:
    """Changes strictly later than the mark.

    A log laid out by day is filtered by its ``day`` too, so that folders of earlier days are not
    opened. The mark may be a query: it runs first, and the folders are chosen by what it gives.
    """
    millis = mark_millis(mark)
    later = changes.where(F.col("ts_ms") > millis)
    if "day" in changes.columns:
        later = later.where(F.col("day") >= change_day(millis))
    return later
