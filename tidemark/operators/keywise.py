"""Key-wise refresh: every key carries its own position, so late and tied changes are safe.

The state keeps, per key and *including deleted keys*, the newest change and its place in the
order. Without the deleted keys a late update would revive a deleted row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.envelope import change_ts, flat_key, key_columns, order_values
from tidemark.operators.latest import newest_changes
from tidemark.schema import TableSpec

STATE_COLUMNS = ["record", "op", "ts", "seq"]


def keyed_state(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Newest change per key as (``record``, ``op``, ``ts``, ``seq``), deletes included.

    ``seq`` holds what decides between changes of equal time.
    """
    return newest_changes(changes, spec).select(*_state_columns(spec))


def _state_columns(spec: TableSpec) -> list[Column]:
    seq = (F.col(f"__seq{i}").alias(f"s{i}") for i in range(len(order_values(spec))))
    return [
        F.col("record"),
        F.col("op"),
        change_ts().alias("ts"),
        F.struct(*seq).alias("seq"),
    ]


def _flat(spec: TableSpec) -> dict[str, Column]:
    """The key of a state's row."""
    return flat_key(spec, (F.col("record")[k] for k in spec.key))


def write_keyed_state(
    state: DataFrame, spec: TableSpec, table: str, buckets: int, mode: str = "errorifexists"
) -> None:
    """Write a state as a catalog table bucketed by its flat key.

    What :func:`apply_keywise` makes of such a table lies in the same buckets already and is
    written without a shuffle, a file per bucket.
    """
    names = list(_flat(spec))
    placed = state.select(*STATE_COLUMNS, *(c.alias(name) for name, c in _flat(spec).items()))
    placed.write.mode(mode).bucketBy(buckets, *names).sortBy(*names).saveAsTable(table)


def apply_keywise(state: DataFrame, changes: DataFrame, spec: TableSpec) -> DataFrame:
    """State brought up to date with ``changes``, in whatever order those arrive.

    Idempotent, so a replayed batch does no harm. The changes are reduced to one row per key
    first, and stay where that put them for the join, which meets each key at most once a
    side. Structs compare NULL as least, as the ranking does. A state written by
    :func:`write_keyed_state` is joined bucket by bucket, without moving any of it.
    """
    names = list(_flat(spec))
    keys = _flat(spec)
    if set(names) <= set(state.columns):
        keys = {name: F.col(name) for name in names}
    held = state.select(
        *(c.alias(name) for name, c in keys.items()), F.struct(*STATE_COLUMNS).alias("held")
    )
    arrived = newest_changes(changes, spec, flat_key(spec, key_columns(spec))).select(
        *names, F.struct(*_state_columns(spec)).alias("arrived")
    )
    stays = F.struct("held.ts", "held.seq") >= F.struct("arrived.ts", "arrived.seq")
    winner = F.when(F.col("arrived").isNull() | stays, F.col("held")).otherwise(F.col("arrived"))
    return (
        held.join(arrived, names, "full_outer")
        .select(winner.alias("winner"))
        .select("winner.*")
    )
