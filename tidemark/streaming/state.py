"""The latest state kept by Spark's own streaming state.

A streaming aggregate holds the newest change of every key in the state store, and that is all the
state there is: no table is rewritten, a batch touches the keys that it brings, and the state's
versions and files are Spark's affair. The state itself can be read as a table at any time.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import session
from tidemark.functions.envelope import (
    change_record,
    change_ts,
    flat_key,
    key_columns,
    order_values,
)
from tidemark.schema import TableSpec
from tidemark.streaming.landing import EVERY_MINUTE

# State on executors' disks rather than in their memory; a batch uploads what it changed.
ROCKSDB: Mapping[str, str] = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming."
    "state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

Sink = Callable[[DataFrame, int], None]


def newest_by_key(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """The newest change of every key as an aggregate: ``newest`` beside the flat key columns.

    Works on a stream, where ranking does not. NULLs in the order are least, as in the ranking.
    """
    order = [c.alias(f"s{i}") for i, c in enumerate(order_values(spec))]
    keys = flat_key(spec, key_columns(spec))
    changed = changes.select(
        *(c.alias(name) for name, c in keys.items()),
        F.struct(change_record().alias("record"), "op", "ts_ms").alias("change"),
        F.struct("ts_ms", *order).alias("place"),
    )
    return changed.groupBy(*keys).agg(F.max_by("change", "place").alias("newest"))


def latest_stream_state(
    changes: DataFrame,
    spec: TableSpec,
    checkpoint: str,
    sink: Sink | None = None,
    trigger: Mapping[str, object] = EVERY_MINUTE,
    settings: Mapping[str, str] = ROCKSDB,
) -> StreamingQuery:
    """Keep the newest change of every key, deletes included, in the state of a streaming query.

    Each key carries its own place in the order, so late and tied changes and replays are safe in
    any arrival order, and a late update does not revive a deleted row. A map task sends the newest
    change of each key it has read, so a hot key is no hotter than others. ``sink`` is called with
    (``record``, ``op``, ``ts``) of the keys that a batch changed or repeated, and the batch's
    number; a batch may be handed over twice. The number of state partitions is that of
    ``spark.sql.shuffle.partitions`` at the first start and stays. Read the state with
    :func:`read_stream_state`.
    """
    newest = newest_by_key(changes, spec).select(
        "newest.record", "newest.op", change_ts(F.col("newest.ts_ms")).alias("ts")
    )
    writer = (
        newest.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
    )
    with session.settings(changes.sparkSession, settings):
        if sink is None:
            return writer.format("noop").start()
        return writer.foreachBatch(sink).start()


def read_stream_state(
    spark: SparkSession,
    checkpoint: str,
    batch: int | None = None,
    settings: Mapping[str, str] = ROCKSDB,
) -> DataFrame:
    """State (``record``, ``op``, ``ts``) after the last batch of a stream, or after ``batch``.

    The stream may go on meanwhile; a reader sees one batch's state. ``settings`` are those that
    the stream was started with.
    """
    reader = spark.read.format("statestore")
    if batch is not None:
        reader = reader.option("batchId", batch)
    with session.settings(spark, settings):
        held = reader.load(checkpoint)
    # the buffer of max_by: the value, and what it was greatest by
    newest = F.col("value.valueWithExtremumOrdering")
    return held.select(
        newest["record"].alias("record"), newest["op"].alias("op"), change_ts(newest["ts_ms"]).alias("ts")
    )
