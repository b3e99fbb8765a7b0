"""Landing job: change messages to partitioned Parquet."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.schema import TableSpec
from tidemark.session import exists
from tidemark.sources.changes import BATCH, write_changes
from tidemark.sources.messages import decode_envelope

# Topics are named server.database.table; the group is the table.
TOPIC_PATTERN = r"^[^.]+\.[^.]+\.(.*)$"
# Start what has arrived and stop, or keep running at an interval.
AVAILABLE_NOW: Mapping[str, object] = {"availableNow": True}
EVERY_MINUTE: Mapping[str, object] = {"processingTime": "60 seconds"}
#: Bytes of shuffled envelopes that make one file, about.
FILE_BYTES = 256 << 20


def land_changes(
    messages: DataFrame,
    spec: TableSpec,
    path: str,
    checkpoint: str,
    **options,
) -> StreamingQuery:
    """Append the changes of one table to ``path`` as ``batch=N/partition=P`` Parquet files.

    See :func:`land_topics`, which this is for one table.
    """
    return _start(messages, {spec: path.rstrip("/")}, checkpoint, **options)


def land_topics(
    messages: DataFrame,
    specs: Iterable[TableSpec],
    path: str,
    checkpoint: str,
    **options,
) -> StreamingQuery:
    """Land several tables by one query, each below ``path`` by name.

    ``messages`` is a stream of (``topic``, ``partition``, ``value``). Each batch is read once,
    decoded for one table after the other, and written to a folder ``batch=N`` of each. A batch
    that is run again after a failure writes its folders anew, but for those that were complete,
    so that every change lands once and no folder changes once it is complete. A landing folder
    belongs to one checkpoint: another one would count its batches from 0 again, which is an error.

    Files have sizes rather than counts: the rows of a batch are rebalanced by broker partition,
    so that small ones are joined and a busy one is parted. Options:

    ``topic_pattern``: its group is the table's name. ``trigger``: when to run. ``file_bytes``:
    bytes of a file, about, before compression. ``max_records``: rows of a file at most.
    ``by_day``: parts each batch by day of change too. ``compression``; ``fmt`` and
    ``avro_schemas``: see :func:`~tidemark.sources.messages.decode_envelope`.
    """
    return _start(messages, {s: f"{path.rstrip('/')}/{s.name}" for s in specs}, checkpoint, **options)


def _start(
    messages: DataFrame,
    targets: Mapping[TableSpec, str],
    checkpoint: str,
    topic_pattern: str = TOPIC_PATTERN,
    trigger: Mapping[str, object] = EVERY_MINUTE,
    file_bytes: int = FILE_BYTES,
    max_records: int | None = None,
    by_day: bool = False,
    compression: str = "gzip",
    fmt: str = "json",
    avro_schemas: Mapping[int, str] | None = None,
) -> StreamingQuery:
    spark = messages.sparkSession
    if not exists(spark, f"{checkpoint}/metadata"):
        held = [path for path in targets.values() if exists(spark, f"{path}/{BATCH}=0")]
        if held:
            raise ValueError(f"{held} were landed by another checkpoint than {checkpoint}")
    table = F.regexp_extract("topic", topic_pattern, 1)
    wanted = messages.where(
        F.col("value").isNotNull() & table.isin([spec.name for spec in targets])
    ).select("topic", "partition", "value")

    def write(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        # off in streams; it is what makes files by size, and the session is the stream's own
        session.conf.set("spark.sql.adaptive.enabled", "true")
        session.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(file_bytes))
        todo = {s: f"{path}/{BATCH}={number}" for s, path in targets.items()}
        todo = {s: path for s, path in todo.items() if not exists(session, f"{path}/_SUCCESS")}
        shared = len(todo) > 1
        if shared:  # tables share one read of the source
            batch = batch.persist(StorageLevel.DISK_ONLY)
        try:
            for spec, path in todo.items():
                own = batch.where(table == spec.name)
                changes = decode_envelope(own, spec, fmt, avro_schemas)
                write_changes(
                    changes.hint("rebalance", "partition"),
                    path,
                    "overwrite",
                    by_day=by_day,
                    compression=compression,
                    max_records=max_records,
                )
        finally:
            if shared:
                batch.unpersist()

    return (
        wanted.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
