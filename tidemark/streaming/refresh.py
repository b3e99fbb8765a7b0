"""Periodic refresh of the latest table from the stream of changes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.store import LatestStore
from tidemark.streaming.landing import EVERY_MINUTE


def incremental_stream(
    changes: DataFrame,
    store: LatestStore,
    checkpoint: str,
    trigger: Mapping[str, object] = EVERY_MINUTE,
) -> StreamingQuery:
    """Refresh ``store`` with every batch of a stream of changes.

    The checkpoint remembers which files were read, so a batch costs what is new in the log
    and not the log. Batches are named by stream and number, so the one that was in flight
    at a crash is applied once.
    """

    def refresh(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        stream = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        store.refresh(batch, epoch=f"{stream}/{number}")

    return (
        changes.writeStream.foreachBatch(refresh)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
