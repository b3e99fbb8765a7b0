"""All captured tables of a database, by name: change logs, latest views, latest tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.latest import create_latest_view
from tidemark.operators.reconcile import reconcile
from tidemark.schema import TableSpec
from tidemark.sources.changes import (
    create_change_table,
    create_namespace,
    read_changes,
    sync_partitions,
)
from tidemark.store import LatestStore
from tidemark.streaming.converge import INTERVAL_S, MAX_TRIES, converge
from tidemark.streaming.landing import AVAILABLE_NOW
from tidemark.streaming.refresh import incremental_stream


class ChangeCatalog:
    """Change logs below ``root`` and what is derived from them, in three schemas.

    ``logs.<table>`` is the change log that the landing job writes to ``root/<table>``,
    ``views.<table>`` its latest state, deletes included, and ``latest.<table>`` the stored
    table of live rows. ``root/_progress`` holds how far each latest table has read its log; a
    table that is made anew reads it from the start. ``buckets`` may be given for each table by
    name. Further options go to each :class:`LatestStore`.
    """

    def __init__(
        self,
        spark: SparkSession,
        specs: Iterable[TableSpec],
        root: str,
        logs: str = "cdc",
        views: str = "views",
        latest: str = "latest",
        locations: Mapping[str, str] | None = None,
        buckets: int | Mapping[str, int] | None = None,
        **store_options,
    ) -> None:
        self.spark, self.specs, self.root = spark, list(specs), root.rstrip("/")
        self.logs, self.views, self.latest = logs, views, latest
        for schema in (logs, views, latest):
            create_namespace(spark, schema, (locations or {}).get(schema))
        sizes = buckets if isinstance(buckets, Mapping) else dict.fromkeys(
            (spec.name for spec in self.specs), buckets
        )
        self.stores = {
            spec.name: LatestStore(
                spark, spec, latest, buckets=sizes.get(spec.name), **store_options
            )
            for spec in self.specs
        }

    def changes(self, spec: TableSpec) -> DataFrame:
        return self.spark.table(f"{self.logs}.{spec.name}")

    def create(self) -> None:
        """Create the change-log tables, the views and the latest tables that do not exist."""
        for spec in self.specs:
            log = f"{self.logs}.{spec.name}"
            create_change_table(self.spark, log, spec, f"{self.root}/{spec.name}")
            create_latest_view(self.spark, f"{self.views}.{spec.name}", log, spec)
            if not self.stores[spec.name].exists():
                self._advance(spec)
                # nothing may have landed yet
                self.stores[spec.name].bootstrap(self.changes(spec).limit(0))

    def refresh(self) -> None:
        """Bring every latest table up to date with what has landed; old files are not read."""
        for spec in self.specs:
            log = f"{self.logs}.{spec.name}"
            sync_partitions(self.spark, log)
            self.spark.catalog.refreshTable(log)
            self._advance(spec)

    def _advance(self, spec: TableSpec) -> None:
        log = read_changes(self.spark, f"{self.root}/{spec.name}", spec, streaming=True)
        store = self.stores[spec.name]
        incremental_stream(
            log,
            store,
            f"{self.root}/_progress/{store.name}.{store.identity()}",
            trigger=AVAILABLE_NOW,
        ).awaitTermination()

    def report(self, source_tables: Mapping[str, DataFrame]) -> DataFrame:
        """Reconciliation of every latest table with its source."""
        return reconcile(
            (spec, source_tables[spec.name], self.stores[spec.name].read()) for spec in self.specs
        )

    def converge(
        self,
        source_tables: Mapping[str, DataFrame],
        max_tries: int = MAX_TRIES,
        interval_s: float = INTERVAL_S,
    ) -> DataFrame:
        """Refresh until every table agrees with its source; fail after the last try."""

        def step() -> DataFrame:
            self.refresh()
            return self.report(source_tables)

        return converge(step, self.specs, max_tries, interval_s)
