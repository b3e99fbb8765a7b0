"""The durable latest table.

A plain Parquet table cannot delete rows, and Spark will not overwrite a table it is reading.
So the latest table is a catalog view over immutable tables, all bucketed by key:

* a *base*: the state of every key when it was written;
* *deltas*: the newest state of every key that a refresh found changed, deletes included.

Deleted keys stay as rows that the view leaves out, so that an older change that arrives later
does not revive them. The view takes each key from the newest part that has it. A
refresh writes one more delta, whose size follows the changes and not the table, and switches
readers over by replacing the view. Deltas of like size are merged, so that there are few of
them and a row is rewritten a few times, not once per refresh; when together they pass a share
of the base, everything is merged into a new base. Equal bucketing lets both the view and the
merges join without a shuffle. The view lives in the session's catalog, which has to be a
persistent one to outlive the session.

Where an Iceberg or Delta catalog is at hand, :func:`merge_into` updates its table in place
instead.
"""

from __future__ import annotations

import re
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.envelope import FLOOR_TS, change_ts, epoch_millis
from tidemark.operators.delta import newer_than
from tidemark.operators.latest import newest_changes
from tidemark.schema import DELETE, TableSpec
from tidemark.sources.changes import create_namespace

OP, SEQ = "__op", "__seq"
RETIRED = "tidemark.retired"

# A delta is merged with the later ones once they hold a third of their common rows.
MERGE_RATIO = 2

# How long replaced tables stay for their readers.
RETAIN_MS = 3_600_000

ROWS_PER_BUCKET = 5_000_000
# Spark's own bound, see spark.sql.sources.bucketing.maxBuckets
MAX_BUCKETS = 100_000


def buckets_for(rows: int) -> int:
    """Buckets for a table that is to hold about so many rows."""
    return min(max(-(-rows // ROWS_PER_BUCKET), 1), MAX_BUCKETS)


class LatestStore:
    """The latest table of one spec as the view ``schema.name``.

    ``keywise`` selects the refresh: from the table's high-water mark (default), which skips
    late changes, or key by key, which is safe for late and tied changes. Either way a change
    older than the delete of its key, whenever that came, does not revive the row. Events that
    carry no key belong to no row, and the key-wise store leaves them out.

    ``buckets`` fixes the layout, see :func:`buckets_for`; it defaults to the session's number
    of shuffle partitions. Layout and mode are noted with the table: another session takes
    the buckets from there, and is refused if it asks for others or for the other mode.

    ``keep_deleted_ms`` lets the store forget deleted keys. Changes that are older by more than
    that than the newest change of all earlier refreshes are then skipped, whatever their key,
    so a forgotten key cannot be told from a remembered one. By default nothing is forgotten.

    A table that a refresh replaces is dropped by a refresh ``retain_ms`` later or more, so a
    reader has that long to finish.
    """

    def __init__(
        self,
        spark: SparkSession,
        spec: TableSpec,
        schema: str,
        location: str | None = None,
        buckets: int | None = None,
        keywise: bool = False,
        rewrite_share: float = 0.1,
        keep_deleted_ms: int | None = None,
        retain_ms: int = RETAIN_MS,
    ) -> None:
        self.spark, self.spec, self.schema = spark, spec, schema
        self.keywise = keywise
        self.rewrite_share = rewrite_share
        self.keep_deleted_ms = keep_deleted_ms
        self.retain_ms = retain_ms
        self._next_id = uuid.uuid4().hex[:12]
        create_namespace(spark, schema, location)
        noted = self.properties() if self.exists() else {}
        if noted.get("keywise", str(keywise)) != str(keywise):
            raise ValueError(f"{self.name} was made with keywise={noted['keywise']}")
        if buckets and noted.get("buckets", str(buckets)) != str(buckets):
            raise ValueError(f"{self.name} has {noted['buckets']} buckets, not {buckets}")
        self.buckets = int(
            noted.get("buckets") or buckets or spark.conf.get("spark.sql.shuffle.partitions")
        )

    @property
    def name(self) -> str:
        return f"{self.schema}.{self.spec.name}"

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        """Live rows: record columns and ``ts``."""
        return self.spark.table(self.name)

    def properties(self) -> dict[str, str]:
        return {
            r["key"].removeprefix("tidemark."): r["value"]
            for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()
            if r["key"].startswith("tidemark.")
        }

    def identity(self) -> str:
        """Noted with the table, and never given to another, be it of the same name.

        Of a missing table, the one it will have if this store makes it.
        """
        if not self.exists():
            return self._next_id
        return self.properties().get("id") or self._note("id", self._next_id)

    def bootstrap(self, changes: DataFrame, epoch: str | None = None) -> bool:
        """Create the table from the log; does nothing, and says so, when it exists."""
        if self.exists():
            return False
        table = self._write(self._rows(changes), "base", self._ranked_in_buckets())
        rows, newest_ms = self._size_and_newest(table)
        self._publish(table, rows, [], None, newest_ms, epoch)
        return True

    def refresh(self, changes: DataFrame, epoch: str | None = None) -> None:
        """Bring the table up to date.

        ``epoch`` names the batch; the batch that was applied last is not applied again.
        """
        if self.bootstrap(changes, epoch):
            return
        held = self.properties()
        if epoch is not None and held.get("epoch") == epoch:
            return
        fresh = self._write(self._arrivals(changes, held), "fresh", self._ranked_in_buckets())
        n_rows, newest_ms = self._size_and_newest(fresh)
        if n_rows == 0:
            if epoch is not None:
                self._note("epoch", epoch)
            self.spark.sql(f"DROP TABLE {fresh}")
            return
        mark_ms = None if self.keywise else self._mark_after(fresh, int(held["mark_ms"]))
        newest_ms = max(newest_ms, int(held["newest_ms"]))
        deltas = [*_deltas(held), (fresh, n_rows)]
        base_rows = int(held["base_rows"])
        if sum(rows for _, rows in deltas) > self.rewrite_share * base_rows:
            merged = self._merged([held["base"], *(table for table, _ in deltas)])
            if self.keep_deleted_ms is not None:
                # what is forgotten is older than any change that a later refresh takes
                kept = epoch_millis("ts") >= newest_ms - self.keep_deleted_ms
                merged = merged.where(~_deleted() | F.coalesce(kept, F.lit(False)))
            table = self._write(merged, "base", True)
            rows, _ = self._size_and_newest(table)
            self._publish(table, rows, [], mark_ms, newest_ms, epoch)
        else:
            self._publish(
                held["base"], base_rows, self._tidied(deltas), mark_ms, newest_ms, epoch
            )
        self._retire(held)

    def _size_and_newest(self, table: str) -> tuple[int, int]:
        """Rows of a part and the time of its newest change, deletes included."""
        newest = epoch_millis(F.coalesce(F.max("ts"), F.expr(FLOOR_TS)))
        return tuple(self.spark.table(table).agg(F.count("*"), newest).first())

    def _mark_after(self, fresh: str, mark_ms: int) -> int | None:
        """The mark once ``fresh`` is applied; None if the whole table has to tell.

        The newest live arrival is the new mark. Without one the mark stands, unless the
        arrivals remove a row that stands at it; only the rows at the mark are read for that.
        """
        arrived = self.spark.table(fresh)
        newest = arrived.where(~_deleted()).agg(epoch_millis(F.max("ts"))).first()[0]
        if newest is not None:
            return newest
        at_mark = self.read().where(F.col("ts") == change_ts(F.lit(mark_ms).cast("bigint")))
        removed = at_mark.join(arrived, list(self.spec.key), "left_semi").limit(1).count()
        return None if removed else mark_ms

    def _rows(self, changes: DataFrame) -> DataFrame:
        """Rows to store for a log: the record, ``ts``, and what a refresh has to know.

        The key is the one the changes were ranked by, whose partitioning the rows still have.
        """
        newest = newest_changes(changes, self.spec)
        keys = {k: F.col(f"__key{i}") for i, k in enumerate(self.spec.key)}
        if self.keywise:
            newest = newest.dropna(subset=[f"__key{i}" for i in range(len(keys))])
        seqs = [c for c in newest.columns if c.startswith("__seq")]
        bookkeeping = [F.col("op").alias(OP), F.struct(*seqs).alias(SEQ)]
        return newest.select(
            *(keys.get(c, F.col("record")[c]).alias(c) for c in self.spec.columns),
            change_ts().alias("ts"),
            *bookkeeping,
        )

    def _arrivals(self, changes: DataFrame, held: dict[str, str]) -> DataFrame:
        """Stored rows for the keys that these changes move on."""
        if self.keep_deleted_ms is not None:
            changes = newer_than(changes, int(held["newest_ms"]) - self.keep_deleted_ms - 1)
        if not self.keywise:
            changes = newer_than(changes, int(held["mark_ms"]))
        # the bucketed parts are joined one by one, so that none is shuffled; the place in
        # the order is all that is read of them
        key, places = list(self.spec.key), []
        arrived = self._rows(changes)
        for i, table in enumerate([held["base"], *(table for table, _ in _deltas(held))]):
            part = self.spark.table(table)
            if not self.keywise:
                # live rows are not newer than the mark: only deletes can outrank an arrival
                after = F.col("ts") > change_ts(F.lit(int(held["mark_ms"])).cast("bigint"))
                part = part.where(_deleted() & after)
            place = part.select(*key, F.struct("ts", SEQ).alias(f"__part{i}"))
            arrived = arrived.join(place, key, "left")
            places.insert(0, F.col(f"__part{i}"))
        # later parts hold later places of a key
        last = F.coalesce(*places)
        newer = last.isNull() | (F.struct("ts", SEQ) > last)
        return arrived.where(newer).drop(*(f"__part{i}" for i in range(len(places))))

    def _tidied(self, deltas: list[tuple[str, int]]) -> list[tuple[str, int]]:
        """The deltas with the last of them merged, as far back as they are of like size."""
        first, rows = len(deltas) - 1, deltas[-1][1]
        while first and deltas[first - 1][1] <= MERGE_RATIO * rows:
            first -= 1
            rows += deltas[first][1]
        if first == len(deltas) - 1:
            return deltas
        merged = self._write(self._merged([t for t, _ in deltas[first:]]), "delta", True)
        return [*deltas[:first], (merged, self.spark.table(merged).count())]

    def _newest_of(self, parts: list[str], columns: str = "p.*", hint: bool = False) -> list[str]:
        """A query per part, for the rows of the keys that no later part has.

        ``hint`` asks for merge joins, which keep the rows of a bucket together.
        """
        queries = []
        for i, part in enumerate(parts):
            later = {f"p{j}": table for j, table in enumerate(parts[i + 1 :], start=i + 1)}
            keys = {
                p: " AND ".join(f"p.`{k}` = {p}.`{k}`" for k in self.spec.key) for p in later
            }
            hinted = f"/*+ MERGE({', '.join(later)}) */ " if hint and later else ""
            queries.append(
                f"SELECT {hinted}{columns} FROM {part} p"
                + "".join(f" LEFT ANTI JOIN {t} {p} ON {keys[p]}" for p, t in later.items())
            )
        return queries

    def _merged(self, parts: list[str]) -> DataFrame:
        return self.spark.sql(" UNION ALL ".join(self._newest_of(parts, hint=True)))

    def _write(self, rows: DataFrame, kind: str, bucketed: bool) -> str:
        """Write a new bucketed table under a name no earlier attempt can have used.

        ``bucketed`` says that the rows already come bucket by bucket; others are brought
        together first, so that there is a file per bucket and not one per bucket and task.
        """
        table = f"{self.name}__{kind}_{uuid.uuid4().hex[:12]}"
        if not bucketed:
            rows = rows.repartition(self.buckets, *self.spec.key)
        (
            rows.write.format("parquet")
            .bucketBy(self.buckets, *self.spec.key)
            .sortBy(*self.spec.key)
            .saveAsTable(table)
        )
        return table

    def _ranked_in_buckets(self) -> bool:
        """Whether ranking by key already partitions rows the way the buckets do."""
        return int(self.spark.conf.get("spark.sql.shuffle.partitions")) == self.buckets

    def _publish(
        self,
        base: str,
        base_rows: int,
        deltas: list[tuple[str, int]],
        mark_ms: int | None,
        newest_ms: int,
        epoch: str | None,
    ) -> None:
        """Point the view at ``base`` and ``deltas``, and note the mark it stands at."""
        columns = ", ".join(f"p.`{c}`" for c in (*self.spec.columns, "ts"))
        parts = [base, *(table for table, _ in deltas)]
        query = " UNION ALL ".join(
            f"{part} WHERE p.`{OP}` <> '{DELETE}'" for part in self._newest_of(parts, columns)
        )
        if mark_ms is None and not self.keywise:
            newest = F.coalesce(F.max("ts"), F.expr(FLOOR_TS))
            mark_ms = self.spark.sql(query).agg(epoch_millis(newest)).first()[0]
        noted = {
            "id": self.identity(),
            "base": base,
            "base_rows": base_rows,
            "deltas": " ".join(f"{table}:{rows}" for table, rows in deltas),
            "epoch": epoch,
            "mark_ms": None if self.keywise else mark_ms,
            "newest_ms": newest_ms,
            "buckets": self.buckets,
            "keywise": self.keywise,
        }
        properties = ", ".join(
            f"'tidemark.{k}' = '{v}'" for k, v in noted.items() if v is not None
        )
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.name} TBLPROPERTIES ({properties}) AS {query}"
        )

        self._next_id = uuid.uuid4().hex[:12]

    def _note(self, key: str, value: str) -> str:
        self.spark.sql(f"ALTER VIEW {self.name} SET TBLPROPERTIES ('tidemark.{key}' = '{value}')")
        return value

    def _retire(self, before: dict[str, str]) -> None:
        """Mark what this refresh has replaced, and drop what was replaced long ago.

        Tables that were never part of the view are what a failed refresh left behind; they
        have no readers and go at once. One refresh at a time may run.
        """
        now = int(time.time() * 1000)
        in_use = set(_tables(self.properties()))
        for table in set(_tables(before)) - in_use:
            self.spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{RETIRED}' = '{now}')")
        ours = re.compile(re.escape(self.spec.name) + "__(base|delta|fresh)_[0-9a-f]{12}")
        tables = self.spark.sql(f"SHOW TABLES IN {self.schema} LIKE '{self.spec.name}__*'")
        for (name,) in tables.select("tableName").collect():
            table = f"{self.schema}.{name}"
            if not ours.fullmatch(name) or table in in_use:
                continue
            noted = self.spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
            retired = next((int(r["value"]) for r in noted if r["key"] == RETIRED), 0)
            if now - retired >= self.retain_ms:
                self.spark.sql(f"DROP TABLE IF EXISTS {table}")


def _deleted() -> Column:
    """A NULL operation counts as a delete."""
    return F.coalesce(F.col(OP) == DELETE, F.lit(True))


def _tables(held: dict[str, str]) -> list[str]:
    return [held["base"], *(table for table, _ in _deltas(held))]


def _deltas(held: dict[str, str]) -> list[tuple[str, int]]:
    """Delta tables and their row counts, oldest first, from the view's properties."""
    noted = (delta.rsplit(":", 1) for delta in held["deltas"].split())
    return [(table, int(rows)) for table, rows in noted]


def merge_into(state: DataFrame, target: str, spec: TableSpec) -> None:
    """Apply changed keys (``record``, ``op``, ``ts``) to a table that supports row updates."""
    flat = state.select("record.*", "ts", F.col("op").alias(OP)).alias("new")
    old = F.expr(" AND ".join(f"{target}.`{k}` = new.`{k}`" for k in spec.key))
    gone = F.coalesce(F.col(f"new.{OP}") == DELETE, F.lit(True))
    values = {c: F.col(f"new.{c}") for c in (*spec.columns, "ts")}
    (
        flat.mergeInto(target, old)
        .whenMatched(gone)
        .delete()
        .whenMatched()
        .update(values)
        .whenNotMatched(~gone)
        .insert(values)
        .merge()
    )
