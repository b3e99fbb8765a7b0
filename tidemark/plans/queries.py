"""The registered queries: every operator over whole logs of the given tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import operators as ops
from tidemark import functions as fn
from tidemark import sources, streaming
from tidemark.catalog import ChangeCatalog
from tidemark.plans import logs
from tidemark.plans.logs import BATCH_1, BATCH_2, CUSTOMER, EVENTS, ON_TIME, PART, Event, LogTable
from tidemark.schema import TableSpec, record_type
from tidemark.session import fresh_dir
from tidemark.sources import conform, create_namespace
from tidemark.store import LatestStore, buckets_for
from tidemark.streaming.landing import AVAILABLE_NOW

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SPEC = CUSTOMER.spec


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _log(spark: SparkSession, sf_dir: str, events: Sequence[Event] = EVENTS) -> DataFrame:
    return logs.change_log(spark, sf_dir, CUSTOMER, events)


def _latest_1(spark: SparkSession, sf_dir: str, log: LogTable = CUSTOMER) -> DataFrame:
    """The latest table as of batch 1."""
    return ops.live(ops.latest_state(logs.change_log(spark, sf_dir, log, BATCH_1), log.spec))


def _refreshed(spark: SparkSession, sf_dir: str, log: LogTable = CUSTOMER) -> DataFrame:
    """The latest table of batch 1 after a refresh from the whole log."""
    whole = logs.change_log(spark, sf_dir, log)
    return ops.apply_delta(_latest_1(spark, sf_dir, log), whole, log.spec)


def _truth(spark: SparkSession, sf_dir: str, log: LogTable = CUSTOMER) -> DataFrame:
    """The source table: what the whole log, late changes included, amounts to."""
    state = ops.latest_state(logs.change_log(spark, sf_dir, log), log.spec)
    return ops.latest_columns(ops.live(state), log.spec)


def _landed(changes: DataFrame) -> str:
    path = fresh_dir(changes.sparkSession, "log")
    sources.write_changes(changes, path)
    return path


def _namespace(spark: SparkSession, purpose: str) -> str:
    """A schema of its own for the tables of one run."""
    location = fresh_dir(spark, purpose)
    name = location.rsplit("/", 1)[1].replace("-", "_")
    create_namespace(spark, name, location)
    return name


def _store(spark: SparkSession, sf_dir: str, log: LogTable = CUSTOMER, **options) -> LatestStore:
    """An empty store for the log's table, laid out for the size of that table."""
    rows = logs.given(spark, sf_dir, log.table).count()
    namespace = _namespace(spark, "latest")
    return LatestStore(spark, log.spec, namespace, buckets=buckets_for(rows), **options)


# Change logs: scan, catalog, landing, decoding.


@query
def change_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the log as landed files and scan it."""
    return _scanned(sources.read_changes(spark, _landed(_log(spark, sf_dir)), SPEC))


def _scanned(changes: DataFrame) -> DataFrame:
    return changes.select(
        "op",
        "ts_ms",
        F.col("source.pos").alias("pos"),
        "partition",
        F.col("before.id").alias("before_id"),
        F.col("after.id").alias("after_id"),
    )


@query
def compact_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log after it was rewritten into fewer files."""
    target = fresh_dir(spark, "compact")
    sources.compact_log(spark, _landed(_log(spark, sf_dir)), SPEC, target)
    return _scanned(sources.read_changes(spark, target, SPEC))


@query
def partition_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table created over an empty folder finds the partitions landed later."""
    path = fresh_dir(spark, "log")
    table = f"{_namespace(spark, 'cdc')}.customer"
    sources.create_change_table(spark, table, SPEC, path)
    sources.write_changes(_log(spark, sf_dir), path)
    sources.sync_partitions(spark, table)
    return spark.table(table).groupBy("partition").agg(F.count("*").alias("n"))


def _message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream over the messages of both tables, and some broker tombstones (NULL values)."""
    path = fresh_dir(spark, "messages")
    for log in (CUSTOMER, PART):
        messages = sources.encode_envelope(logs.change_log(spark, sf_dir, log), log.topic)
        tombstones = messages.select(
            "topic", "partition", F.lit(None).cast("string").alias("value")
        )
        messages.unionByName(tombstones).write.mode("append").parquet(path)
    return spark.readStream.schema("topic STRING, partition INT, value STRING").parquet(path)


def _landed_columns() -> list:
    return [
        "op",
        "ts_ms",
        F.col("source.pos").alias("pos"),
        "partition",
        fn.key_columns(SPEC)[0].alias("id"),
    ]


@query
def land_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream the messages of one table into the landing folder and read it back."""
    path = fresh_dir(spark, "landing")
    streaming.land_changes(
        _message_stream(spark, sf_dir),
        SPEC,
        path,
        fresh_dir(spark, "progress"),
        trigger=AVAILABLE_NOW,
    ).awaitTermination()
    return sources.read_changes(spark, path, SPEC).select(*_landed_columns())


@query
def land_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream the messages of two tables, each into a folder of its own."""
    path = fresh_dir(spark, "landing")
    specs = [CUSTOMER.spec, PART.spec]
    streaming.land_topics(
        _message_stream(spark, sf_dir),
        specs,
        path,
        fresh_dir(spark, "progress"),
        trigger=AVAILABLE_NOW,
    ).awaitTermination()
    landed = [
        (spec.name, sources.read_changes(spark, f"{path}/{spec.name}", spec)) for spec in specs
    ]
    return reduce(
        DataFrame.unionByName,
        (rows.select(F.lit(name).alias("name"), *_landed_columns()) for name, rows in landed),
    )


@query
def compact_live_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log by name, compacted between the batches of its landing job and after them."""
    path, messages, progress = (fresh_dir(spark, x) for x in ("landing", "messages", "progress"))
    name = f"{_namespace(spark, 'live')}.customer"
    live = None
    for batch in (BATCH_1, BATCH_2[:2], BATCH_2[2:]):
        arrived = sources.encode_envelope(_log(spark, sf_dir, batch), CUSTOMER.topic)
        arrived.write.mode("append").parquet(messages)
        stream = spark.readStream.schema("topic STRING, partition INT, value STRING")
        streaming.land_changes(
            stream.parquet(messages), SPEC, path, progress, trigger=AVAILABLE_NOW
        ).awaitTermination()
        live = live or sources.LiveLog(spark, name, SPEC, path, fresh_dir(spark, "packed"))
        if batch is not BATCH_2[2:]:
            live.compact()
            live.purge()
    live.sync()
    return live.read().select(*_landed_columns())


@query
def decode_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode the log as messages and decode them."""
    messages = sources.encode_envelope(_log(spark, sf_dir), CUSTOMER.topic)
    return sources.decode_envelope(messages, SPEC).select("op", "ts_ms", "after.*")


@query
def decode_envelope_wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from messages that a converter has wrapped with their schema."""
    messages = sources.encode_envelope(_log(spark, sf_dir), CUSTOMER.topic)
    wrapped = F.concat(F.lit('{"schema":{"type":"struct"},"payload":'), "value", F.lit("}"))
    decoded = sources.decode_envelope(messages.withColumn("value", wrapped), SPEC)
    return decoded.select("op", "ts_ms", "after.*")


# The source table and the changes it emits.

SHOP = TableSpec(
    "customer",
    record_type(
        c_custkey="long",
        c_name="string",
        c_nationkey="integer",
        c_acctbal="double",
        c_mktsegment="string",
    ),
    key=["c_custkey"],
)


def _shop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(logs.given(spark, sf_dir, "customer"), SHOP)


def _newcomers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier as a new customer, with a new key."""
    return logs.given(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + F.lit(logs.NEW_KEYS)).alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_acctbal").alias("c_acctbal"),
        F.lit("LIVING").alias("c_mktsegment"),
    )


def _statements(spark: SparkSession, sf_dir: str) -> list[dict]:
    """DELETE, INSERT, DELETE among the inserted, UPDATE of the inserted: one after another."""
    owing = F.col("c_acctbal") < 0
    living = F.col("c_mktsegment") == "LIVING"
    return [
        {"delete": (F.col("c_mktsegment") == "FURNITURE") & owing},
        {"inserts": _newcomers(spark, sf_dir)},
        {"delete": living & owing},
        {
            "update": (
                living & (F.col("c_nationkey") > 12),
                {"c_mktsegment": F.lit("SHIPPING"), "c_acctbal": F.col("c_acctbal") + 10},
            )
        },
    ]


@query
def source_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source table, brought to the record type."""
    return _shop(spark, sf_dir)


@query
def source_dml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source table after the statements."""
    table = _shop(spark, sf_dir)
    for statement in _statements(spark, sf_dir):
        table = ops.apply_dml(table, **statement)
    return table


@query
def snapshot_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The initial snapshot as read events."""
    events = ops.snapshot_events(_shop(spark, sf_dir), SHOP, logs.T0)
    return events.select(
        "op",
        "ts_ms",
        F.col("source.snapshot").alias("snapshot"),
        F.col("before").isNull().alias("no_before"),
        "after.*",
    )


@query
def capture_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events between the source table before and after the statements."""
    old, new = _shop(spark, sf_dir), source_dml(spark, sf_dir)
    return ops.capture_changes(old, new, SHOP, logs.T0).select(
        "op",
        *(F.col(f"before.{c}").alias(f"before_{c}") for c in SHOP.columns),
        *(F.col(f"after.{c}").alias(f"after_{c}") for c in SHOP.columns),
    )


@query
def snapshot_with_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer table read in chunks at different times, while its changes went on."""
    return _handover(spark, sf_dir, step=5)


def _handover(spark: SparkSession, sf_dir: str, step: int) -> DataFrame:
    """Live rows of a handover whose chunks are read in an order that ``step`` gives."""
    chunk = F.floor(F.col("id") / 100)
    # times of the reads, in the order of the chunks by twelves
    moment = (F.lit(40_000) + 10_000 * F.pmod(F.col("chunk") * step, F.lit(12))) * logs.STRIDE
    history = _log(spark, sf_dir)
    marks = history.where("op = 'r'").select(F.floor(F.col("after.id") / 100).alias("chunk"))
    marks = marks.distinct().select("chunk", (moment + F.lit(logs.T0)).alias("moment"))
    # what a read of each chunk saw: the state of its keys at that time
    seen = history.withColumn("id", fn.key_columns(SPEC)[0]).withColumn("chunk", chunk)
    seen = seen.join(marks, "chunk").where("ts_ms <= moment").drop("chunk", "id", "moment")
    rows = ops.latest_columns(ops.live(ops.latest_state(seen, SPEC)), SPEC)
    around = marks.selectExpr("chunk", f"moment - {logs.STRIDE} AS low", f"moment + {logs.STRIDE} AS high")
    first = around.agg(F.min("low")).scalar()
    during = history.where((F.col("op") != "r") & (F.col("ts_ms") >= first))
    merged = ops.snapshot_with_changes(rows, around, during, SPEC, chunk)
    return ops.latest_columns(ops.live(ops.latest_state(merged, SPEC)), SPEC)


@query
def workload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run the statements, capture each, all in one millisecond, and derive the live rows.

    Only the log position tells the changes apart. The result must equal ``source_dml``.
    """
    table = _shop(spark, sf_dir)
    events = [ops.snapshot_events(table, SHOP, logs.T0, pos=0)]
    for pos, statement in enumerate(_statements(spark, sf_dir), start=1):
        changed = ops.apply_dml(table, **statement)
        events.append(ops.capture_changes(table, changed, SHOP, logs.T0, pos))
        table = changed
    state = ops.latest_state(reduce(DataFrame.unionByName, events), SHOP)
    return ops.latest_columns(ops.live(state), SHOP)


# Records, times, ranks and the latest state.


@query
def change_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row each change is about."""
    return ops.with_record(_log(spark, sf_dir)).select("op", "ts_ms", "record.*")


@query
def flatten_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row each change is about, flat, with the change's operation."""
    records = _log(spark, sf_dir).select(fn.change_record().alias("record"), "op")
    return records.select("record.*", "op")


@query
def change_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When each change happened."""
    return _log(spark, sf_dir).select(
        F.col("source.pos").alias("pos"), fn.change_ts("ts_ms").alias("ts")
    )


@query
def change_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The age rank of each change of a key."""
    ranked = ops.change_rank(_log(spark, sf_dir), SPEC)
    return ranked.select(
        fn.change_record()["id"].alias("id"), "ts_ms", F.col("source.pos").alias("pos"), "row_num"
    )


@query
def latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest change of each key, deletes included."""
    return ops.latest_state(_log(spark, sf_dir), SPEC).select("record.*", "op", "ts")


@query
def latest_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through a catalog view over a change-log table."""
    path = _landed(_log(spark, sf_dir))
    schema = _namespace(spark, "views")
    sources.create_change_table(spark, f"{schema}.customer_changes", SPEC, path)
    ops.create_latest_view(spark, f"{schema}.customer", f"{schema}.customer_changes", SPEC)
    return spark.table(f"{schema}.customer").select("record.*", "op", "ts")


@query
def live_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest row of each key that is not deleted."""
    return ops.live(ops.latest_state(_log(spark, sf_dir), SPEC))


@query
def latest_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record columns of the live rows."""
    return ops.latest_columns(live_rows(spark, sf_dir), SPEC)


@query
def latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest event of each user."""
    changes = logs.event_log(spark, sf_dir)
    return ops.latest_state(changes, logs.USER_EVENTS).select("record.*", "op", "ts")


@query
def latest_order_of_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest order of each customer; equal dates are decided by position."""
    spec = logs.ORDER_OF_CUSTOMER
    return ops.live(ops.latest_state(logs.order_log(spark, sf_dir, spec), spec))


@query
def latest_order_of_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest order of each status: three keys, each with a third of the log."""
    spec = logs.ORDER_OF_STATUS
    return ops.live(ops.latest_state(logs.order_log(spark, sf_dir, spec), spec))


@query
def order_rank_of_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Age rank of every order within its status: three keys share the log."""
    spec = logs.ORDER_OF_STATUS
    ranked = ops.change_rank(logs.order_log(spark, sf_dir, spec), spec)
    return ranked.select("after.o_orderstatus", "after.o_orderkey", "row_num")


@query
def order_rank_in_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over many small slices, most of them inside one status."""
    spec = logs.ORDER_OF_STATUS
    ranked = ops.change_rank(logs.order_log(spark, sf_dir, spec), spec, slices=50)
    return ranked.select("after.o_orderstatus", "after.o_orderkey", "row_num")


@query
def latest_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest version of each order line: a key of two columns."""
    return ops.live(ops.latest_state(logs.line_log(spark, sf_dir), logs.LINE))


# The incremental refresh and its parts.


@query
def high_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mark of the latest table of batch 1."""
    return ops.high_watermark(_latest_1(spark, sf_dir))


@query
def high_watermark_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mark of an empty latest table lies before all changes of the log."""
    deletes = _log(spark, sf_dir).where(F.col("op") == "d")
    nothing = ops.live(ops.latest_state(deletes, SPEC))
    mark = ops.high_watermark(nothing)
    return mark.select((F.col("ts") < F.lit("1970-01-01").cast("timestamp_ntz")).alias("is_floor"))


@query
def changed_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of the keys that changed after the mark."""
    mark = ops.high_watermark(_latest_1(spark, sf_dir))
    return ops.changed_since(_log(spark, sf_dir), SPEC, mark).select("record.*", "op", "ts")


@query
def changed_since_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a log laid out by day, of which days before the mark are not opened."""
    path = fresh_dir(spark, "log")
    sources.write_changes(_log(spark, sf_dir), path, by_day=True)
    changes = sources.read_changes(spark, path, SPEC, by_day=True)
    mark = ops.high_watermark(_latest_1(spark, sf_dir))
    return ops.changed_since(changes, SPEC, mark).select("record.*", "op", "ts")


@query
def high_watermark_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mark of the stored latest table of batch 1, from the footers of its files."""
    path = fresh_dir(spark, "marked")
    ops.write_marked(_latest_1(spark, sf_dir), path)
    return spark.range(1).select(fn.change_ts(F.lit(ops.stored_mark(spark, path))).alias("ts"))


@query
def changed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys that changed after the mark."""
    mark = ops.high_watermark(_latest_1(spark, sf_dir))
    return ops.changed_keys(_log(spark, sf_dir), SPEC, mark)


@query
def rows_to_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the latest table that a refresh removes."""
    return ops.rows_to_replace(_latest_1(spark, sf_dir), changed_keys(spark, sf_dir), SPEC)


@query
def delete_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the latest table that a refresh leaves alone."""
    return ops.delete_changed(_latest_1(spark, sf_dir), changed_keys(spark, sf_dir), SPEC)


@query
def rows_to_replace_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by keys that were written first, so that the planner knows how few they are."""
    latest = _latest_1(spark, sf_dir)
    mark = ops.high_watermark(latest)
    keys = ops.store_keys(_log(spark, sf_dir), SPEC, mark, fresh_dir(spark, "keys"))
    return ops.rows_to_replace(latest, keys, SPEC)


@query
def delete_few(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a refresh leaves alone, by way of the few that it does not."""
    latest = _latest_1(spark, sf_dir)
    mark = ops.high_watermark(latest)
    keys = ops.store_keys(_log(spark, sf_dir), SPEC, mark, fresh_dir(spark, "keys"))
    return ops.delete_few(latest, keys, SPEC, fresh_dir(spark, "gone"))


@query
def insert_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest table with the new rows of a refresh, before any are removed."""
    latest = _latest_1(spark, sf_dir)
    state = ops.changed_since(_log(spark, sf_dir), SPEC, ops.high_watermark(latest))
    return ops.insert_changed(latest, state, SPEC)


@query
def apply_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest table after a refresh."""
    return _refreshed(spark, sf_dir)


@query
def apply_delta_noop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest table after two refreshes from the same log, stored in between."""
    path = fresh_dir(spark, "latest")
    once = _refreshed(spark, sf_dir)
    once.write.parquet(path)
    stored = spark.read.schema(once.schema).parquet(path)
    return ops.apply_delta(stored, _log(spark, sf_dir), SPEC)


@query
def apply_delta_two_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A refresh whose mark falls between removal and insertion: late rows appear twice."""
    changes = _log(spark, sf_dir, logs.FALLING_MARK)
    return ops.apply_delta(_latest_1(spark, sf_dir), changes, SPEC, marks="two")


@query
def late_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live rows of the whole log that the refresh has skipped, being below its mark."""
    return (
        live_rows(spark, sf_dir)
        .select("id", "ts")
        .join(_refreshed(spark, sf_dir).select("id", "ts"), ["id", "ts"], "left_anti")
    )


def _keywise(spark: SparkSession, sf_dir: str, log: LogTable = CUSTOMER) -> DataFrame:
    """The state of batch 1 after a key-wise refresh by batch 2."""
    state = ops.keyed_state(logs.change_log(spark, sf_dir, log, BATCH_1), log.spec)
    return ops.apply_keywise(state, logs.change_log(spark, sf_dir, log, BATCH_2), log.spec)


@query
def latest_keywise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key-wise refresh, of a state stored in buckets, misses nothing."""
    table = f"{_namespace(spark, 'states')}.customer"
    rows = logs.given(spark, sf_dir, "customer").count()
    state = ops.keyed_state(_log(spark, sf_dir, BATCH_1), SPEC)
    ops.write_keyed_state(state, SPEC, table, buckets_for(rows))
    return ops.live(ops.apply_keywise(spark.table(table), _log(spark, sf_dir, BATCH_2), SPEC))


@query
def latest_stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live rows of the streaming state after three batches: deletes come before what they outrank."""
    path, progress = fresh_dir(spark, "log"), fresh_dir(spark, "progress")
    for event in logs.LATE_DELETE:
        sources.write_changes(_log(spark, sf_dir, [event]), path)
        changes = sources.read_changes(spark, path, SPEC, streaming=True)
        streaming.latest_stream_state(
            changes, SPEC, progress, trigger=AVAILABLE_NOW
        ).awaitTermination()
    return ops.live(streaming.read_stream_state(spark, progress))


# The stored table, refreshed in steps and by stream.


@query
def bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create the stored table from the log; creating it again changes nothing."""
    store = _store(spark, sf_dir)
    store.bootstrap(_log(spark, sf_dir))
    store.bootstrap(_log(spark, sf_dir, BATCH_1))
    return store.read()


@query
def store_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refresh the stored table from the landed log."""
    changes = sources.read_changes(spark, _landed(_log(spark, sf_dir)), SPEC)
    store = _store(spark, sf_dir, rewrite_share=0.5)
    store.bootstrap(_log(spark, sf_dir, BATCH_1))
    store.refresh(changes)
    return store.read()


@query
def store_refresh_keywise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refresh the key-wise store with one kind of change at a time, the latest kinds first."""
    store = _store(spark, sf_dir, keywise=True, rewrite_share=0.5)
    store.bootstrap(_log(spark, sf_dir, BATCH_1))
    for event in sorted(BATCH_2, key=lambda e: e.ts, reverse=True):
        store.refresh(_log(spark, sf_dir, [event]))
    return store.read()


def _streamed(spark: SparkSession, sf_dir: str, keywise: bool) -> DataFrame:
    """Land a batch, run the stream, land the next, run it again from its checkpoint."""
    path, progress = fresh_dir(spark, "log"), fresh_dir(spark, "progress")
    store = _store(spark, sf_dir, keywise=keywise)
    for batch in (BATCH_1, BATCH_2):
        sources.write_changes(_log(spark, sf_dir, batch), path)
        changes = sources.read_changes(spark, path, SPEC, streaming=True)
        streaming.incremental_stream(
            changes, store, progress, trigger=AVAILABLE_NOW
        ).awaitTermination()
    return store.read()


@query
def incremental_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table kept up to date by a stream, from its mark."""
    return _streamed(spark, sf_dir, keywise=False)


@query
def incremental_stream_keywise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table kept up to date by a stream, key by key."""
    return _streamed(spark, sf_dir, keywise=True)


@query
def incremental_stream_late_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of three batches: the snapshot, deletes, and updates from before the deletes."""
    path, progress = fresh_dir(spark, "log"), fresh_dir(spark, "progress")
    store = _store(spark, sf_dir)
    for event in logs.LATE_DELETE:
        sources.write_changes(_log(spark, sf_dir, [event]), path)
        changes = sources.read_changes(spark, path, SPEC, streaming=True)
        streaming.incremental_stream(
            changes, store, progress, trigger=AVAILABLE_NOW
        ).awaitTermination()
    return store.read()


@query
def catalog_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tables by name: set up after batch 1, refreshed after batch 2, then reported."""
    return _catalog_report(spark, sf_dir)


@query
def catalog_refresh_keywise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same key by key, which misses nothing."""
    return _catalog_report(spark, sf_dir, keywise=True)


def _catalog_report(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    root = fresh_dir(spark, "changes")
    tables = [CUSTOMER, PART]

    def land(events: Sequence[Event]) -> None:
        for log in tables:
            changes = logs.change_log(spark, sf_dir, log, events)
            sources.write_changes(changes, f"{root}/{log.table}")

    land(BATCH_1)
    rows = {log.spec.name: logs.given(spark, sf_dir, log.table).count() for log in tables}
    catalog = ChangeCatalog(
        spark,
        [log.spec for log in tables],
        root,
        *(_namespace(spark, purpose) for purpose in ("cdc", "views", "latest")),
        buckets={name: buckets_for(n) for name, n in rows.items()},
        **options,
    )
    catalog.create()
    land(BATCH_2)
    catalog.refresh()
    return catalog.report({log.table: _truth(spark, sf_dir, log) for log in tables})


# Reconciliation.


@query
def source_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the source."""
    return _truth(spark, sf_dir).agg(F.count("*").alias("n"))


@query
def missing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source rows not delivered yet."""
    return ops.missing(_truth(spark, sf_dir), _refreshed(spark, sf_dir), SPEC)


@query
def stale_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered rows the source no longer has."""
    return ops.stale(_truth(spark, sf_dir), _refreshed(spark, sf_dir), SPEC)


@query
def missing_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_rows(spark, sf_dir).agg(F.count("*").alias("n"))


@query
def stale_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stale_rows(spark, sf_dir).agg(F.count("*").alias("n"))


@query
def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report over both tables."""
    return ops.reconcile(
        (log.spec, _truth(spark, sf_dir, log), _refreshed(spark, sf_dir, log))
        for log in (CUSTOMER, PART)
    )


@query
def reconcile_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report, comparing only rows that digests of key buckets tell apart."""
    return ops.reconcile_digest(
        (log.spec, _truth(spark, sf_dir, log), _refreshed(spark, sf_dir, log))
        for log in (CUSTOMER, PART)
    )


@query
def reconcile_digest_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same down a tree of two levels of buckets, from tables laid out by the first."""
    tables = []
    for log in (CUSTOMER, PART):
        sides = []
        for side in (_truth(spark, sf_dir, log), _refreshed(spark, sf_dir, log)):
            path = fresh_dir(spark, "by-bucket")
            ops.write_by_bucket(side, log.spec, path, bits=6)
            sides.append(ops.read_by_bucket(spark, path, log.spec, bits=6))
        tables.append((log.spec, *sides))
    return ops.reconcile_digest(tables, bits=6, few_rows=0)


@query
def reconcile_digest_agreed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of tables in agreement, which compares no rows."""
    return ops.reconcile_digest(
        (log.spec, _truth(spark, sf_dir, log), ops.live(_keywise(spark, sf_dir, log)))
        for log in (CUSTOMER, PART)
    )


@query
def report_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report written as CSV and read back."""
    path = fresh_dir(spark, "report")
    ops.write_report(reconcile(spark, sf_dir), path)
    schema = "match BOOLEAN, name STRING, num_missing BIGINT, num_stale BIGINT, num_total BIGINT"
    return spark.read.schema(schema).option("header", True).csv(path)


@query
def converge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refresh and reconcile both tables until they agree with their sources.

    The first try sees batch 1 only and must fail; the second sees the rest.
    """
    tables = [(log, _store(spark, sf_dir, log)) for log in (CUSTOMER, PART)]
    arrivals = iter([tuple(e for e in ON_TIME if e.batch == b) for b in (1, 2)])

    def truth(log: LogTable) -> DataFrame:
        state = ops.latest_state(logs.change_log(spark, sf_dir, log, ON_TIME), log.spec)
        return ops.live(state)

    def step() -> DataFrame:
        arrived = next(arrivals)
        for log, store in tables:
            store.refresh(logs.change_log(spark, sf_dir, log, arrived))
        return ops.reconcile((log.spec, truth(log), store.read()) for log, store in tables)

    return streaming.converge(step, [log.spec for log, _ in tables], interval_s=0)
