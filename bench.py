"""Benchmark: registered queries, and the main operators on a landed log, in seconds.

Prints one JSON line. Input is $BENCH_SF_DIR, cores are $BENCH_CPUS. Every figure is one run
after one warm-up of the same query; results go to a sink that reads every column.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import LatestStore, sources, streaming
from tidemark import operators as ops
from tidemark.plans import logs
from tidemark.plans.queries import QUERIES
from tidemark.session import fresh_dir, local_session
from tidemark.streaming.landing import AVAILABLE_NOW

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "change_scan",
    "compact_log",
    "land_changes",
    "land_topics",
    "decode_envelope",
    "capture_changes",
    "workload",
    "change_rank",
    "latest_state",
    "latest_view",
    "live_rows",
    "latest_events",
    "latest_order_of_customer",
    "latest_order_of_status",
    "order_rank_of_status",
    "order_rank_in_slices",
    "latest_line",
    "changed_since",
    "changed_keys",
    "delete_changed",
    "apply_delta",
    "apply_delta_two_marks",
    "latest_keywise",
    "bootstrap",
    "store_refresh",
    "incremental_stream",
    "incremental_stream_keywise",
    "incremental_stream_late_delete",
    "catalog_refresh",
    "missing_rows",
    "reconcile",
    "converge",
]


def sink(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(run: Callable[[], object], warm: bool = True) -> float:
    if warm:
        run()
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def landed_operators(spark: SparkSession) -> tuple[dict[str, float], dict[str, int]]:
    """Operators on the landed ``orders`` log, read as a refresh job would read it."""
    log, spec = logs.ORDERS, logs.ORDERS.spec
    path = fresh_dir(spark, "bench-log")
    sources.write_changes(logs.change_log(spark, SF_DIR, log), path)
    changes = sources.read_changes(spark, path, spec)

    namespace = fresh_dir(spark, "bench").rsplit("/", 1)[1].replace("-", "_")
    location = fresh_dir(spark, namespace)

    def store(**options) -> LatestStore:
        """A stored table as of batch 1."""
        schema = f"{namespace}_{time.time_ns()}"
        made = LatestStore(spark, spec, schema, f"{location}/{schema}", **options)
        made.bootstrap(logs.change_log(spark, SF_DIR, log, logs.BATCH_1))
        return made

    times: dict[str, float] = {}
    times["landed_latest_state"] = timed(lambda: sink(ops.latest_state(changes, spec)))
    held = store()
    mark = ops.high_watermark(held.read())
    times["landed_changed_since"] = timed(lambda: sink(ops.changed_since(changes, spec, mark)))
    late_filter = ops.latest_state(changes, spec)
    late_filter = late_filter.where(F.col("ts") > mark.scalar())
    times["landed_changed_since_filter_above"] = timed(lambda: sink(late_filter))
    for percent, every in ((1, 100), (10, 10)):
        update = logs.Event(2, "u", f"k % {every} = 0", 120_000, 3, "bal + 1")
        updated = fresh_dir(spark, "bench-log")
        sources.write_changes(
            logs.change_log(spark, SF_DIR, log, [*logs.BATCH_1, update]), updated
        )
        updates = sources.read_changes(spark, updated, spec)
        times[f"landed_apply_delta_{percent}pct"] = timed(
            lambda: sink(ops.apply_delta(held.read(), updates, spec))
        )
        tables = iter([store(), store()])
        times[f"store_refresh_{percent}pct"] = timed(lambda: next(tables).refresh(updates))
    state = ops.keyed_state(logs.change_log(spark, SF_DIR, log, logs.BATCH_1), spec)
    state_path = fresh_dir(spark, "bench-state")
    state.write.parquet(state_path)
    state = spark.read.parquet(state_path)
    newer = sources.read_changes(spark, path, spec).where(F.col("ts_ms") > logs.T0)
    times["landed_apply_keywise"] = timed(lambda: sink(ops.apply_keywise(state, newer, spec)))

    latest = held.read()
    source = logs.base_records(spark, SF_DIR, log)
    times["landed_reconcile"] = timed(lambda: sink(ops.reconcile([(spec, source, latest)])))
    flat = ops.latest_columns(latest, spec)
    times["landed_reconcile_two_excepts"] = timed(
        lambda: (
            source.subtract(flat).count(),
            flat.subtract(source).count(),
            source.count(),
        )
    )
    tables = iter([store(keywise=True), store(keywise=True)])
    times["store_refresh_keywise"] = timed(lambda: next(tables).refresh(changes))

    messages = fresh_dir(spark, "bench-messages")
    sources.encode_envelope(changes, log.topic).write.parquet(messages)
    stream = spark.readStream.schema("topic STRING, partition INT, value STRING")

    def land() -> None:
        streaming.land_changes(
            stream.parquet(messages),
            spec,
            fresh_dir(spark, "bench-landing"),
            fresh_dir(spark, "bench-progress"),
            trigger=AVAILABLE_NOW,
        ).awaitTermination()

    times["land_orders_log"] = timed(land)
    return times, {"orders_log_rows": changes.count()}


def main() -> None:
    spark = local_session(
        "bench",
        CPUS,
        **{"spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    only = sys.argv[1:]
    times = {}
    for name in only or HEADLINE:
        times[name] = timed(lambda query=QUERIES[name]: sink(query(spark, SF_DIR)))
    rows = {}
    if not only:
        landed, rows = landed_operators(spark)
        times.update(landed)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf") or 0),
                **rows,
            }
        )
    )


if __name__ == "__main__":
    main()
