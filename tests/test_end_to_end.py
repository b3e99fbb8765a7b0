"""The whole way: source tables, events, messages, landing, refresh, reconciliation."""

from __future__ import annotations

import os

import pytest
from build import rows
from test_capture import TS, run_workload

from tidemark import ADDRESSES, PRODUCTS, ChangeCatalog, LatestStore, sources, streaming
from tidemark import operators as ops
from tidemark.store import merge_into
from tidemark.streaming.landing import AVAILABLE_NOW


@pytest.mark.parametrize("keywise", [False, True])
def test_changes_of_two_tables_arrive(spark, tmp_path, keywise):
    specs = [ADDRESSES, PRODUCTS]
    tables = {
        "addresses": spark.createDataFrame(
            [(1, 5, "A St", "B", "C", "1", "LIVING"), (2, 6, "D St", "E", "F", None, "BILLING")],
            ADDRESSES.record,
        ),
        "products": spark.createDataFrame(
            [(101, "scooter", "small", 3.14), (102, "battery", None, 8.1)], PRODUCTS.record
        ),
    }
    broker, landing = str(tmp_path / "broker"), str(tmp_path / "landing")
    os.makedirs(broker)
    stores = {
        spec.name: LatestStore(
            spark, spec, f"shop_{keywise}", location=str(tmp_path / "latest"), keywise=keywise
        )
        for spec in specs
    }

    def send(name, changes):
        messages = sources.encode_envelope(changes, f"shop.inventory.{name}")
        messages.write.mode("append").parquet(broker)

    def step():
        stream = spark.readStream.schema("topic STRING, partition INT, value STRING")
        streaming.land_topics(
            stream.parquet(broker), specs, landing, str(tmp_path / "landed"), trigger=AVAILABLE_NOW
        ).awaitTermination()
        for spec in specs:
            changes = sources.read_changes(spark, f"{landing}/{spec.name}", spec, streaming=True)
            streaming.incremental_stream(
                changes,
                stores[spec.name],
                str(tmp_path / "refreshed" / spec.name),
                trigger=AVAILABLE_NOW,
            ).awaitTermination()
        return ops.reconcile((s, tables[s.name], stores[s.name].read()) for s in specs)

    for spec in specs:
        send(spec.name, ops.snapshot_events(tables[spec.name], spec, TS, pos=0))
    report = streaming.converge(step, specs, max_tries=2, interval_s=0)
    assert rows(report) == [(True, "addresses", 0, 0, 2), (True, "products", 0, 0, 2)]

    events = []
    tables["addresses"], _ = run_workload(spark, tables["addresses"], 10, events, TS + 1)
    stale = ops.reconcile([(ADDRESSES, tables["addresses"], stores["addresses"].read())])
    assert rows(stale) == [(False, "addresses", 2, 0, 4)]
    for captured in events:
        send("addresses", captured)
    report = streaming.converge(step, specs, max_tries=2, interval_s=0)
    assert rows(report) == [(True, "addresses", 0, 0, 4), (True, "products", 0, 0, 2)]


def test_merge_needs_a_table_that_supports_row_updates(spark, tmp_path):
    # neither Iceberg nor Delta is installed here: Spark accepts the statement, and then
    # finds that Parquet cannot carry it out
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS merging LOCATION '{tmp_path}'")
    spark.sql(
        "CREATE TABLE merging.products (id BIGINT, name STRING, description STRING, "
        "weight DOUBLE, ts TIMESTAMP_NTZ) USING parquet"
    )
    table = spark.createDataFrame([(1, "a", "b", 1.0)], PRODUCTS.record)
    state = ops.latest_state(ops.snapshot_events(table, PRODUCTS, TS), PRODUCTS)
    with pytest.raises(Exception, match="MERGE"):
        merge_into(state, "merging.products", PRODUCTS)


def test_catalog_of_two_tables(spark, tmp_path):
    tables = {
        "addresses": spark.createDataFrame(
            [(1, 5, "A St", "B", "C", "1", "LIVING")], ADDRESSES.record
        ),
        "products": spark.createDataFrame([(101, "scooter", "small", 3.14)], PRODUCTS.record),
    }
    specs = [ADDRESSES, PRODUCTS]
    root = str(tmp_path / "changes")
    names = ["by_name_cdc", "by_name_views", "by_name_latest"]
    locations = {name: str(tmp_path / name) for name in names}
    catalog = ChangeCatalog(spark, specs, root, *names, locations=locations, buckets=2)
    catalog.create()  # before anything has landed
    with pytest.raises(streaming.NotConverged):
        catalog.converge(tables, max_tries=2, interval_s=0)
    for spec in specs:
        events = ops.snapshot_events(tables[spec.name], spec, TS, pos=0, partitions=3)
        sources.write_changes(events, f"{root}/{spec.name}")
    report = catalog.converge(tables, max_tries=1)
    assert rows(report) == [(True, "addresses", 0, 0, 1), (True, "products", 0, 0, 1)]

    events = []
    tables["addresses"], _ = run_workload(spark, tables["addresses"], 10, events, TS + 1)
    for captured in events:
        sources.write_changes(captured, f"{root}/addresses")
    catalog.create()  # changes nothing
    assert not rows(catalog.report(tables), "result")[0][0]
    assert rows(catalog.converge(tables, max_tries=1), "result") == [(True,), (True,)]
    deleted = spark.table("by_name_views.addresses").where("op = 'd'")
    assert rows(deleted, "record.type") == [("SHIPPING",)]
