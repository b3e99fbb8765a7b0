from __future__ import annotations

import pytest
from build import rows
from pyspark.sql import functions as F

from tidemark import ADDRESSES
from tidemark import operators as ops

TS = 1_700_000_000_000
HOME = ("Long Lane 7", "Springfield", "Somestate", "12345")


@pytest.fixture(scope="module")
def addresses(spark):
    return spark.createDataFrame(
        [(1, 5, "A St", "B", "C", "1", "LIVING"), (2, 6, "D St", "E", "F", None, "BILLING")],
        ADDRESSES.record,
    )


def run_workload(spark, table, first_id, events, ts_ms):
    """Clear a customer's addresses, add three, drop one, change one. All in one millisecond."""
    ours = (F.col("customer_id") == 1004) & (F.col("street") == HOME[0])
    new = spark.createDataFrame(
        [(first_id + i, 1004, *HOME, t) for i, t in enumerate(["BILLING", "LIVING", "SHIPPING"])],
        ADDRESSES.record,
    )
    statements = [
        {"delete": ours},
        {"inserts": new},
        {"delete": ours & (F.col("type") == "SHIPPING")},
        {"update": (ours & (F.col("type") == "LIVING"), {"type": F.lit("SHIPPING")})},
    ]
    ops_seen = []
    for statement in statements:
        changed = ops.apply_dml(table, **statement)
        pos = len(events)
        captured = ops.capture_changes(table, changed, ADDRESSES, ts_ms, pos)
        events.append(captured)
        ops_seen += sorted(r["op"] for r in captured.select("op").collect())
        table = spark.createDataFrame(changed.collect(), ADDRESSES.record)
    return table, ops_seen


def test_workload_twice(spark, addresses):
    events = [ops.snapshot_events(addresses, ADDRESSES, TS, pos=0)]
    table, seen = run_workload(spark, addresses, 10, events, TS)
    assert seen == ["c", "c", "c", "d", "u"]
    assert rows(table.where("customer_id = 1004"), "id", "type") == [
        (10, "BILLING"),
        (11, "SHIPPING"),
    ]

    def latest():
        changes = events[0]
        for more in events[1:]:
            changes = changes.unionByName(more)
        return ops.live(ops.latest_state(changes, ADDRESSES))

    assert rows(ops.latest_columns(latest(), ADDRESSES)) == rows(table)

    table, seen = run_workload(spark, table, 20, events, TS + 1)
    assert seen == ["d", "d", "c", "c", "c", "d", "u"]
    assert table.count() == 4
    assert rows(ops.latest_columns(latest(), ADDRESSES)) == rows(table)
    assert rows(ops.reconcile([(ADDRESSES, table, latest())])) == [(True, "addresses", 0, 0, 4)]


def test_dml_leaves_rows_alone_where_the_predicate_is_null(spark, addresses):
    unknown = F.col("zip") == "1"
    assert rows(ops.apply_dml(addresses, delete=unknown), "id") == [(2,)]
    changed = ops.apply_dml(addresses, update=(unknown, {"city": F.lit("X"), "zip": F.lit(None)}))
    assert rows(changed, "id", "city", "zip") == [(1, "X", None), (2, "E", None)]
    assert changed.columns == ADDRESSES.columns


def test_capture_sees_null_and_value_as_different(spark, addresses):
    cleared = ops.apply_dml(addresses, update=(F.col("id") == 1, {"zip": F.lit(None)}))
    events = ops.capture_changes(addresses, cleared, ADDRESSES, TS)
    assert rows(events, "op", "before.zip", "after.zip") == [("u", "1", None)]
    assert ops.capture_changes(cleared, cleared, ADDRESSES, TS).count() == 0


def test_envelope_fields(spark, addresses):
    events = ops.snapshot_events(addresses, ADDRESSES, TS, pos=3, partitions=4)
    assert events.columns == ["before", "after", "source", "op", "ts_ms", "transaction", "partition"]
    one = events.where("after.id = 1").first()
    assert (one["op"], one["before"], one["ts_ms"]) == ("r", None, TS)
    assert (one["source"]["snapshot"], one["source"]["table"]) == ("true", "addresses")
    assert (one["source"]["pos"], one["source"]["ts_ms"]) == (3, TS)
    assert 0 <= one["partition"] < 4
