from __future__ import annotations

import random

import pytest
from build import ITEM, at, change, log, rows
from pyspark.sql import functions as F

from tidemark import ADDRESSES, PRODUCTS, TableSpec, record_type
from tidemark import operators as ops
from tidemark.functions import change_ts, epoch_millis


def state(spark, changes, spec=ITEM):
    return ops.latest_state(log(spark, changes, spec), spec)


def test_delete_takes_its_record_from_before(spark):
    found = state(spark, [change("c", 1, 10), change("d", 1, 20, name="old")])
    assert rows(found.select("record.*", "op", "ts")) == [(1, "old", 0.0, "d", at(20))]
    assert ops.live(found).count() == 0


def test_record_is_not_merged_field_by_field(spark):
    changes = [
        change(
            "u",
            1,
            20,
            before={"id": 1, "name": "old", "bal": 1.0},
            after={"id": 1, "name": None, "bal": 2.0},
        )
    ]
    assert rows(ops.with_record(log(spark, changes)).select("record.*")) == [(1, None, 2.0)]


def test_null_struct_differs_from_struct_of_nulls(spark):
    empty = {"id": None, "name": None, "bal": None}
    known = {"id": 1, "name": "x", "bal": 1.0}
    changes = [
        change("u", 1, 20, before=known, after=empty),
        change("u", 1, 30, before=known, after=None),
    ]
    # the first has a new image without a key, the second has no new image
    assert rows(state(spark, changes).select("record.*", "ts")) == [
        (1, "x", 1.0, at(30)),
        (None, None, None, at(20)),
    ]


def test_null_operation_counts_as_delete(spark):
    found = state(spark, [change("c", 1, 10), change(None, 1, 20)])
    assert found.count() == 1
    assert ops.live(found).count() == 0


def test_unknown_operation_is_live(spark):
    assert ops.live(state(spark, [change("x", 1, 10)])).count() == 1


def test_null_time_is_oldest(spark):
    found = state(spark, [change("c", 1, None, name="undated"), change("u", 1, 10, name="dated")])
    assert rows(found, "record.name") == [("dated",)]
    assert rows(state(spark, [change("c", 1, None, name="undated")]), "record.name", "ts") == [
        ("undated", None)
    ]


def test_changes_without_images_form_one_group(spark):
    nothing = {"before": None, "after": None}
    changes = [change("d", 1, 10, **nothing), change("c", 1, 20, **nothing), change("c", 1, 5)]
    assert rows(state(spark, changes), "record.id", "op") == [(1, "c"), (None, "c")]


def test_ties_are_decided_by_log_position_whatever_the_order(spark):
    changes = [
        change("u", 1, 10, pos=9, file="f1", name="older file", partition=0),
        change("u", 1, 10, pos=1, file="f2", row=0, name="first row", partition=1),
        change("u", 1, 10, pos=1, file="f2", row=1, name="second row", partition=2),
        change("u", 1, 10, pos=None, file=None, row=None, name="nowhere", partition=3),
    ]
    for seed in range(3):
        random.Random(seed).shuffle(changes)
        shuffled = log(spark, changes).repartition(3, F.col("partition"))
        assert rows(ops.latest_state(shuffled, ITEM), "record.name") == [("second row",)]


def test_full_ties_give_the_same_row_every_time(spark):
    changes = [change("u", 1, 10, pos=1, name=f"n{i}") for i in range(8)]
    found = set()
    for seed in range(4):
        random.Random(seed).shuffle(changes)
        found.add(rows(state(spark, changes), "record.name")[0])
    assert len(found) == 1


def test_composite_key(spark):
    spec = TableSpec("line", record_type(a="long", b="string", v="long"), key=["a", "b"])

    def line(a, b, v, ts):
        return {**change("c", 1, ts), "after": {"a": a, "b": b, "v": v}}

    changes = [line(1, "x", 1, 10), line(1, "x", 2, 20), line(1, "y", 3, 10), line(2, "x", 4, 5)]
    assert rows(state(spark, changes, spec).select("record.*")) == [
        (1, "x", 2),
        (1, "y", 3),
        (2, "x", 4),
    ]


def test_empty_log(spark):
    assert state(spark, []).count() == 0


@pytest.mark.parametrize(
    ("ts_ms", "wall_clock"),
    [
        (1667712600000, "2022-11-06 05:30:00"),  # both fall into the hour that
        (1667716200000, "2022-11-06 06:30:00"),  # New York passes twice
        (1704067207179, "2024-01-01 00:00:07.179"),
        (-1, "1969-12-31 23:59:59.999"),
        (0, "1970-01-01 00:00:00"),
    ],
)
def test_time_is_utc_whatever_the_session_zone(spark, ts_ms, wall_clock):
    df = spark.createDataFrame([(ts_ms,)], "ts_ms BIGINT").select(change_ts().alias("ts"))
    assert df.schema["ts"].dataType.simpleString() == "timestamp_ntz"
    assert df.select(F.col("ts").cast("string"), epoch_millis("ts")).first() == (wall_clock, ts_ms)


def test_view_gives_the_latest_state(spark):
    changes = [change("c", k, 10 * k, pos=p, name=f"{k}/{p}") for k in (1, 2) for p in (1, 2)]
    try:
        log(spark, changes).write.saveAsTable("some_changes_table")
        ops.create_latest_view(spark, "some_latest", "some_changes_table", ITEM)
        ops.create_latest_view(spark, "some_latest", "some_changes_table", ITEM)
        assert rows(spark.table("some_latest")) == rows(state(spark, changes))
    finally:
        spark.sql("DROP VIEW IF EXISTS some_latest")
        spark.sql("DROP TABLE IF EXISTS some_changes_table")


def test_spec_checks_its_key():
    with pytest.raises(ValueError, match="key"):
        TableSpec("t", record_type(id="long"), key=["nope"])
    assert hash(ADDRESSES) != hash(PRODUCTS)
    assert ADDRESSES.columns == ["id", "customer_id", "street", "city", "state", "zip", "type"]
