"""The physical plans that the operators are meant to have."""

from __future__ import annotations

import re

import pytest
from build import ITEM, at, change, log, rows

from tidemark import LatestStore, sources
from tidemark import operators as ops
from tidemark.operators.delta import FOOTERS
from tidemark.session import settings

ROW = "id BIGINT, name STRING, bal DOUBLE"


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("landed") / "log")
    sources.write_changes(log(spark, [change("c", k, 10 + k, pos=k) for k in range(50)]), path)
    return sources.read_changes(spark, path, ITEM)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_latest_state_limits_groups_before_the_only_shuffle(landed):
    text = plan(ops.latest_state(landed, ITEM))
    assert "row_number(), 1, Partial" in text
    assert text.count("Arguments: hashpartitioning") == 1
    schema = re.search(r"ReadSchema: (.*)", text).group(1)
    assert "source:struct<file:string,pos:bigint,row:int>" in schema
    assert "transaction" not in schema
    # one image of the record is shuffled, not two
    exchange = re.search(r"\) Exchange\nInput \[\d+\]: (.*)", text).group(1)
    assert "record" in exchange
    assert "after" not in exchange


def test_changed_keys_read_keys_only(landed):
    text = plan(ops.changed_keys(landed, ITEM, 20))
    assert "ReadSchema: struct<before:struct<id:bigint>,after:struct<id:bigint>,ts_ms:bigint>" in text
    assert "GreaterThan(ts_ms,20)" in text


def test_a_mark_that_is_a_query_is_pushed_down(landed):
    mark = ops.high_watermark(ops.live(ops.latest_state(landed, ITEM)))
    text = plan(ops.changed_since(landed, ITEM, mark))
    assert "GreaterThan(ts_ms,ScalarSubquery" in text


def test_stored_tables_are_not_shuffled(spark, landed, tmp_path, no_broadcast):
    for keywise in (False, True):
        store = LatestStore(
            spark,
            ITEM,
            f"plans_{keywise}",
            location=str(tmp_path / str(keywise)),
            keywise=keywise,
            rewrite_share=9.0,
        )
        store.bootstrap(landed)
        store.refresh(log(spark, [change("u", k, 100, pos=100) for k in range(10)]))
        store.refresh(log(spark, [change("u", 1, 200, pos=200)]))
        held = store.properties()
        parts = [held["base"], *(d.split(":")[0] for d in held["deltas"].split())]
        assert len(parts) == 3
        assert "Exchange" not in plan(store.read())
        assert "Exchange" not in plan(store._merged(parts))
        # only the new changes are shuffled, once
        arrivals = plan(store._arrivals(landed, held))
        assert arrivals.count("Arguments: hashpartitioning") == 1


def test_a_report_takes_one_shuffle(landed):
    live = ops.latest_columns(ops.live(ops.latest_state(landed, ITEM)), ITEM)
    text = plan(ops.reconcile([(ITEM, live, live.where("id > 3"))]))
    by_row = [line for line in text.splitlines() if "Arguments: hashpartitioning(id" in line]
    assert len(by_row) == 1
    assert "Join" not in text


def test_a_keywise_refresh_shuffles_each_side_once(landed, no_broadcast):
    state = ops.keyed_state(landed, ITEM)
    once = plan(state).count("Arguments: hashpartitioning")
    text = plan(ops.apply_keywise(state, landed, ITEM))
    # the state is derived here, which is a shuffle of its own; then one for each side
    assert text.count("Arguments: hashpartitioning") == once + 2


def test_apply_delta_scans_the_changes_once(spark, landed, no_broadcast):
    latest = spark.createDataFrame([], "id LONG, name STRING, bal DOUBLE, ts TIMESTAMP_NTZ")
    text = plan(ops.apply_delta(latest, landed, ITEM))
    assert len(re.findall(r"^\(\d+\) Scan parquet", text, re.M)) == 1


def test_a_stored_state_is_not_shuffled(spark, landed, no_broadcast):
    spark.sql("CREATE SCHEMA IF NOT EXISTS plans_states")
    ops.write_keyed_state(ops.keyed_state(landed, ITEM), ITEM, "plans_states.item", buckets=16)
    more = landed.where("ts_ms > 20")
    refreshed = ops.apply_keywise(spark.table("plans_states.item"), more, ITEM)
    text = plan(refreshed)
    # the changes' own shuffle by key, and their newest to the buckets; the state stays in place
    shuffled = re.findall(r"\) Exchange\nInput \[\d+\]: (.*)", text)
    assert shuffled and all("held" not in x for x in shuffled)
    assert "Bucketed: true" in text
    # and what comes out is written bucket by bucket
    ops.write_keyed_state(refreshed, ITEM, "plans_states.next", buckets=16)
    files = spark.table("plans_states.next").selectExpr("input_file_name()").distinct().count()
    assert files <= 16
    assert spark.table("plans_states.next").count() == 50


def test_a_log_by_day_opens_days_after_the_mark_only(spark, tmp_path):
    day = 86_400_000
    path = str(tmp_path / "days")
    changes = [change("c", k, (k // 5) * day + k, pos=k) for k in range(50)]
    changes.append(change("c", 99, None))
    sources.write_changes(log(spark, changes), path, by_day=True)
    by_day = sources.read_changes(spark, path, ITEM, by_day=True)
    latest = spark.createDataFrame([(1, "n", 0.0, at(7 * day + 36))], f"{ROW}, ts TIMESTAMP_NTZ")
    mark = ops.high_watermark(latest)
    found = ops.changed_keys(by_day, ITEM, mark)
    text = plan(found)
    assert re.search(r"PartitionFilters: \[.*day#\d+ >= .*Subquery", text)
    assert rows(found) == [(k,) for k in range(37, 50)]
    kept = ops.newer_than(by_day, mark).selectExpr("input_file_name()").distinct().collect()
    assert {re.search(r"day=(\d+)", r[0]).group(1) for r in kept} == {"7", "8", "9"}
    # the state of keys is that of a log in any other layout
    whole = ops.changed_since(log(spark, changes), ITEM, mark)
    assert rows(ops.changed_since(by_day, ITEM, mark)) == rows(whole)


def test_a_mark_comes_from_footers(spark, tmp_path):
    path = str(tmp_path / "marked")
    latest = spark.createDataFrame(
        [(k, "n", 0.0, at(1000 + k)) for k in range(20)], f"{ROW}, ts TIMESTAMP_NTZ"
    )
    ops.write_marked(latest, path)
    with settings(spark, FOOTERS):
        text = plan(ops.footer_mark(spark, path))
    assert "PushedAggregation: [MAX(mark_ms)]" in text
    assert ops.stored_mark(spark, path) == 1019
    newer = log(spark, [change("u", 1, 1019), change("u", 2, 1020)])
    assert rows(ops.changed_keys(newer, ITEM, ops.stored_mark(spark, path))) == [(2,)]
    nothing = str(tmp_path / "nothing")
    ops.write_marked(latest.limit(0), nothing)
    assert ops.changed_keys(newer, ITEM, ops.stored_mark(spark, nothing)).count() == 2


def test_few_keys_are_a_bloom_filter_on_the_large_side(spark, landed, tmp_path, no_broadcast):
    path = str(tmp_path / "latest")
    ops.live(ops.latest_state(landed, ITEM)).write.parquet(path)
    latest = spark.read.schema(f"{ROW}, ts TIMESTAMP_NTZ").parquet(path)
    keys = ops.store_keys(landed, ITEM, 40, str(tmp_path / "keys"))
    name = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    with settings(spark, {name: "1"}):
        found = ops.rows_to_replace(latest, keys, ITEM)
        text = plan(found)
        assert sorted(r["id"] for r in found.collect()) == list(range(31, 50))
        left = ops.delete_few(latest, keys, ITEM, str(tmp_path / "gone"))
        assert sorted(r["id"] for r in left.collect()) == list(range(31))
    # a filter right on the scan of the latest table, below its shuffle
    scan, *rest = text.split("\n\n(")[1:4]
    assert scan.startswith("1) Scan parquet") and "latest" in scan
    assert any(re.search(r"Condition : .*might_contain\(Subquery.*xxhash64\(id#", x) for x in rest)
