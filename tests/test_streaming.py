from __future__ import annotations

import dataclasses
import glob
import json
import os
import random

import pytest
from build import ITEM, change, log, rows

from tidemark import PRODUCTS, LatestStore, sources, streaming
from tidemark import operators as ops
from tidemark.session import settings
from tidemark.streaming.landing import AVAILABLE_NOW

MESSAGE = "topic STRING, partition INT, value STRING"


class Broker:
    """Messages as files, read as a stream."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, str(folder)
        os.makedirs(self.folder)

    def send(self, messages):
        messages.write.mode("append").parquet(self.folder)

    def send_changes(self, changes, topic="shop.inventory.item"):
        self.send(sources.encode_envelope(log(self.spark, changes), topic))

    def stream(self):
        return self.spark.readStream.schema(MESSAGE).parquet(self.folder)


@pytest.fixture
def broker(spark, tmp_path):
    return Broker(spark, tmp_path / "messages")


def land(broker, tmp_path, **options):
    query = streaming.land_changes(
        broker.stream(),
        ITEM,
        str(tmp_path / "item"),
        str(tmp_path / "progress"),
        trigger=AVAILABLE_NOW,
        **options,
    )
    query.awaitTermination()
    return sources.read_changes(broker.spark, str(tmp_path / "item"), ITEM)


def test_landing_keeps_envelopes_whole(spark, broker, tmp_path):
    empty = {"id": None, "name": None, "bal": None}
    changes = [
        change("c", 1, 10, partition=0),
        change("d", 1, 20, partition=1),
        change("u", 2, 30, partition=3, before=None, after=empty),
    ]
    broker.send_changes(changes)
    assert rows(land(broker, tmp_path)) == rows(log(spark, changes))
    assert {os.path.basename(p) for p in glob.glob(str(tmp_path / "item/batch=0/partition=*"))} == {
        "partition=0",
        "partition=1",
        "partition=3",
    }
    assert all(p.endswith(".gz.parquet") for p in glob.glob(str(tmp_path / "item/*/*/*.parquet")))


def test_landing_goes_on_where_it_stopped(spark, broker, tmp_path):
    first = [change("c", k, 10, partition=k % 2) for k in range(10)]
    second = [change("u", k, 20, partition=k % 2) for k in range(5)]
    broker.send_changes(first)
    assert land(broker, tmp_path).count() == 10
    assert land(broker, tmp_path).count() == 10
    broker.send_changes(second)
    assert rows(land(broker, tmp_path)) == rows(log(spark, first + second))


def test_files_are_cut_by_record_count(spark, broker, tmp_path):
    broker.send_changes([change("c", k, 10, pos=k) for k in range(1000)])
    assert land(broker, tmp_path, max_records=300).count() == 1000
    files = glob.glob(str(tmp_path / "item/batch=0/partition=0/*.parquet"))
    assert len(files) >= 4
    assert all(spark.read.parquet(f).count() <= 300 for f in files)


def test_null_messages_and_other_topics_are_left_out(spark, broker, tmp_path):
    broker.send_changes([change("c", 1, 10)])
    broker.send_changes([change("c", 2, 10)], topic="shop.inventory.other")
    broker.send(spark.createDataFrame([("shop.inventory.item", 0, None)], MESSAGE))
    assert rows(land(broker, tmp_path), "after.id") == [(1,)]


def test_a_broken_message_stops_the_job(spark, broker, tmp_path):
    broker.send(spark.createDataFrame([("shop.inventory.item", 0, '{"op": ')], MESSAGE))
    with pytest.raises(Exception, match="(?i)malformed"):
        land(broker, tmp_path)


def test_landing_several_tables(spark, broker, tmp_path):
    broker.send_changes([change("c", 1, 10)])
    product = {"id": 7, "name": "p", "description": "d", "weight": 3.14}
    payload = json.dumps({"after": product, "op": "r", "ts_ms": 5})
    broker.send(spark.createDataFrame([("shop.inventory.products", 2, payload)], MESSAGE))
    streaming.land_topics(
        broker.stream(),
        [ITEM, PRODUCTS],
        str(tmp_path / "landed"),
        str(tmp_path / "progress"),
        trigger=AVAILABLE_NOW,
    ).awaitTermination()
    products = sources.read_changes(spark, str(tmp_path / "landed/products"), PRODUCTS)
    assert rows(products, "after.*", "op", "partition") == [(7, "p", "d", 3.14, "r", 2)]
    items = sources.read_changes(spark, str(tmp_path / "landed/item"), ITEM)
    assert rows(items, "after.id") == [(1,)]


def test_a_stream_of_all_topics_is_read_once(spark, broker, tmp_path):
    specs = [ITEM, dataclasses.replace(ITEM, name="other"), dataclasses.replace(ITEM, name="idle")]

    def step():
        query = streaming.land_topics(
            broker.stream(), specs, str(tmp_path / "l"), str(tmp_path / "p"), trigger=AVAILABLE_NOW
        )
        query.awaitTermination()
        read = sum(p["numInputRows"] for p in query.recentProgress)
        landed = {
            s.name: sources.read_changes(spark, str(tmp_path / "l" / s.name), s) for s in specs[:2]
        }
        return read, {k: rows(x, "after.id") for k, x in landed.items()}

    broker.send_changes([change("c", k, 10) for k in range(6)])
    broker.send_changes([change("c", 7, 10)], topic="shop.inventory.other")
    broker.send_changes([change("c", 8, 10)], topic="shop.inventory.unknown")
    read, landed = step()
    assert read == 8
    assert landed == {"item": [(k,) for k in range(6)], "other": [(7,)]}
    broker.send_changes([change("c", 9, 10)], topic="shop.inventory.other")
    read, landed = step()
    assert read == 1
    assert landed == {"item": [(k,) for k in range(6)], "other": [(7,), (9,)]}
    assert step()[1] == landed
    # nothing but the tables' own files: no message was copied
    assert {p.name for p in (tmp_path / "l").iterdir()} == {"item", "other", "idle"}


def test_files_have_sizes_whatever_the_tasks(spark, broker, tmp_path):
    changes = log(spark, [change("c", k, 10, pos=k, partition=k % 4) for k in range(2000)])
    broker.send(sources.encode_envelope(changes, "shop.inventory.item").repartition(200))
    with settings(spark, {"spark.sql.files.openCostInBytes": str(1 << 27)}):  # a task per file
        assert spark.read.parquet(broker.folder).rdd.getNumPartitions() >= 200
        assert land(broker, tmp_path).count() == 2000
    files = glob.glob(str(tmp_path / "item/batch=0/partition=*/*.parquet"))
    assert len(files) == 4


def test_a_busy_partition_is_parted(spark, broker, tmp_path):
    rng = random.Random(1)
    changes = [change("c", k, 10, pos=k, name=rng.randbytes(200).hex()) for k in range(4000)]
    broker.send_changes(changes)
    assert land(broker, tmp_path, file_bytes=200_000).count() == 4000
    files = glob.glob(str(tmp_path / "item/batch=0/partition=0/*.parquet"))
    assert 3 <= len(files) <= 40


def test_a_batch_that_is_run_again_lands_once(spark, broker, tmp_path):
    """The checkpoint's note that a batch is done is lost, with and without a finished folder."""
    broker.send_changes([change("c", k, 10, partition=k % 2) for k in range(10)])
    land(broker, tmp_path)
    before = sorted(glob.glob(str(tmp_path / "item/**/*.parquet"), recursive=True))
    for finished in (True, False):
        for note in ("0", ".0.crc"):
            os.remove(tmp_path / "progress/commits" / note)
        if not finished:
            os.remove(tmp_path / "item/batch=0/_SUCCESS")
        assert land(broker, tmp_path).count() == 10
        after = sorted(glob.glob(str(tmp_path / "item/**/*.parquet"), recursive=True))
        assert (after == before) == finished and len(after) == len(before)


def test_a_folder_belongs_to_one_checkpoint(spark, broker, tmp_path):
    broker.send_changes([change("c", 1, 10)])
    land(broker, tmp_path)
    with pytest.raises(ValueError, match="another checkpoint"):
        streaming.land_changes(
            broker.stream(), ITEM, str(tmp_path / "item"), str(tmp_path / "other"), trigger=AVAILABLE_NOW
        )


def test_compaction_under_a_running_job(spark, broker, tmp_path):
    path, packed, name = str(tmp_path / "item"), str(tmp_path / "packed"), "live_log.item"
    sources.create_namespace(spark, "live_log", str(tmp_path / "live_log"))
    live = sources.LiveLog(spark, name, ITEM, path, packed)
    assert live.read().count() == 0 and live.compact() == -1
    everything = []
    for n in range(5):
        batch = [change("c", 10 * n + k, 10, pos=k, partition=k % 3) for k in range(6)]
        broker.send_changes(batch)
        land(broker, tmp_path)
        everything += batch
        live.sync()
        assert rows(live.read()) == rows(log(spark, everything))
        if n in (1, 3):
            assert live.compact() == n
            assert rows(live.read()) == rows(log(spark, everything))
        if n == 3:
            live.purge()
            assert rows(live.read()) == rows(log(spark, everything))
    assert sorted(os.listdir(packed)) == ["upto=3"]
    assert [x for x in sorted(os.listdir(path)) if x.startswith("batch=")] == ["batch=4"]
    assert len(glob.glob(f"{packed}/upto=3/*/*.parquet")) == 3
    # a second one over the same folders goes on where the first is
    assert sources.LiveLog(spark, name, ITEM, path, packed).compact() == 4
    # a batch that is not finished is left for later
    broker.send_changes([change("c", 99, 10)])
    land(broker, tmp_path)
    os.remove(f"{path}/batch=5/_SUCCESS")
    assert live.compact() == 4


@pytest.mark.parametrize("keywise", [False, True])
def test_refresh_stream_with_a_restart(spark, tmp_path, keywise):
    path, progress = str(tmp_path / "log"), str(tmp_path / "progress")
    store = LatestStore(
        spark, ITEM, f"stream_{keywise}", location=str(tmp_path / "latest"), keywise=keywise
    )
    batches = [
        [change("c", k, 100 + k) for k in range(20)],
        [change("u", k, 200 + k, name="new") for k in range(5)],
        [change("d", 3, 300), change("c", 3, 301, name="again"), change("d", 4, 302)],
        [change("u", 19, 110, name="late")],  # older than what is held
        [change("u", 9, 150, name="late")],  # newer than its row, below the mark
    ]
    everything = []
    for batch in batches:
        everything += batch
        sources.write_changes(log(spark, batch), path)
        # a batch per file brings changes out of order, which only the key-wise store can take
        files = 4 if keywise else None
        changes = sources.read_changes(
            spark, path, ITEM, streaming=True, max_files_per_trigger=files
        )
        streaming.incremental_stream(
            changes, store, progress, trigger=AVAILABLE_NOW
        ).awaitTermination()
    whole = {r["id"]: r["name"] for r in store.read().collect()}
    truth = ops.live(ops.latest_state(log(spark, everything), ITEM))
    expected = {r["id"]: r["name"] for r in truth.collect()}
    if not keywise:
        assert expected.pop(9) == "late"
        assert whole.pop(9) == "n"
    assert whole == expected
    # the last batch is known by the stream's id, which a restart keeps
    stream, number = store.properties()["epoch"].split("/")
    assert len(stream) == 36
    assert int(number) >= 4


def test_converge_stops_at_agreement_and_gives_up_at_the_limit(spark):
    source = spark.createDataFrame([(1, "a", 1.0)], "id BIGINT, name STRING, bal DOUBLE")
    tries = []

    def step(agree_at):
        def run():
            tries.append(1)
            latest = source if len(tries) >= agree_at else source.where("false")
            return ops.reconcile([(ITEM, source, latest)])

        return run

    report = streaming.converge(step(3), [ITEM], interval_s=0)
    assert rows(report) == [(True, "item", 0, 0, 1)]
    assert len(tries) == 3

    tries.clear()
    with pytest.raises(streaming.NotConverged) as failure:
        streaming.converge(step(99), [ITEM], max_tries=4, interval_s=0)
    assert len(tries) == 4
    assert failure.value.report[0]["num_missing"] == 1
