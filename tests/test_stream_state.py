"""The latest state as the state of a streaming query."""

from __future__ import annotations

import random

import pytest
from build import ITEM, change, log, rows
from test_arrival_orders import N_KEYS, expected, history

from tidemark import operators as ops
from tidemark import sources, streaming
from tidemark.schema import TableSpec, record_type
from tidemark.streaming.landing import AVAILABLE_NOW


def run(spark, path, checkpoint, spec=ITEM, **options):
    changes = sources.read_changes(spark, path, spec, streaming=True)
    streaming.latest_stream_state(
        changes, spec, checkpoint, trigger=AVAILABLE_NOW, **options
    ).awaitTermination()


@pytest.mark.parametrize("seed", range(2))
def test_any_arrival_order_over_restarts(spark, tmp_path, seed):
    rng = random.Random(seed)
    changes = [c for k in range(N_KEYS) for c in history(k, rng, ties=True)]
    rng.shuffle(changes)
    third = len(changes) // 3
    path, checkpoint = str(tmp_path / "log"), str(tmp_path / "progress")
    seen = []
    for batch in (changes[:third], changes[third : 2 * third], changes[third - 50 :]):  # with replay
        sources.write_changes(log(spark, batch), path)
        run(spark, path, checkpoint)
        seen += batch
        found = streaming.read_stream_state(spark, checkpoint)
        assert rows(ops.live(found)) == expected(seen)
    # deletes are remembered, and an older batch can still be read
    whole = ops.latest_state(log(spark, changes), ITEM)
    assert rows(found) == rows(whole)
    first = streaming.read_stream_state(spark, checkpoint, batch=0)
    assert rows(ops.live(first)) == expected(changes[:third])


def test_a_late_update_revives_nothing(spark, tmp_path):
    path, checkpoint = str(tmp_path / "log"), str(tmp_path / "progress")
    for c in (change("c", 1, 10), change("d", 1, 30), change("u", 1, 20, bal=5.0)):
        sources.write_changes(log(spark, [c]), path)
        run(spark, path, checkpoint)
    assert rows(ops.live(streaming.read_stream_state(spark, checkpoint))) == []
    assert streaming.read_stream_state(spark, checkpoint).count() == 1


def test_the_sink_gets_what_a_batch_changed(spark, tmp_path):
    path, checkpoint = str(tmp_path / "log"), str(tmp_path / "progress")
    handed = []

    def sink(batch, number):
        handed.append((number, sorted(r["record"]["id"] for r in batch.collect())))

    for batch in ([change("c", k, 10) for k in range(5)], [change("u", 3, 20), change("d", 4, 20)]):
        sources.write_changes(log(spark, batch), path)
        run(spark, path, checkpoint, sink=sink)
    assert handed == [(0, [0, 1, 2, 3, 4]), (1, [3, 4])]


def test_null_and_composite_keys(spark, tmp_path):
    spec = TableSpec("t", record_type(a="string", b="date", v="long"), key=["a", "b"])
    images = [
        {"a": a, "b": None, "v": v} for v, a in enumerate(["0", None, "0", None, "1970-01-01"])
    ]
    changes = log(spark, [change("c", 0, v, after=image) for v, image in enumerate(images)], spec)
    path, checkpoint = str(tmp_path / "log"), str(tmp_path / "progress")
    sources.write_changes(changes, path)
    run(spark, path, checkpoint, spec)
    found = rows(ops.live(streaming.read_stream_state(spark, checkpoint)), "a", "b", "v")
    assert found == rows(ops.live(ops.latest_state(changes, spec)), "a", "b", "v")
    assert len(found) == 3


def test_settings_are_put_back(spark, tmp_path):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    path, checkpoint = str(tmp_path / "log"), str(tmp_path / "progress")
    sources.write_changes(log(spark, [change("c", 1, 10)]), path)
    run(spark, path, checkpoint)
    assert spark.conf.get(name) == before
    # the plain provider works as well
    other = str(tmp_path / "other")
    run(spark, path, other, settings={})
    assert streaming.read_stream_state(spark, other, settings={}).count() == 1
