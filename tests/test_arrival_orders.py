"""Random logs, cut into batches and shuffled. Every key is a small log of its own, so one
run covers hundreds of cases; the expected result is computed in plain Python."""

from __future__ import annotations

import random

import pytest
from build import ITEM, at, change, log, rows

from tidemark import operators as ops
from tidemark.operators.keywise import keyed_state

N_KEYS = 300


def history(key, rng, ties):
    """Events of one key in log order."""
    ts, events = 1000 * rng.randint(1, 5), []
    for pos in range(rng.randint(1, 7)):
        ts += rng.choice([0, 1, 7]) if ties else rng.randint(1, 9)
        op = rng.choice("cuud")
        events.append(change(op, key, ts, pos=pos, name=f"{key}.{pos}", bal=rng.random()))
    return events


def expected(changes):
    newest = {}
    for c in changes:
        key = (c["after"] or c["before"])["id"]
        place = (c["ts_ms"], c["source"]["pos"])
        if key not in newest or place > newest[key][0]:
            newest[key] = (place, c)
    return sorted(
        (
            (k, c["after"]["name"], c["after"]["bal"], at(c["ts_ms"]))
            for k, (_, c) in newest.items()
            if c["op"] != "d"
        ),
        key=repr,
    )


@pytest.mark.parametrize("seed", range(3))
def test_keywise_is_right_for_every_arrival_order(spark, seed):
    rng = random.Random(seed)
    changes = [c for k in range(N_KEYS) for c in history(k, rng, ties=True)]
    rng.shuffle(changes)
    third = len(changes) // 3
    batches = [changes[:third], changes[third : 2 * third], changes[third - 50 :]]  # with replay
    state = keyed_state(log(spark, batches[0]), ITEM)
    for batch in batches[1:]:
        state = ops.apply_keywise(state, log(spark, batch), ITEM)
    assert rows(ops.live(state)) == expected(changes)


def test_keywise_replay_changes_nothing(spark):
    rng = random.Random(7)
    changes = log(spark, [c for k in range(50) for c in history(k, rng, ties=True)])
    state = keyed_state(changes, ITEM)
    assert rows(ops.apply_keywise(state, changes, ITEM)) == rows(state)


def test_keywise_with_full_ties_and_null_keys(spark):
    nothing = {"before": None, "after": None}
    changes = [change("u", 1, 10, name=f"n{i}") for i in range(6)]
    changes += [change("c", 0, t, **nothing) for t in (5, 6)]
    whole = rows(keyed_state(log(spark, changes), ITEM))
    for cut in (1, 3, 7):
        state = keyed_state(log(spark, changes[:cut]), ITEM)
        assert rows(ops.apply_keywise(state, log(spark, changes[cut:]), ITEM)) == whole


@pytest.mark.parametrize("seed", range(3))
def test_folding_batches_equals_the_whole_log_when_nothing_is_late(spark, seed):
    rng = random.Random(100 + seed)
    changes = [c for k in range(N_KEYS) for c in history(k, rng, ties=False)]
    # one clock for all keys, without ties
    changes.sort(key=lambda c: (c["ts_ms"], rng.random()))
    for ts, c in enumerate(changes):
        c["ts_ms"] = 10_000 + ts
    cuts = sorted(rng.sample(range(1, len(changes)), 2))
    batches = [changes[: cuts[0]], changes[cuts[0] : cuts[1]], changes[cuts[1] :]]
    latest = ops.live(ops.latest_state(log(spark, batches[0]), ITEM))
    for batch in batches[1:]:
        latest = ops.apply_delta(latest, log(spark, batch), ITEM)
    assert rows(latest) == expected(changes)
