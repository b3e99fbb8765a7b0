"""A snapshot read in chunks while changes go on."""

from __future__ import annotations

import random

import pytest
from build import ITEM, change, log, rows

from tidemark import operators as ops
from tidemark.plans.queries import _handover, latest_columns

CHUNK = "floor(id / 10)"
COLUMNS = "id BIGINT, name STRING, bal DOUBLE"


class Table:
    """A table that changes under a reader, and its log."""

    def __init__(self, rng, n):
        self.rng, self.clock, self.log = rng, 100, []
        self.rows = {k: (k, f"start{k}", 0.0) for k in range(n)}

    def run(self, statements):
        for _ in range(statements):
            # several statements may fall into one millisecond
            self.clock += self.rng.choice([0, 0, 1, 3])
            k, pos = self.rng.randrange(70), len(self.log)
            if k in self.rows and self.rng.random() < 0.3:
                del self.rows[k]
                self.log.append(change("d", k, self.clock, pos=pos))
            else:
                op = "u" if k in self.rows else "c"
                self.rows[k] = (k, f"at{pos}", float(pos))
                self.log.append(change(op, k, self.clock, pos=pos, name=f"at{pos}", bal=float(pos)))

    def read(self, chunk):
        return [r for k, r in self.rows.items() if k // 10 == chunk]


@pytest.mark.parametrize("seed", range(4))
def test_chunks_in_any_order(spark, seed):
    rng = random.Random(seed)
    table = Table(rng, 60)
    read, marks = [], []
    chunks = list(range(7))
    rng.shuffle(chunks)
    for chunk in chunks:
        low = table.clock
        table.run(rng.randrange(12))
        read += table.read(chunk)
        table.run(rng.randrange(12))
        marks.append((chunk, low, table.clock))
    table.run(20)
    merged = ops.snapshot_with_changes(
        spark.createDataFrame(read, COLUMNS),
        spark.createDataFrame(marks, "chunk BIGINT, low BIGINT, high BIGINT"),
        log(spark, table.log),
        ITEM,
        CHUNK,
    )
    live = ops.live(ops.latest_state(merged, ITEM))
    assert rows(live, "id", "name", "bal") == sorted(table.rows.values(), key=repr)
    # no more than one read event a row, and none where the log has a change in the meantime
    events = merged.where("op = 'r'")
    assert events.count() <= len(read)
    assert events.select("after.id").distinct().count() == events.count()


def test_a_chunk_without_marks_fails(spark):
    rows_read = spark.createDataFrame([(1, "a", 0.0), (25, "b", 0.0)], COLUMNS)
    marks = spark.createDataFrame([(0, 5, 6)], "chunk BIGINT, low BIGINT, high BIGINT")
    merged = ops.snapshot_with_changes(rows_read, marks, log(spark, []), ITEM, CHUNK)
    with pytest.raises(Exception, match="no marks of chunk 2"):
        merged.collect()


def test_nothing_and_null_keys(spark):
    marks = spark.createDataFrame([(0, 5, 6), (None, 5, 6)], "chunk BIGINT, low BIGINT, high BIGINT")
    empty = spark.createDataFrame([], COLUMNS)
    changes = log(spark, [change("u", 3, 5)])
    merged = ops.snapshot_with_changes(empty, marks, changes, ITEM, CHUNK)
    assert rows(merged, "op", "ts_ms") == [("u", 5)]
    assert merged.columns == changes.columns


@pytest.mark.parametrize("step", [1, 7, 11])
def test_the_query_in_other_orders(spark, step):
    small = "/root/testdata/sf0.001"
    assert rows(_handover(spark, small, step)) == rows(latest_columns(spark, small))
