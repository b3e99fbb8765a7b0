from __future__ import annotations

import glob

import pytest
from build import ITEM, rows

from tidemark import PRODUCTS
from tidemark import operators as ops

COLUMNS = "id BIGINT, name STRING, bal DOUBLE"


@pytest.fixture(scope="module")
def sides(spark):
    source = spark.createDataFrame(
        [(1, "a", 1.0), (2, None, 2.0), (3, "c", None), (4, "d", 4.0), (4, "d", 4.0)], COLUMNS
    )
    latest = spark.createDataFrame(
        [(1, "a", 1.0), (2, None, 2.0), (3, "c", 3.0), (9, "z", 9.0), (9, "z", 9.0)], COLUMNS
    )
    return source, latest


def test_differences_are_sets_and_nulls_are_equal(sides):
    source, latest = sides
    assert rows(ops.missing(source, latest, ITEM)) == [(3, "c", None), (4, "d", 4.0)]
    assert rows(ops.stale(source, latest, ITEM)) == [(3, "c", 3.0), (9, "z", 9.0)]
    assert rows(ops.missing(source, latest, ITEM)) == rows(source.subtract(latest))
    assert rows(ops.stale(source, latest, ITEM)) == rows(latest.subtract(source))


def test_report(sides):
    source, latest = sides
    assert rows(ops.reconcile([(ITEM, source, latest)])) == [(False, "item", 2, 2, 5)]
    # copies are no difference, but they count
    assert rows(ops.reconcile([(ITEM, source, source.distinct())])) == [(True, "item", 0, 0, 5)]


def test_empty_tables(sides):
    source, _ = sides
    empty = source.where("false")
    assert rows(ops.reconcile([(ITEM, empty, empty)])) == [(True, "item", 0, 0, 0)]
    assert rows(ops.reconcile([(ITEM, source, empty)])) == [(False, "item", 4, 0, 5)]


def test_columns_are_matched_by_name_and_type(spark, sides):
    source, _ = sides
    other = source.selectExpr("CAST(bal AS FLOAT) AS bal", "CAST(id AS INT) AS id", "name")
    report = ops.reconcile([(ITEM, other, source)])
    assert rows(report) == [(True, "item", 0, 0, 5)]


def test_converged_needs_every_table(spark, sides):
    source, latest = sides
    agree = ops.reconcile([(ITEM, source, source)])
    assert ops.converged(agree, [ITEM])
    assert not ops.converged(ops.reconcile([(ITEM, source, latest)]), [ITEM])
    assert not ops.converged(agree, [ITEM, PRODUCTS])
    assert not ops.converged(agree.where("false"), [ITEM])
    assert not ops.converged(agree.unionAll(agree), [ITEM])


def test_written_report(sides, tmp_path):
    source, latest = sides
    path = str(tmp_path / "report")
    ops.write_report(ops.reconcile([(ITEM, source, latest)]), path)
    (file,) = glob.glob(f"{path}/*.csv")
    with open(file) as lines:
        assert lines.read().splitlines() == [
            "match,name,num_missing,num_stale,num_total",
            "false,item,2,2,5",
        ]
