"""Every registered query against its SQL counterpart, and the counts they must give."""

from __future__ import annotations

import pytest
from compare import spark_rows, sql_rows, sql_tables

from __spark_entry__ import entry, oracle_sql, queries
from tidemark.plans.oracle import ORACLE
from tidemark.plans.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def sql():
    return sql_tables(SMALL)


def test_every_query_has_a_counterpart():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= queries().keys()
    assert oracle_sql().keys() <= queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sql, name):
    found = spark_rows(queries()[name](spark, SMALL))
    assert sum(found[1].values()) > 0
    assert found == sql_rows(sql, oracle_sql()[name])


def test_entry(spark):
    assert entry(spark).columns == ["id", "name", "bal", "ts"]
    assert entry(spark).count() == 135


@pytest.mark.parametrize(
    ("name", "n"),
    [
        ("change_scan", 1500 + 600 + 117 + 215 + 61),
        ("live_rows", 1346),
        ("changed_keys", 245),
        ("apply_delta", 1346),
        ("late_changes", 78),
    ],
)
def test_known_sizes(spark, name, n):
    assert queries()[name](spark, MEDIUM).count() == n


def test_report_sizes(spark):
    report = {r["name"]: r for r in queries()["reconcile"](spark, MEDIUM).collect()}
    assert {n: (r["num_missing"], r["num_stale"], r["num_total"]) for n, r in report.items()} == {
        "customer": (78, 78, 1346),
        "part": (104, 104, 1795),
    }
    assert not any(r["result"] for r in report.values())
