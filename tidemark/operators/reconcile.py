"""Reconciliation of the latest tables with their sources."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tidemark.schema import TableSpec
from tidemark.sources.tables import conform

REPORT_COLUMNS = ["result", "name", "num_missing", "num_stale", "num_total"]


def compare_rows(source: DataFrame, latest: DataFrame, spec: TableSpec) -> DataFrame:
    """Distinct rows of both sides with how often each occurs (``in_source``, ``in_latest``).

    Grouping treats NULLs as equal and compares exactly, as EXCEPT does, but answers both
    directions and the total in one pass with one shuffle. Copies of a row are counted
    before the shuffle, so no row value can make a partition hot.
    """
    sides = (
        conform(source, spec)
        .select("*", F.lit(1).alias("__source"), F.lit(0).alias("__latest"))
        .unionAll(
            conform(latest, spec).select(
                "*", F.lit(0).alias("__source"), F.lit(1).alias("__latest")
            )
        )
    )
    return sides.groupBy(*spec.columns).agg(
        F.sum("__source").alias("in_source"), F.sum("__latest").alias("in_latest")
    )


def missing(source: DataFrame, latest: DataFrame, spec: TableSpec) -> DataFrame:
    """Distinct source rows that the latest table does not have yet."""
    rows = compare_rows(source, latest, spec)
    return rows.where((F.col("in_source") > 0) & (F.col("in_latest") == 0)).select(*spec.columns)


def stale(source: DataFrame, latest: DataFrame, spec: TableSpec) -> DataFrame:
    """Distinct rows of the latest table that the source no longer has."""
    rows = compare_rows(source, latest, spec)
    return rows.where((F.col("in_source") == 0) & (F.col("in_latest") > 0)).select(*spec.columns)


def _report(spec: TableSpec, source: DataFrame, latest: DataFrame) -> DataFrame:
    counts = compare_rows(source, latest, spec).agg(
        F.count_if(F.col("in_latest") == 0).alias("num_missing"),
        F.count_if(F.col("in_source") == 0).alias("num_stale"),
        F.coalesce(F.sum("in_source"), F.lit(0)).alias("num_total"),
    )
    settled = (F.col("num_missing") == 0) & (F.col("num_stale") == 0)
    return counts.select(
        settled.alias("result"),
        F.lit(spec.name).alias("name"),
        "num_missing",
        "num_stale",
        "num_total",
    )


def reconcile(tables: Iterable[tuple[TableSpec, DataFrame, DataFrame]]) -> DataFrame:
    """One report row per (spec, source, latest)."""
    return reduce(DataFrame.unionByName, (_report(*table) for table in tables))


def converged(report: DataFrame | Sequence[Row], specs: Iterable[TableSpec]) -> bool:
    """Whether every configured table is reported, once, and in agreement with its source.

    An empty report is a failure to check, not a success.
    """
    rows = report.select("name", "result").collect() if isinstance(report, DataFrame) else report
    expected = sorted(spec.name for spec in specs)
    return sorted(r["name"] for r in rows) == expected and all(r["result"] for r in rows)


def write_report(report: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write the report as one CSV file with a header. It has one row per table."""
    (
        report.select(*REPORT_COLUMNS)
        .withColumnRenamed("result", "match")
        .coalesce(1)
        .write.mode(mode)
        .option("header", True)
        .csv(path)
    )
