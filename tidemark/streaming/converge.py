"""Waiting until the latest tables agree with their sources."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Row

from tidemark.operators.reconcile import converged
from tidemark.schema import TableSpec

# Tries and seconds between them.
MAX_TRIES, INTERVAL_S = 15, 5.0


class NotConverged(RuntimeError):
    """The tables still differ after the last try; ``report`` holds the last report."""

    def __init__(self, report: list[Row]) -> None:
        super().__init__(f"not converged: {report}")
        self.report = report


def converge(
    step: Callable[[], DataFrame],
    specs: Iterable[TableSpec],
    max_tries: int = MAX_TRIES,
    interval_s: float = INTERVAL_S,
) -> DataFrame:
    """Repeat ``step`` (refresh, then reconcile) until its report shows agreement.

    Each report is collected, one row per table, so that a step runs once per try.
    """
    specs = list(specs)
    rows: list[Row] = []
    for attempt in range(max_tries):
        if attempt:
            time.sleep(interval_s)
        report = step()
        rows = report.collect()
        if converged(rows, specs):
            return report.sparkSession.createDataFrame(rows, report.schema)
    raise NotConverged(rows)
