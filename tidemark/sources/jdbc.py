"""Live relational tables over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegralType

from tidemark.schema import TableSpec
from tidemark.sources.tables import conform

DEFAULT_PARTITIONS = 16


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    spec: TableSpec | None = None,
    partition_column: str | None = None,
    num_partitions: int = DEFAULT_PARTITIONS,
    fetch_size: int = 10_000,
    **options: str,
) -> DataFrame:
    """A table of a relational database, read in parallel over ranges of ``partition_column``.

    The range bounds are asked of the database; they only set the stride, so rows outside
    them (inserted meanwhile) are still read. The partition column defaults to the key of
    ``spec`` where that is one whole number. Where there is none, ``num_partitions=1`` has to
    be asked for: a single connection suits small tables only.
    """
    if partition_column is None and spec is not None and len(spec.key) == 1:
        if isinstance(spec.record[spec.key[0]].dataType, IntegralType):
            partition_column = spec.key[0]
    if partition_column is None and num_partitions != 1:
        raise ValueError(f"{table}: name a partition column, or ask for num_partitions=1")
    base = {"url": url, "fetchsize": str(fetch_size), **options}
    reader = spark.read.format("jdbc").options(**base)
    if partition_column and num_partitions > 1:
        bounds = (
            spark.read.format("jdbc")
            .options(**base)
            .option(
                "query",
                f"SELECT min({partition_column}) AS lo, max({partition_column}) AS hi FROM {table}",
            )
            .load()
            .first()
        )
        if bounds[0] is not None:
            reader = reader.options(
                partitionColumn=partition_column,
                numPartitions=str(num_partitions),
                lowerBound=str(bounds[0]),
                upperBound=str(bounds[1]),
            )
    rows = reader.option("dbtable", table).load()
    return conform(rows, spec) if spec else rows
