"""Source tables as ground truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schema import TableSpec


def conform(table: DataFrame, spec: TableSpec, *more: Column) -> DataFrame:
    """The record columns of ``table``, by name, in record order and type, and any ``more``.

    Row comparison is positional and exact, so a source whose driver reports FLOAT for a
    DOUBLE column, or another column order, has to be brought to the record type first.
    """
    given = {f.name: f.dataType for f in table.schema}
    return table.select(
        *(
            f.name
            if given.get(f.name) == f.dataType
            else F.col(f.name).cast(f.dataType).alias(f.name)
            for f in spec.record
        ),
        *more,
    )
