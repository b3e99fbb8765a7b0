"""Table specifications and the change-envelope schema.

Every operator takes a :class:`TableSpec`; adding a table is a matter of describing it, not
of writing another copy of the queries.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

def record_type(**columns: str) -> T.StructType:
    """Struct of simple types, e.g. ``record_type(id="long", city="string")``."""
    record = T.StructType()
    for name, kind in columns.items():
        record = record.add(name, kind)
    return record


# The envelope's provenance and transaction blocks, in wire order.
SOURCE_TYPE = record_type(
    version="string",
    connector="string",
    name="string",
    ts_ms="long",
    snapshot="string",
    db="string",
    sequence="string",
    table="string",
    server_id="long",
    gtid="string",
    file="string",
    pos="long",
    row="integer",
    thread="long",
    query="string",
)
TRANSACTION_TYPE = record_type(id="string", total_order="long", data_collection_order="long")

# Operation codes. Only DELETE is ever tested for.
SNAPSHOT, CREATE, UPDATE, DELETE = "r", "c", "u", "d"


@dataclass(frozen=True)
class TableSpec:
    """A captured table: its row type, its key, and how changes of equal time are ordered."""

    name: str
    record: T.StructType
    key: tuple[str, ...] = ("id",)
    tiebreak: tuple[str, ...] = ("source.file", "source.pos", "source.row")

    def __post_init__(self) -> None:
        # accept any sequence, keep the spec hashable
        object.__setattr__(self, "key", tuple(self.key))
        object.__setattr__(self, "tiebreak", tuple(self.tiebreak))
        unknown = [k for k in self.key if k not in self.record.names]
        if not self.key or unknown:
            raise ValueError(f"{self.name}: key {self.key} must name record columns, not {unknown}")

    @property
    def columns(self) -> list[str]:
        return list(self.record.names)


def envelope_schema(record: T.StructType) -> T.StructType:
    """Schema of a change log whose rows carry ``record`` before and after each change.

    ``partition`` is the directory column of the landed files.
    """
    return T.StructType(
        [
            T.StructField("before", record),
            T.StructField("after", record),
            T.StructField("source", SOURCE_TYPE),
            T.StructField("op", T.StringType()),
            T.StructField("ts_ms", T.LongType()),
            T.StructField("transaction", TRANSACTION_TYPE),
            T.StructField("partition", T.IntegerType()),
        ]
    )


# The two captured tables of the demo inventory.
ADDRESSES = TableSpec(
    "addresses",
    record_type(
        id="long",
        customer_id="long",
        street="string",
        city="string",
        state="string",
        zip="string",
        type="string",
    ),
)
PRODUCTS = TableSpec(
    "products", record_type(id="long", name="string", description="string", weight="double")
)
