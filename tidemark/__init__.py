"""Change-data-capture analytics on PySpark."""

from tidemark.catalog import ChangeCatalog
from tidemark.schema import ADDRESSES, PRODUCTS, TableSpec, envelope_schema, record_type
from tidemark.store import LatestStore

__all__ = [
    "ADDRESSES",
    "PRODUCTS",
    "ChangeCatalog",
    "LatestStore",
    "TableSpec",
    "envelope_schema",
    "record_type",
]
