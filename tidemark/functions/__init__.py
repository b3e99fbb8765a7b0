"""Column expressions over change envelopes."""

from tidemark.functions.envelope import (
    change_order,
    change_record,
    change_ts,
    epoch_millis,
    key_columns,
    mark_millis,
    order_values,
)

__all__ = [
    "change_order",
    "change_record",
    "change_ts",
    "epoch_millis",
    "key_columns",
    "mark_millis",
    "order_values",
]
