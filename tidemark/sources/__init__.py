"""Reading change logs, messages and source tables."""

from tidemark.sources.changes import (
    LiveLog,
    compact_log,
    create_change_table,
    create_namespace,
    read_changes,
    sync_partitions,
    write_changes,
)
from tidemark.sources.jdbc import read_jdbc
from tidemark.sources.messages import decode_envelope, encode_envelope, kafka_messages
from tidemark.sources.tables import conform

__all__ = [
    "LiveLog",
    "compact_log",
    "conform",
    "create_change_table",
    "create_namespace",
    "decode_envelope",
    "encode_envelope",
    "kafka_messages",
    "read_changes",
    "read_jdbc",
    "sync_partitions",
    "write_changes",
]
