"""Batch operators: plain DataFrame transformations configured by a TableSpec."""

from tidemark.operators.capture import (
    apply_dml,
    capture_changes,
    snapshot_events,
    snapshot_with_changes,
)
from tidemark.operators.delta import (
    apply_delta,
    changed_keys,
    changed_since,
    delete_changed,
    delete_few,
    footer_mark,
    high_watermark,
    insert_changed,
    newer_than,
    rows_to_replace,
    store_keys,
    stored_mark,
    write_marked,
)
from tidemark.operators.digest import (
    differing,
    read_by_bucket,
    reconcile_digest,
    rows_to_compare,
    write_by_bucket,
)
from tidemark.operators.keywise import apply_keywise, keyed_state, write_keyed_state
from tidemark.operators.latest import (
    create_latest_view,
    latest_columns,
    latest_state,
    live,
    live_rows,
    with_record,
)
from tidemark.operators.ranking import change_rank
from tidemark.operators.reconcile import (
    compare_rows,
    converged,
    missing,
    reconcile,
    stale,
    write_report,
)

__all__ = [
    "apply_delta",
    "apply_dml",
    "apply_keywise",
    "capture_changes",
    "change_rank",
    "changed_keys",
    "changed_since",
    "compare_rows",
    "converged",
    "create_latest_view",
    "delete_changed",
    "delete_few",
    "differing",
    "footer_mark",
    "high_watermark",
    "insert_changed",
    "keyed_state",
    "latest_columns",
    "latest_state",
    "live",
    "live_rows",
    "missing",
    "newer_than",
    "read_by_bucket",
    "reconcile",
    "reconcile_digest",
    "rows_to_compare",
    "rows_to_replace",
    "snapshot_events",
    "snapshot_with_changes",
    "stale",
    "store_keys",
    "stored_mark",
    "with_record",
    "write_by_bucket",
    "write_keyed_state",
    "write_marked",
    "write_report",
]
