"""SQL counterparts of the registered queries, over the given tables only.

Each statement derives the log in a CTE and then spells the operator out in plain SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from tidemark.plans import logs
from tidemark.plans.logs import CUSTOMER, EVENTS, ON_TIME, PART, Event, LogTable


def _log(events: Sequence[Event] = EVENTS, log: LogTable = CUSTOMER, name: str = "log") -> str:
    """CTEs ``<name>_base`` (the table) and ``<name>`` (one row per change, flat)."""
    branches = []
    for e in events:
        has_before = "true" if e.op in "ud" else "false"
        has_after = "false" if e.op == "d" else "true"
        branches.append(
            f"SELECT {e.batch} AS batch, '{e.op}' AS op, {e.id} AS id, name, "
            f"bal AS old_bal, {e.value or 'bal'} AS bal, {e.ts_ms} AS ts_ms, "
            f"{e.position} AS pos, CAST(k % 4 AS INTEGER) AS part, "
            f"{has_before} AS has_before, {has_after} AS has_after "
            f"FROM {name}_base WHERE {e.keys}"
        )
    base = f"SELECT {log.key} AS k, {log.label} AS name, {log.value} AS bal FROM {log.table}"
    return f"{name}_base AS ({base}), {name} AS ({' UNION ALL '.join(branches)})"


def _state(name: str, source: str, where: str = "true") -> str:
    """CTE of the newest change per id."""
    return (
        f"{name} AS (SELECT * FROM (SELECT *, epoch_ms(ts_ms) AS ts, row_number() OVER "
        f"(PARTITION BY id ORDER BY ts_ms DESC, pos DESC) AS row_num FROM {source} "
        f"WHERE {where}) WHERE row_num = 1)"
    )


def _live(name: str, state: str) -> str:
    return f"{name} AS (SELECT id, name, bal, ts FROM {state} WHERE op <> 'd')"


def _refresh(log: str = "log", prefix: str = "") -> str:
    """CTEs: latest of batch 1, its mark, changes since, survivors, refreshed, truth."""
    p = prefix
    return ", ".join(
        [
            _state(f"{p}state_1", log, "batch = 1"),
            _live(f"{p}latest_1", f"{p}state_1"),
            f"{p}mark AS (SELECT max(ts) AS ts FROM {p}latest_1)",
            _state(f"{p}whole", log),
            f"{p}since AS (SELECT w.* FROM {p}whole w, {p}mark m WHERE w.ts > m.ts)",
            f"{p}kept AS (SELECT l.* FROM {p}latest_1 l WHERE NOT EXISTS "
            f"(SELECT 1 FROM {p}since s WHERE s.id = l.id))",
            f"{p}upserts AS (SELECT id, name, bal, ts FROM {p}since WHERE op <> 'd')",
            f"{p}refreshed AS (SELECT * FROM {p}kept UNION ALL SELECT * FROM {p}upserts)",
            _live(f"{p}truth", f"{p}whole"),
        ]
    )


LOG = f"WITH {_log()}"
STATE = f"{LOG}, {_state('state', 'log')}"
LIVE = f"{STATE}, {_live('live', 'state')}"
REFRESH = f"{LOG}, {_refresh()}"

_LIVE_ROWS = f"{LIVE} SELECT id, name, bal, ts FROM live"
_STATE_ROWS = f"{STATE} SELECT id, name, bal, op, ts FROM state"
_REFRESHED = f"{REFRESH} SELECT id, name, bal, ts FROM refreshed"
_LANDED = "SELECT op, ts_ms, pos, part AS partition, id FROM log"

_MISSING = (
    "(SELECT id, name, bal FROM {p}truth) EXCEPT (SELECT id, name, bal FROM {p}refreshed)"
)
_STALE = "(SELECT id, name, bal FROM {p}refreshed) EXCEPT (SELECT id, name, bal FROM {p}truth)"


def _report_row(log: LogTable, prefix: str, match: str) -> str:
    p = prefix
    return (
        f"SELECT num_missing = 0 AND num_stale = 0 AS {match}, name, num_missing, num_stale, "
        f"num_total FROM (SELECT '{log.table}' AS name, "
        f"(SELECT count(*) FROM ({_MISSING.format(p=p)})) AS num_missing, "
        f"(SELECT count(*) FROM ({_STALE.format(p=p)})) AS num_stale, "
        f"(SELECT count(*) FROM {p}truth) AS num_total)"
    )


def _report(match: str) -> str:
    ctes = ", ".join(
        f"{_log(EVENTS, log, f'{log.table}_log')}, "
        f"{_refresh(f'{log.table}_log', f'{log.table}_')}"
        for log in (CUSTOMER, PART)
    )
    rows = " UNION ALL ".join(
        f"({_report_row(log, f'{log.table}_', match)})" for log in (CUSTOMER, PART)
    )
    return f"WITH {ctes} {rows}"


def _agreed(events: Sequence[Event]) -> str:
    """The report of tables that hold what their logs amount to."""
    ctes, rows = [], []
    for log in (CUSTOMER, PART):
        t = log.table
        ctes += [_log(events, log, f"{t}_log"), _state(f"{t}_state", f"{t}_log")]
        rows.append(
            f"SELECT true AS result, '{t}' AS name, CAST(0 AS BIGINT) AS num_missing, "
            f"CAST(0 AS BIGINT) AS num_stale, "
            f"count(*) AS num_total FROM {t}_state WHERE op <> 'd'"
        )
    return f"WITH {', '.join(ctes)} {' UNION ALL '.join(rows)}"


# The statements run against the source table, folded into one query.
_SHOP_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
_MUTATED = f"""mutated AS (
    SELECT {', '.join(_SHOP_COLUMNS)} FROM customer
    WHERE NOT (c_mktsegment = 'FURNITURE' AND c_acctbal < 0)
    UNION ALL
    SELECT s_suppkey + CAST({logs.NEW_KEYS} AS BIGINT), s_name, s_nationkey,
           CASE WHEN s_nationkey > 12 THEN s_acctbal + 10 ELSE s_acctbal END,
           CASE WHEN s_nationkey > 12 THEN 'SHIPPING' ELSE 'LIVING' END
    FROM supplier WHERE s_acctbal >= 0
)"""
_CAPTURED = f"""WITH {_MUTATED}
SELECT CASE WHEN o.c_custkey IS NULL THEN 'c' WHEN n.c_custkey IS NULL THEN 'd' ELSE 'u' END AS op,
       {', '.join(f'o.{c} AS before_{c}' for c in _SHOP_COLUMNS)},
       {', '.join(f'n.{c} AS after_{c}' for c in _SHOP_COLUMNS)}
FROM customer o FULL OUTER JOIN mutated n ON o.c_custkey = n.c_custkey
WHERE o.c_custkey IS NULL OR n.c_custkey IS NULL
   OR {' OR '.join(f'o.{c} IS DISTINCT FROM n.{c}' for c in _SHOP_COLUMNS[1:])}"""


def _newest(columns: str, table: str, key: str, order: str) -> str:
    return (
        f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {key} "
        f"ORDER BY {order}) AS age FROM {table}) WHERE age = 1"
    )


_ORDER_COLUMNS = "o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate AS ts"
_NEWEST_ORDER = "o_orderdate DESC, o_orderkey DESC"
_LINE_ORDER = ", ".join(f"{c} DESC" for c in ["l_shipdate", *logs.LINE_COLUMNS])

_FALLING = f"WITH {_log(logs.FALLING_MARK)}, {_refresh()}"

_SCANNED = (
    f"{LOG} SELECT op, ts_ms, pos, part AS partition, "
    "CASE WHEN has_before THEN id END AS before_id, "
    "CASE WHEN has_after THEN id END AS after_id FROM log"
)

ORACLE: dict[str, str] = {
    "change_scan": _SCANNED,
    "compact_log": _SCANNED,
    "partition_sync": f"{LOG} SELECT part AS partition, count(*) AS n FROM log GROUP BY part",
    "land_changes": f"{LOG} {_LANDED}",
    "land_topics": f"WITH {_log(EVENTS, CUSTOMER, 'customer_log')}, "
    f"{_log(EVENTS, PART, 'part_log')} "
    + " UNION ALL ".join(
        f"SELECT '{t}' AS name, op, ts_ms, pos, part AS partition, id FROM {t}_log"
        for t in ("customer", "part")
    ),
    "compact_live_log": f"{LOG} {_LANDED}",
    "decode_envelope": f"{LOG} SELECT op, ts_ms, CASE WHEN has_after THEN id END AS id, "
    "CASE WHEN has_after THEN name END AS name, CASE WHEN has_after THEN bal END AS bal FROM log",
    "decode_envelope_wrapped": f"{LOG} SELECT op, ts_ms, CASE WHEN has_after THEN id END AS id, "
    "CASE WHEN has_after THEN name END AS name, CASE WHEN has_after THEN bal END AS bal FROM log",
    "source_scan": f"SELECT {', '.join(_SHOP_COLUMNS)} FROM customer",
    "source_dml": f"WITH {_MUTATED} SELECT * FROM mutated",
    "snapshot_events": f"SELECT 'r' AS op, CAST({logs.T0} AS BIGINT) AS ts_ms, "
    f"'true' AS snapshot, true AS no_before, {', '.join(_SHOP_COLUMNS)} FROM customer",
    "capture_changes": _CAPTURED,
    "snapshot_with_changes": f"{LIVE} SELECT id, name, bal FROM live",
    "workload": f"WITH {_MUTATED} SELECT * FROM mutated",
    "change_record": f"{LOG} SELECT op, ts_ms, id, name, bal FROM log",
    "flatten_record": f"{LOG} SELECT id, name, bal, op FROM log",
    "change_ts": f"{LOG} SELECT pos, epoch_ms(ts_ms) AS ts FROM log",
    "change_rank": f"{LOG} SELECT id, ts_ms, pos, row_number() OVER "
    "(PARTITION BY id ORDER BY ts_ms DESC, pos DESC) AS row_num FROM log",
    "latest_state": _STATE_ROWS,
    "latest_view": _STATE_ROWS,
    "live_rows": _LIVE_ROWS,
    "latest_columns": f"{LIVE} SELECT id, name, bal FROM live",
    "latest_events": _newest(
        "user_id, event_type, value, props, CASE event_type WHEN 'error' THEN 'd' "
        "WHEN 'signup' THEN 'c' ELSE 'u' END AS op, date_trunc('millisecond', ts) AS ts",
        "events",
        "user_id",
        "epoch_ms(ts) DESC, event_id DESC",
    ),
    "latest_order_of_customer": _newest(_ORDER_COLUMNS, "orders", "o_custkey", _NEWEST_ORDER),
    "latest_order_of_status": _newest(_ORDER_COLUMNS, "orders", "o_orderstatus", _NEWEST_ORDER),
    "order_rank_of_status": "SELECT o_orderstatus, o_orderkey, row_number() OVER "
    f"(PARTITION BY o_orderstatus ORDER BY {_NEWEST_ORDER}) AS row_num FROM orders",
    "order_rank_in_slices": "SELECT o_orderstatus, o_orderkey, row_number() OVER "
    f"(PARTITION BY o_orderstatus ORDER BY {_NEWEST_ORDER}) AS row_num FROM orders",
    "latest_line": _newest(
        f"l_orderkey, l_linenumber, {', '.join(logs.LINE_COLUMNS)}, l_shipdate AS ts",
        "lineitem",
        "l_orderkey, l_linenumber",
        _LINE_ORDER,
    ),
    "high_watermark": f"{REFRESH} SELECT ts FROM mark",
    "high_watermark_empty": f"{LOG} SELECT coalesce(max(epoch_ms(ts_ms)), "
    "TIMESTAMP '0001-01-01 00:00:00') < TIMESTAMP '1970-01-01 00:00:00' AS is_floor "
    "FROM log WHERE op = 'd' AND op <> 'd'",
    "changed_since": f"{REFRESH} SELECT id, name, bal, op, ts FROM since",
    "changed_since_by_day": f"{REFRESH} SELECT id, name, bal, op, ts FROM since",
    "high_watermark_footers": f"{REFRESH} SELECT ts FROM mark",
    "changed_keys": f"{REFRESH} SELECT id FROM since",
    "rows_to_replace": f"{REFRESH} SELECT id, name, bal, ts FROM latest_1 "
    "WHERE id IN (SELECT id FROM since)",
    "delete_changed": f"{REFRESH} SELECT id, name, bal, ts FROM kept",
    "rows_to_replace_stored": f"{REFRESH} SELECT id, name, bal, ts FROM latest_1 "
    "WHERE id IN (SELECT id FROM since)",
    "delete_few": f"{REFRESH} SELECT id, name, bal, ts FROM kept",
    "insert_changed": f"{REFRESH} SELECT id, name, bal, ts FROM latest_1 "
    "UNION ALL SELECT id, name, bal, ts FROM upserts",
    "apply_delta": _REFRESHED,
    "apply_delta_noop": _REFRESHED,
    "apply_delta_two_marks": f"{_FALLING}, fallen AS (SELECT max(ts) AS ts FROM kept) "
    "SELECT id, name, bal, ts FROM kept UNION ALL "
    "SELECT w.id, w.name, w.bal, w.ts FROM whole w, fallen f WHERE w.ts > f.ts AND w.op <> 'd'",
    "late_changes": f"{REFRESH} (SELECT id, ts FROM truth) EXCEPT (SELECT id, ts FROM refreshed)",
    "latest_keywise": _LIVE_ROWS,
    "latest_stream_state": f"WITH {_log(logs.LATE_DELETE)}, {_state('state', 'log')}, "
    f"{_live('live', 'state')} SELECT id, name, bal, ts FROM live",
    "bootstrap": _LIVE_ROWS,
    "store_refresh": _REFRESHED,
    "store_refresh_keywise": _LIVE_ROWS,
    "incremental_stream": _REFRESHED,
    "incremental_stream_keywise": _LIVE_ROWS,
    "incremental_stream_late_delete": f"WITH {_log(logs.LATE_DELETE)}, {_state('state', 'log')}, "
    f"{_live('live', 'state')} SELECT id, name, bal, ts FROM live",
    "catalog_refresh": _report("result"),
    "catalog_refresh_keywise": _agreed(EVENTS),
    "source_total": f"{REFRESH} SELECT count(*) AS n FROM truth",
    "missing_rows": f"{REFRESH} {_MISSING.format(p='')}",
    "stale_rows": f"{REFRESH} {_STALE.format(p='')}",
    "missing_count": f"{REFRESH} SELECT count(*) AS n FROM ({_MISSING.format(p='')})",
    "stale_count": f"{REFRESH} SELECT count(*) AS n FROM ({_STALE.format(p='')})",
    "reconcile": _report("result"),
    "reconcile_digest": _report("result"),
    "reconcile_digest_levels": _report("result"),
    "reconcile_digest_agreed": _agreed(EVENTS),
    "report_csv": _report("match"),
    "converge": _agreed(ON_TIME),
}
