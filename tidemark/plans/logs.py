"""Change logs derived from the given tables.

A log holds a snapshot event for *every* row of its table. Which rows also see an update, a
delete, a late or a tied change follows from the key, so that Spark and SQL derive the same
log; nothing is left out. Each log is one scan of its table and one generator.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.envelope import epoch_millis
from tidemark.schema import (
    SOURCE_TYPE,
    TRANSACTION_TYPE,
    TableSpec,
    record_type,
)

T0 = 1_704_067_200_000  # 2024-01-01 in epoch milliseconds
# Distance of the event kinds in time and log position, and of new keys from old ones. Kinds of
# different keys overlap once keys pass it; those of one key never do, which is all that counts.
STRIDE = 1_000_000
NEW_KEYS = 1_000_000_000_000


@dataclass(frozen=True)
class Event:
    """An event kind: for which keys ``k``, when, and the value of the row afterwards."""

    batch: int
    op: str
    keys: str
    ts: int
    pos: int
    value: str | None = "bal"
    shift: int = 0
    late: bool = False

    @property
    def id(self) -> str:
        return f"k + CAST({self.shift} AS BIGINT)"

    @property
    def ts_ms(self) -> str:
        return f"k + CAST({T0 + self.ts * STRIDE} AS BIGINT)"

    @property
    def position(self) -> str:
        return f"k + CAST({self.pos * STRIDE} AS BIGINT)"


EVENTS = (
    Event(1, "r", "true", 0, 0),
    Event(1, "u", "k % 3 = 0", 60_000, 1, "bal + 100"),
    Event(1, "u", "k % 15 = 0", 60_000, 2, "bal + 200"),  # ties with the one before
    Event(2, "d", "k % 7 = 0", 120_000, 3, None),
    Event(2, "c", "k % 49 = 0", 180_000, 4, "CAST(0 AS DOUBLE)"),  # after the delete
    Event(2, "u", "k % 11 = 0 AND k % 7 <> 0", 30_000, 5, "bal + 300", late=True),
    Event(2, "c", "k % 50 = 0", 90_000, 6, shift=NEW_KEYS),
)
BATCH_1 = tuple(e for e in EVENTS if e.batch == 1)
BATCH_2 = tuple(e for e in EVENTS if e.batch == 2)
ON_TIME = tuple(e for e in EVENTS if not e.late)
# All rows that batch 1 updated are deleted, so the mark falls back to the snapshot.
FALLING_MARK = tuple(
    Event(2, "d", "k % 7 = 0 OR k % 3 = 0", 120_000, 3, None) if e.op == "d" else e
    for e in EVENTS
)

# Three batches: what the last one updates is in part deleted already, by later changes.
LATE_DELETE = (
    Event(1, "r", "true", 0, 0),
    Event(2, "d", "k % 7 = 0", 120_000, 3, None),
    Event(3, "u", "k % 7 = 0 OR k % 11 = 0", 90_000, 4, "bal + 300"),
)


@dataclass(frozen=True)
class LogTable:
    """Where the columns of a log's record (id, name, bal) come from."""

    table: str
    key: str
    label: str
    value: str

    @property
    def spec(self) -> TableSpec:
        return TableSpec(self.table, record_type(id="long", name="string", bal="double"))

    @property
    def topic(self) -> str:
        return f"shop.inventory.{self.table}"


CUSTOMER = LogTable("customer", "c_custkey", "c_name", "c_acctbal")
PART = LogTable("part", "p_partkey", "p_name", "p_retailprice")
ORDERS = LogTable("orders", "o_orderkey", "o_orderstatus", "o_totalprice")


# Columns the logs are made of. Given rather than inferred, which saves a pass over footers.
SCHEMAS = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
    "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING",
}


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def base_records(spark: SparkSession, sf_dir: str, log: LogTable) -> DataFrame:
    """The record of every row of the log's table."""
    return given(spark, sf_dir, log.table).selectExpr(
        f"{log.key} AS id", f"{log.label} AS name", f"{log.value} AS bal"
    )


def change_log(
    spark: SparkSession, sf_dir: str, log: LogTable, events: Sequence[Event] = EVENTS
) -> DataFrame:
    """The envelopes of the given event kinds over the whole table."""
    kinds = ", ".join(
        f"IF({e.keys}, named_struct('op', '{e.op}', 'id', {e.id}, 'ts_ms', {e.ts_ms}, 'pos', "
        f"{e.position}, 'bal', {e.value or 'CAST(NULL AS DOUBLE)'}), NULL)"
        for e in events
    )
    rows = given(spark, sf_dir, log.table).selectExpr(
        f"{log.key} AS k", f"{log.label} AS name", f"{log.value} AS bal"
    )
    rows = rows.selectExpr("*", f"explode(array_compact(array({kinds}))) AS e")
    return _envelopes(
        rows.selectExpr(
            "IF(e.op IN ('u', 'd'), struct(e.id, name, bal), NULL) AS before",
            "IF(e.op <> 'd', struct(e.id, name, e.bal), NULL) AS after",
            "e.op",
            "e.ts_ms",
            "e.pos",
            "CAST(k % 4 AS INT) AS partition",
        ),
        log.spec,
    )


def _envelopes(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Complete (``before``, ``after``, ``op``, ``ts_ms``, ``pos``, ``partition``)."""
    known = {
        "name": "'shop'",
        "db": "'inventory'",
        "table": f"'{spec.name}'",
        "ts_ms": "ts_ms",
        "file": "'log.000001'",
        "pos": "pos",
        "row": "0",
    }
    source = ", ".join(
        f"'{f.name}', CAST({known.get(f.name, 'NULL')} AS {f.dataType.simpleString()})"
        for f in SOURCE_TYPE
    )
    return rows.selectExpr(
        "before",
        "after",
        f"named_struct({source}) AS source",
        "op",
        "ts_ms",
        f"CAST(NULL AS {TRANSACTION_TYPE.simpleString()}) AS transaction",
        "partition",
    )


# Tables that are logs by themselves: every row is a change of the row its key names.

USER_EVENTS = TableSpec(
    "events",
    record_type(user_id="long", event_type="string", value="double", props="string"),
    key=["user_id"],
)
_ORDER = record_type(
    o_custkey="long", o_orderkey="long", o_orderstatus="string", o_totalprice="double"
)
ORDER_OF_CUSTOMER = TableSpec("orders", _ORDER, key=["o_custkey"])
# three keys, each with a third of the log
ORDER_OF_STATUS = TableSpec("orders", _ORDER, key=["o_orderstatus"])
LINE_COLUMNS = [
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]
# (l_orderkey, l_linenumber) repeats, and ship dates tie: the other columns decide
LINE = TableSpec(
    "lineitem",
    record_type(
        l_orderkey="long",
        l_linenumber="integer",
        l_partkey="long",
        l_suppkey="long",
        l_quantity="double",
        l_extendedprice="double",
        l_discount="double",
        l_tax="double",
        l_returnflag="string",
        l_linestatus="string",
    ),
    key=["l_orderkey", "l_linenumber"],
    tiebreak=[f"after.{c}" for c in LINE_COLUMNS],
)


def _row_changes(rows: DataFrame, spec: TableSpec, op: str, ts: str, pos: str) -> DataFrame:
    image = f"struct({', '.join(spec.columns)})"
    return _envelopes(
        rows.selectExpr("*", f"{op} AS op")
        .withColumn("ts_ms", epoch_millis(ts))
        .selectExpr(
            f"IF(op = 'd', {image}, NULL) AS before",
            f"IF(op <> 'd', {image}, NULL) AS after",
            "op",
            "ts_ms",
            f"{pos} AS pos",
            "0 AS partition",
        ),
        spec,
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as changes of users: an error deletes, a signup creates."""
    op = "CASE event_type WHEN 'error' THEN 'd' WHEN 'signup' THEN 'c' ELSE 'u' END"
    return _row_changes(given(spark, sf_dir, "events"), USER_EVENTS, op, "ts", "event_id")


def order_log(spark: SparkSession, sf_dir: str, spec: TableSpec) -> DataFrame:
    """``orders`` as changes of whatever the spec's key names; dates tie, order keys do not."""
    orders = given(spark, sf_dir, "orders")
    return _row_changes(orders, spec, "'c'", "o_orderdate", "o_orderkey")


def line_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as changes of order lines."""
    lines = given(spark, sf_dir, "lineitem")
    return _row_changes(lines, LINE, "'c'", "l_shipdate", "l_partkey")
