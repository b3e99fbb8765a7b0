"""Small change logs by hand."""

from __future__ import annotations

from datetime import datetime, timedelta

from tidemark.schema import TableSpec, envelope_schema, record_type

ITEM = TableSpec("item", record_type(id="long", name="string", bal="double"))


def change(op, key, ts_ms, pos=0, name="n", bal=0.0, file="f1", row=0, partition=0, **images):
    """One envelope of ITEM as a dict; ``before``/``after`` override the usual images."""
    record = {"id": key, "name": name, "bal": bal}
    before = record if op in ("u", "d") else None
    after = None if op == "d" else record
    return {
        "before": images.get("before", before),
        "after": images.get("after", after),
        "source": {"file": file, "pos": pos, "row": row},
        "op": op,
        "ts_ms": ts_ms,
        "transaction": None,
        "partition": partition,
    }


def log(spark, changes, spec=ITEM):
    return spark.createDataFrame(changes, envelope_schema(spec.record))


def at(ts_ms):
    return datetime(1970, 1, 1) + timedelta(milliseconds=ts_ms)


def rows(df, *columns):
    found = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in found.collect()), key=repr)
