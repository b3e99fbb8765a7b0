"""Broker messages and their payloads."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schema import TableSpec, envelope_schema

# Fixed value: length of the registry header (magic byte and schema id) of an Avro payload.
REGISTRY_HEADER_BYTES = 5


def kafka_messages(
    spark: SparkSession, servers: str, topic_pattern: str, **options: str
) -> DataFrame:
    """Stream of all topics that match a pattern. Needs the Kafka connector package."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribePattern", topic_pattern)
        .option("startingOffsets", "earliest")
        .options(**options)
        .load()
    )


def payload_schema(spec: TableSpec) -> T.StructType:
    """The envelope without ``partition``, which is a property of the message."""
    return T.StructType([f for f in envelope_schema(spec.record) if f.name != "partition"])


def registry_id(value: Column) -> Column:
    """The schema id in the header of a registry payload: four bytes, high byte first."""
    return F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("long")


def by_schema_id(value: Column, decoders: Mapping[int, Callable[[Column], Column]]) -> Column:
    """Each payload through the decoder of its schema id; an unknown id fails the job."""
    own, body = registry_id(value), F.substring(value, REGISTRY_HEADER_BYTES + 1, 2147483647)
    unknown = F.raise_error(F.concat(F.lit("no writer schema of id "), own.cast("string")))
    out = None
    for number, decoder in decoders.items():
        known = own == number
        out = F.when(known, decoder(body)) if out is None else out.when(known, decoder(body))
    if out is None:
        raise ValueError("a registry payload needs the writer schemas by id")
    return out.otherwise(unknown)


def _of_another_table(spec: TableSpec) -> Column:
    """Whether the image of a JSON message has fields, but none of the table."""
    text = F.col("value").cast("string")
    paths = ("$.payload.after", "$.after", "$.payload.before", "$.before")
    names = F.json_object_keys(F.coalesce(*(F.get_json_object(text, p) for p in paths)))
    known = F.arrays_overlap(names, F.array(*map(F.lit, spec.columns)))
    return F.coalesce((F.size(names) > 0) & ~known, F.lit(False))


def decode_envelope(
    messages: DataFrame,
    spec: TableSpec,
    fmt: str = "json",
    avro_schemas: Mapping[int, str] | None = None,
) -> DataFrame:
    """Messages (``partition``, ``value``) to typed envelopes.

    Null values (broker tombstones) are skipped. JSON may come bare or wrapped as
    ``{"schema": .., "payload": ..}``. Avro payloads name their writer schema by an id, which
    ``avro_schemas`` resolves. A payload that does not decode, an unknown id, a change without
    operation, and one without a row - no image, or one with fields of another table - fail
    the job instead of turning into an envelope of NULLs.
    """
    messages = messages.where(F.col("value").isNotNull())
    value, payload = F.col("value"), payload_schema(spec)
    if fmt == "json":
        text = value.cast("string")
        bare = F.from_json(text, payload, {"mode": "FAILFAST"})
        inside = T.StructType([T.StructField("payload", payload)])
        # only what has no operation by itself is parsed again, as wrapped
        wrapped = F.from_json(text, inside, {"mode": "FAILFAST"})["payload"]
        messages = messages.withColumn("bare", bare)
        decoded = F.when(F.col("bare.op").isNull(), wrapped).otherwise(F.col("bare"))
    elif fmt == "avro":
        from pyspark.sql.avro.functions import from_avro  # needs the spark-avro package

        decoders = {
            number: lambda body, schema=schema: from_avro(
                body, schema, {"mode": "FAILFAST"}
            ).cast(payload)
            for number, schema in (avro_schemas or {}).items()
        }
        decoded = by_schema_id(value, decoders)
    else:
        raise ValueError(f"unknown message format {fmt!r}")
    found = messages.select(
        decoded.alias("m"), F.col("partition").cast("int").alias("partition"), "value"
    )
    row = F.coalesce("m.after", "m.before")
    broken = F.col("m.op").isNull() | row.isNull()
    if fmt == "json":
        empty = F.coalesce(*(row[c].cast("string") for c in spec.columns)).isNull()
        broken = broken | F.when(empty, _of_another_table(spec)).otherwise(False)
    start = F.substring(F.col("value").cast("string"), 1, 200)
    complain = F.raise_error(F.concat(F.lit("no change of a row in message: "), start))
    return found.where(F.when(broken, complain.cast("boolean")).otherwise(True)).select(
        "m.*", "partition"
    )


def encode_envelope(changes: DataFrame, topic: str) -> DataFrame:
    """Envelopes to JSON messages (``topic``, ``partition``, ``value``)."""
    payload = [F.col(c) for c in changes.columns if c != "partition"]
    return changes.select(
        F.lit(topic).alias("topic"), "partition", F.to_json(F.struct(*payload)).alias("value")
    )
