from __future__ import annotations

import pytest
from build import ITEM, change, log, rows
from pyspark.sql import functions as F

from tidemark import PRODUCTS, TableSpec, envelope_schema, record_type, sources
from tidemark import operators as ops
from tidemark.sources.messages import by_schema_id


def test_log_round_trip(spark, tmp_path):
    empty = {"id": None, "name": None, "bal": None}
    changes = [
        change("c", 1, 10, partition=3),
        change("d", 2, None, partition=0),
        change("u", 3, 30, before=None, after=empty, partition=3),
    ]
    sources.write_changes(log(spark, changes), str(tmp_path / "log"))
    found = sources.read_changes(spark, str(tmp_path / "log"), ITEM)
    assert found.schema == envelope_schema(ITEM.record)
    assert rows(found) == rows(log(spark, changes))


def test_columns_that_a_file_lacks_are_null(spark, tmp_path):
    path = str(tmp_path / "log")
    old = TableSpec("item", record_type(id="long", name="string"))
    first = [
        {**change("c", 1, 10), "after": {"id": 1, "name": "a"}},
        {**change("d", 2, 10), "before": {"id": 2, "name": "b"}},
    ]
    narrow = log(spark, first, old).withColumn("source", F.col("source").dropFields("query"))
    sources.write_changes(narrow.drop("transaction"), path)
    sources.write_changes(log(spark, [change("c", 3, 10, bal=1.5)]), path)
    found = sources.read_changes(spark, path, ITEM)
    assert rows(found.select(F.coalesce("after", "before").alias("r")).select("r.*")) == [
        (1, "a", None),
        (2, "b", None),
        (3, "n", 1.5),
    ]
    assert found.where("transaction IS NOT NULL OR source.query IS NOT NULL").count() == 0


def test_partition_sync_adds_and_drops(spark, tmp_path):
    path, table = str(tmp_path / "log"), "cdc_sync.item"
    sources.create_namespace(spark, "cdc_sync", str(tmp_path / "cdc"))
    sources.create_namespace(spark, "cdc_sync")
    sources.create_change_table(spark, table, ITEM, path)
    assert spark.table(table).count() == 0
    changes = [change("c", k, 10, partition=k) for k in range(3)]
    sources.write_changes(log(spark, changes), path)
    sources.create_change_table(spark, table, ITEM, path)
    assert rows(spark.table(table)) == rows(log(spark, changes))

    gone = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/partition=1")
    gone.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(gone, True)
    sources.sync_partitions(spark, table, "ADD")
    assert spark.sql(f"SHOW PARTITIONS {table}").count() == 3
    sources.sync_partitions(spark, table)
    assert rows(spark.sql(f"SHOW PARTITIONS {table}")) == [("partition=0",), ("partition=2",)]
    with pytest.raises(KeyError):
        sources.sync_partitions(spark, table, "SOME")
    spark.sql(f"DROP TABLE {table}")


def test_decoding(spark):
    changes = [change("c", 1, 10), change("d", 2, 20, partition=5)]
    messages = sources.encode_envelope(log(spark, changes), "a.b.item")
    assert rows(sources.decode_envelope(messages, ITEM)) == rows(log(spark, changes))
    binary = messages.withColumn("value", F.col("value").cast("binary"))
    assert rows(sources.decode_envelope(binary, ITEM)) == rows(log(spark, changes))
    with pytest.raises(ValueError, match="format"):
        sources.decode_envelope(messages, ITEM, fmt="xml")
    with pytest.raises(ValueError, match="writer schemas"):
        sources.decode_envelope(messages, ITEM, fmt="avro")


@pytest.mark.parametrize(
    "value",
    [
        "{}",
        '{"payload": {}}',
        '{"op": "c", "ts_ms": 1}',
        '{"after": {"id": 1}, "ts_ms": 1}',
        '{"after": {"ID": 7}, "op": "c", "ts_ms": 1}',
        '{"after": {"id": "x"}, "op": "c"}',
        "not json",
    ],
)
def test_messages_that_hold_no_change_fail(spark, value):
    messages = spark.createDataFrame([(0, value)], "partition INT, value STRING")
    with pytest.raises(Exception, match="no change of a row|MALFORMED|parse|FAILFAST"):
        sources.decode_envelope(messages, ITEM).select("partition").collect()


def test_payloads_are_routed_by_schema_id(spark):
    payload = [(b"\0\0\0\0\x07seven",), (b"\0\0\0\x01\0later",)]
    value = F.col("value")
    decoders = {7: lambda body: body.cast("string"), 256: lambda body: F.upper(body.cast("string"))}
    df = spark.createDataFrame(payload, "value BINARY")
    found = df.select(by_schema_id(value, decoders).alias("x"))
    assert sorted(r["x"] for r in found.collect()) == ["LATER", "seven"]
    unknown = df.select(by_schema_id(value, {7: decoders[7]}).alias("x"))
    with pytest.raises(Exception, match="no writer schema of id 256"):
        unknown.collect()


def test_log_files_are_ordered_by_number(spark):
    changes = []
    for name, number in (("old", 999_999), ("new", 1_000_000)):
        c = change("u", 1, 10, pos=5, name=name)
        changes.append({**c, "source": {**c["source"], "file": f"binlog.{number}"}})
    for order in (changes, changes[::-1]):
        state = ops.latest_state(log(spark, order), ITEM)
        assert [r["record"]["name"] for r in state.collect()] == ["new"]
        log(spark, order).createOrReplaceTempView("numbered")
        spark.sql("CREATE SCHEMA IF NOT EXISTS numbering")
        log(spark, order).write.mode("overwrite").saveAsTable("numbering.item_changes")
        ops.create_latest_view(spark, "numbering.item", "numbering.item_changes", ITEM)
        assert [r["record"]["name"] for r in spark.table("numbering.item").collect()] == ["new"]


def test_conform_orders_and_casts(spark):
    table = spark.createDataFrame(
        [(3.25, "d", "n", 1, "extra")],
        "weight FLOAT, description STRING, name STRING, id INT, other STRING",
    )
    found = sources.conform(table, PRODUCTS)
    assert [(f.name, f.dataType) for f in found.schema] == [
        (f.name, f.dataType) for f in PRODUCTS.record
    ]
    assert rows(found) == [(1, "n", "d", 3.25)]


class Recorder:
    """Stands for a reader: notes the options of every read, since no database may run here."""

    def __init__(self, table, bounds, reads):
        self.table, self.bounds, self.reads, self.options_seen = table, bounds, reads, {}

    def format(self, kind):
        reader = Recorder(self.table, self.bounds, self.reads)
        reader.options_seen["format"] = kind
        return reader

    def options(self, **options):
        self.options_seen.update(options)
        return self

    def option(self, name, value):
        return self.options(**{name: value})

    def load(self):
        self.reads.append(self.options_seen)
        return self.bounds if "query" in self.options_seen else self.table


@pytest.mark.parametrize("bounds", [(1, 900), (None, None)])
def test_jdbc_reads_in_ranges(spark, bounds):
    class Session:
        reads: list[dict] = []

        @property
        def read(self):
            return Recorder(table, spark.createDataFrame([bounds], "lo BIGINT, hi BIGINT"), self.reads)

    table = spark.createDataFrame([("n", 1, "d", 2.0)], "name STRING, id INT, description STRING, weight FLOAT")
    session = Session()
    session.reads.clear()
    found = sources.read_jdbc(
        session, "jdbc:x", "products", PRODUCTS, partition_column="id", num_partitions=8, user="me"
    )
    assert rows(found) == [(1, "n", "d", 2.0)]
    asked, read = session.reads
    assert asked["query"] == "SELECT min(id) AS lo, max(id) AS hi FROM products"
    assert (read["dbtable"], read["user"], read["format"]) == ("products", "me", "jdbc")
    ranged = {k: read.get(k) for k in ("partitionColumn", "numPartitions", "lowerBound", "upperBound")}
    if bounds[0] is None:
        assert set(ranged.values()) == {None}
    else:
        assert list(ranged.values()) == ["id", "8", "1", "900"]


def test_jdbc_takes_the_key_or_asks(spark):
    class Session:
        reads: list[dict] = []

        @property
        def read(self):
            return Recorder(table, spark.createDataFrame([(1, 9)], "lo BIGINT, hi BIGINT"), self.reads)

    table = spark.createDataFrame([("n", 1, "d", 2.0)], "name STRING, id INT, description STRING, weight FLOAT")
    session = Session()
    sources.read_jdbc(session, "jdbc:x", "products", PRODUCTS)
    assert session.reads[-1]["partitionColumn"] == "id"
    with pytest.raises(ValueError, match="partition column"):
        sources.read_jdbc(session, "jdbc:x", "products")
    sources.read_jdbc(session, "jdbc:x", "products", num_partitions=1)
    assert "partitionColumn" not in session.reads[-1]


def test_compaction_leaves_few_files(spark, tmp_path):
    changes = [change("u", k % 20, k, pos=k, partition=0 if k % 3 else 1) for k in range(600)]
    path, target = str(tmp_path / "log"), str(tmp_path / "compact")
    for i in range(6):
        sources.write_changes(log(spark, changes[i::6]).repartition(5), path)
    sources.compact_log(spark, path, ITEM, target, rows_per_file=200)
    assert rows(sources.read_changes(spark, target, ITEM)) == rows(log(spark, changes))
    files = [len(list((tmp_path / "compact" / f"partition={k}").glob("*.parquet"))) for k in (0, 1)]
    assert files[0] <= 2 and files[1] == 1
    sources.write_changes(log(spark, []), str(tmp_path / "none"))
    sources.compact_log(spark, str(tmp_path / "none"), ITEM, str(tmp_path / "none2"))
