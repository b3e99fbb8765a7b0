"""Change logs: Parquet envelopes in ``partition=N`` directories, by path or as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.envelope import change_day
from tidemark.schema import TableSpec, envelope_schema
from tidemark.session import exists, make_dir, remove

ROWS_PER_FILE = 2_000_000
# Folder of what one batch has landed.
BATCH = "batch"


def read_changes(
    spark: SparkSession,
    path: str,
    spec: TableSpec,
    streaming: bool = False,
    max_files_per_trigger: int | None = None,
    by_day: bool = False,
) -> DataFrame:
    """The change log under ``path``, as a batch or a stream.

    The schema is always given, never inferred: no pass over the files, ``partition`` stays
    an INT, and columns that older files lack (nested ones too) read as NULL. Folders may be
    parted by batch above that. A log laid out ``by_day`` has its ``day`` as a last column, by
    which filters on a mark pass over folders.
    """
    schema = envelope_schema(spec.record)
    columns = [*schema.names, *(["day"] if by_day else [])]
    given = schema.add(BATCH, "long")
    if by_day:
        given = given.add("day", "integer")
    reader = (spark.readStream if streaming else spark.read).schema(given)
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path).select(*columns)


def write_changes(
    changes: DataFrame,
    path: str,
    mode: str = "append",
    by_day: bool = False,
    compression: str = "gzip",
    max_records: int | None = None,
) -> None:
    """Write envelopes in the layout of the landing job (gzip Parquet by ``partition``).

    ``by_day`` parts them by the UTC day of the change below that.
    """
    parts = ["partition"]
    if by_day:
        changes, parts = changes.withColumn("day", change_day()), ["partition", "day"]
    writer = changes.write.mode(mode).option("compression", compression).partitionBy(*parts)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.parquet(path)


def compact_log(
    spark: SparkSession,
    path: str,
    spec: TableSpec,
    target: str,
    rows_per_file: int = ROWS_PER_FILE,
) -> None:
    """Rewrite a log into the new folder ``target`` with about ``rows_per_file`` changes a file.

    A landing job leaves a file per task, partition and batch. A partition of many changes is
    spread over as many tasks as it gets files. Readers switch to the new folder when it is
    complete: as a table by ``ALTER TABLE .. SET LOCATION`` and :func:`sync_partitions`.
    """
    write_changes(_dealt(read_changes(spark, path, spec), rows_per_file), target, "errorifexists")


def _dealt(changes: DataFrame, rows_per_file: int) -> DataFrame:
    """Changes over as many tasks as each partition is to have files."""
    # a row for each partition of the broker's topic
    sizes = changes.groupBy("partition").agg(F.count("*").alias("n")).collect()
    files = {-1 if r["partition"] is None else r["partition"]: r["n"] for r in sizes}
    pairs = [x for k, n in sorted(files.items()) for x in (k, -(-n // rows_per_file))]
    slot = F.xxhash64("ts_ms", "source", "op", "after", "before")
    if pairs:
        wanted = F.create_map(*map(F.lit, pairs))[F.coalesce("partition", F.lit(-1))]
        slot = F.pmod(slot, wanted)
    return changes.withColumn("__slot", slot).repartition("partition", "__slot").drop("__slot")


def create_namespace(spark: SparkSession, schema: str, location: str | None = None) -> None:
    """Create a schema, at a location if given, unless it exists."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{where}")


def create_change_table(spark: SparkSession, table: str, spec: TableSpec, path: str) -> None:
    """Register the log under ``path`` as an external table and load its partitions.

    The folder need not exist yet.
    """
    schema = envelope_schema(spec.record)
    if not spark.catalog.tableExists(table):
        # writing no rows makes the folder, on any file system
        nothing = (F.lit(None).cast(f.dataType).alias(f.name) for f in schema)
        write_changes(spark.range(0).select(*nothing), path)
        columns = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" for f in schema
        )
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
            f"PARTITIONED BY (partition) LOCATION '{path}'"
        )
    sync_partitions(spark, table)


class LiveLog:
    """A log that is compacted while a landing job goes on writing it, by name.

    The job writes ``path/batch=N`` folders. ``compact`` rewrites all finished batches into
    ``packed/upto=N``, few files of whatever size, and replaces the view ``name``: it reads the
    newest packed folder, and of the landed batches those after N. Replacing a view is one step of
    the catalog, so a reader sees every change once, before or after it. The job is not stopped
    and knows nothing of it; streams that read ``path`` are not touched either. The view needs a
    persistent catalog.
    """

    def __init__(self, spark: SparkSession, name: str, spec: TableSpec, path: str, packed: str):
        self.spark, self.name, self.spec = spark, name, spec
        self.path, self.packed = path.rstrip("/"), packed.rstrip("/")
        for suffix, folder, part in (("landed", self.path, BATCH), ("packed", self.packed, "upto")):
            make_dir(spark, folder)
            schema = envelope_schema(spec.record)
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name}_{suffix} ({columns}, {part} BIGINT) USING "
                f"parquet PARTITIONED BY ({part}, partition) LOCATION '{folder}'"
            )
        self.sync()

    def _numbers(self, folder: str, part: str) -> list[int]:
        """Numbers of the folders that are complete. A batch is a folder and a name, not data."""
        named = self.spark.sql(f"SHOW PARTITIONS {self.name}_{folder}").collect()
        root = self.path if folder == "landed" else self.packed
        found = sorted({int(r[0].split("/")[0].split("=")[1]) for r in named})
        return [n for n in found if exists(self.spark, f"{root}/{part}={n}/_SUCCESS")]

    def sync(self) -> None:
        """Make the view show what has landed and what is packed."""
        for suffix in ("landed", "packed"):
            sync_partitions(self.spark, f"{self.name}_{suffix}")
        self._show()

    def _show(self) -> None:
        upto = max(self._numbers("packed", "upto"), default=-1)
        columns = ", ".join(f"`{c}`" for c in envelope_schema(self.spec.record).names)
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.name} AS "
            f"SELECT {columns} FROM {self.name}_packed WHERE upto = {upto} UNION ALL "
            f"SELECT {columns} FROM {self.name}_landed WHERE {BATCH} > {upto}"
        )

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def compact(self, rows_per_file: int = ROWS_PER_FILE) -> int:
        """Pack all finished batches; gives the number of the last one packed, -1 for none."""
        self.sync()
        before = max(self._numbers("packed", "upto"), default=-1)
        last = max(self._numbers("landed", BATCH), default=-1)
        if last <= before:
            return before
        columns = envelope_schema(self.spec.record).names
        packed = self.spark.table(f"{self.name}_packed").where(F.col("upto") == before)
        landed = self.spark.table(f"{self.name}_landed").where(
            (F.col(BATCH) > before) & (F.col(BATCH) <= last)
        )
        whole = packed.select(*columns).unionAll(landed.select(*columns))
        write_changes(_dealt(whole, rows_per_file), f"{self.packed}/upto={last}", "overwrite")
        self.sync()
        return last

    def purge(self) -> None:
        """Delete what the view no longer reads: batches that are packed, older packed folders.

        Call it once readers of the former view and streams that read the batches are done.
        """
        packed = self._numbers("packed", "upto")
        upto = max(packed, default=-1)
        for n in packed[:-1]:
            remove(self.spark, f"{self.packed}/upto={n}")
        for n in self._numbers("landed", BATCH):
            if n <= upto:
                remove(self.spark, f"{self.path}/{BATCH}={n}")
        self.sync()


def sync_partitions(spark: SparkSession, table: str, mode: str = "FULL") -> None:
    """Make the catalog's partitions match the directories: ADD new, DROP gone, FULL both."""
    action = {"FULL": "SYNC", "ADD": "ADD", "DROP": "DROP"}[mode.upper()]
    spark.sql(f"MSCK REPAIR TABLE {table} {action} PARTITIONS")
