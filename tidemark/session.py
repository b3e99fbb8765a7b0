"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the operators rely on for skew and small-side handling. AQE splits hot join
# partitions and picks broadcasts from measured sizes.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a task that writes to a few partition directories keeps them open instead of sorting
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    "spark.ui.enabled": "false",
}

_local_roots: dict[str, str] = {}


def local_session(name: str = "tidemark", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir`` of the session, or the
    checkpoint folder set on its context.

    Where both are unset, a local session falls back to a temporary folder; on a cluster the
    setting is required, since a machine-local folder would be lost with its machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = _local_roots.get(context.applicationId)
        if root is None:
            root = _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="tidemark-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, purpose: str) -> str:
    """A new, not yet existing path below the shared folder."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for as long as a query is planned or started."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _place(spark: SparkSession, path: str):
    """A path and its file system, whatever that is."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder."""
    where, files = _place(spark, path)
    return files.exists(where)


def make_dir(spark: SparkSession, path: str) -> None:
    """Make a folder unless it is there."""
    where, files = _place(spark, path)
    files.mkdirs(where)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it, if it is there."""
    where, files = _place(spark, path)
    files.delete(where, True)
