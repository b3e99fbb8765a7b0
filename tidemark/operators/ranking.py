"""Age rank of every change of a key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.envelope import change_order, key_columns
from tidemark.schema import TableSpec
from tidemark.session import shared_root


def change_rank(changes: DataFrame, spec: TableSpec, slices: int | None = None) -> DataFrame:
    """The changes with ``row_num``, 1 for the newest of each key.

    A window would gather a key in one task. Instead the changes are sorted over range
    partitions, ``slices`` of them (default: the session's shuffle partitions), which may part
    a key anywhere, so a key with a third of the log is a third of the work of all tasks. For
    the newest change alone use ``latest_state``, which never ranks the rest.

    A part is what one slice holds of one key. A row's rank is its distance from the start of
    its part, plus the sizes of the key's earlier parts. The checkpoint fixes the numbers for
    both uses. The random last sort column lets copies of one change spread over slices; which
    copy gets which of their ranks makes no difference.
    """
    spark = changes.sparkSession
    shared_root(spark)
    slices = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # as a struct, a key with NULL in it still equals itself
    key = F.struct(*(c.alias(k) for k, c in zip(spec.key, key_columns(spec))))
    order = ["__key", *change_order(spec), "__salt"]
    placed = (
        changes.withColumn("__key", key)
        .withColumn("__salt", F.rand(seed=1))
        .repartitionByRange(slices, *order)
        .sortWithinPartitions(*order)
        # the partition in the upper bits, the row within it in the lower 33
        .withColumn("__at", F.monotonically_increasing_id())
        .withColumn("__slice", F.shiftright("__at", 33))
        .checkpoint()
    )
    earlier = (
        Window.partitionBy("__key").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    parts = placed.groupBy("__key", "__slice").agg(
        F.min("__at").alias("__start"), F.count("*").alias("__n")
    )
    parts = parts.select(
        "__key",
        "__slice",
        (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__start") + 1).alias("__shift"),
    )
    return (
        placed.join(parts, ["__key", "__slice"])
        .withColumn("row_num", F.col("__at") + F.col("__shift"))
        .drop("__key", "__at", "__shift", "__slice", "__salt")
    )
