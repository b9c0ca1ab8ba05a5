"""Sinks for keyed, snapshot and append-only tables.

A keyed table is a folder with one sub-folder per micro-batch, each holding the
newest row per key of that batch. A batch replaces only its own sub-folder, so
running it again after a failure changes nothing, and its cost follows the batch
and not the table. Readers take the newest row per key; ``compact`` folds the
batches into one and removes them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.operators.keyed import first_per_key, latest_window

BATCH, RUN = "batch_id", "run"


def upsert_sink(path: str, keys: Sequence[str], order: Sequence[Column]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that upserts by key, newest by ``order`` first."""

    def write(batch: DataFrame, batch_id: int) -> None:
        newest = first_per_key(batch, keys, order)
        newest.write.mode("overwrite").parquet(batch_path(path, batch, batch_id))

    return write


def append_sink(path: str, name: str = "id") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that appends rows under a surrogate id.

    Spark has no serial numbers. The id hashes the record, so a repeated batch
    gives its rows the same ids; equal records share one.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn(name, F.xxhash64(*batch.columns))
        rows.write.mode("overwrite").parquet(batch_path(path, batch, batch_id))

    return write


def batch_path(path: str, batch: DataFrame, batch_id: int) -> str:
    """Folder of a micro-batch: that of its query, which a new checkpoint does not share, then its number."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"
    return f"{path}/{RUN}={query}/{BATCH}={batch_id}"


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All rows of all batches, with their query and batch number."""
    return spark.read.option("basePath", path).parquet(path)


def newest_rows(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The newest row per key by the order of the records; the batch only settles what they leave open."""
    if not order:
        raise ValueError("name the order of the records: batch numbers of different runs cannot be compared")
    return first_per_key(rows, keys, [*order, F.desc(BATCH), F.desc(RUN)]).drop(BATCH, RUN)


def read_keyed(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Current state of a keyed table: the newest row per key by ``order``, as in the sink.

    The order has to come from the records. Windows that are updated grow, so their row count orders them.
    """
    return newest_rows(read_batches(spark, path), keys, order)


def read_snapshot(
    spark: SparkSession, path: str, keys: Sequence[str], snapshot: str, order: Sequence[Column]
) -> DataFrame:
    """State of the newest snapshot, which is found before the newest row per key.

    The snapshot is named by a column of the records, so one that is spread over
    several batches stays whole, and a record that comes late takes nothing away.
    """
    rows = read_batches(spark, path)
    newest = rows.agg(F.max(snapshot)).scalar()
    return newest_rows(rows.filter(F.col(snapshot) == newest), keys, order)


def compact(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Replace the batches written so far by one that holds the current state.

    Batches that a query adds meanwhile are left alone. The fold is written
    before the folded batches go, so a reader finds every key at any time; a
    fold keeps the largest batch number of what it replaces.
    """
    context = spark.sparkContext
    hadoop = context._jvm.org.apache.hadoop.fs.Path
    files = hadoop(path).getFileSystem(context._jsc.hadoopConfiguration())
    found = files.globStatus(hadoop(f"{path}/{RUN}=*/{BATCH}=*/_SUCCESS"))
    folders = [str(f.getPath().getParent().toString()) for f in found]
    if len(folders) > 1:
        rows = spark.read.option("basePath", path).parquet(*folders)
        last = max(int(f.rsplit("=", 1)[1]) for f in folders)
        fold = f"{path}/{RUN}=fold-{uuid.uuid4().hex[:12]}/{BATCH}={last}"
        newest_rows(rows, keys, order).write.parquet(fold)
        for folder in folders:
            files.delete(hadoop(folder), True)
    return read_keyed(spark, path, keys, order)


def materialize(
    df: DataFrame,
    name: str,
    path: str | None = None,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    salts: int = 1,
) -> DataFrame:
    """A table (full refresh below ``path``) or, without a path, a lazy view.

    A table may be partitioned by columns. Rows of one partition then meet in
    ``salts`` tasks, so that it gets few files, and are ordered by ``sort_by`` in
    each, so that row groups can be skipped. Raise ``salts`` where one partition
    holds more than a task should write.
    """
    if path is None:
        df.createOrReplaceTempView(name)
        return df.sparkSession.table(name)
    target = f"{path}/{name}"
    if partition_by:
        salt = [F.pmod(F.xxhash64(*df.columns), F.lit(salts))] if salts > 1 else []
        df = df.repartition(*partition_by, *salt)
    if partition_by or sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(target)
    return df.sparkSession.read.parquet(target)


def newest_partition(spark: SparkSession, path: str, column: str) -> str | None:
    """Highest value of a table's first partition column, by folder names alone; None without any.

    For columns whose text order is their order, such as days. No file is read.
    """
    context = spark.sparkContext
    hadoop = context._jvm.org.apache.hadoop.fs.Path
    files = hadoop(path).getFileSystem(context._jsc.hadoopConfiguration())
    found = files.globStatus(hadoop(f"{path}/{column}=*"))
    values = [str(f.getPath().getName()).split("=", 1)[1] for f in found or []]
    return max((v for v in values if v != "__HIVE_DEFAULT_PARTITION__"), default=None)


def newest_rows_of(spark: SparkSession, path: str, column: str, end_col: str = "window_end") -> DataFrame:
    """Rows of the newest window of a table partitioned by the day of its window ends: one partition is read."""
    table = spark.read.parquet(path)
    newest = newest_partition(spark, path, column)
    part = table.filter(F.lit(False) if newest is None else F.col(column) == F.lit(newest).cast(table.schema[column].dataType))
    return latest_window(part, end_col)


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """Parquet folder, or an empty table when nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
