"""Start streaming queries with the settings the jobs need."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Landing batches of the feeds, as rows or seconds.
FLUSH_ROWS = {"flights": 9000, "weather": 257}
FLUSH_INTERVAL = "10 seconds"

STATE_PARTITIONS = "aerolith.state.partitions"


def flush_options(feed: str) -> dict[str, str]:
    """Reader options that bound a micro-batch of a Kafka feed."""
    return {"maxOffsetsPerTrigger": str(FLUSH_ROWS[feed])}


def bounded_files(
    spark: SparkSession, path: str, schema, files: int | None = None, size: str | None = None
) -> DataFrame:
    """A folder of parquet files as a stream whose micro-batches take at most ``files`` files or ``size`` bytes.

    Spark admits whole files: a batch holds at least one, and ``size`` (such as "64m") is passed by its last one.
    """
    reader = spark.readStream.schema(schema)
    if files is not None:
        reader = reader.option("maxFilesPerTrigger", files)
    if size is not None:
        reader = reader.option("maxBytesPerTrigger", size)
    return reader.parquet(path)


def state_partitions(spark: SparkSession) -> int:
    """Partitions of the streaming state: the setting ``aerolith.state.partitions``, else one per core.

    A query keeps this number for life, so it is not left to the batch setting.
    Where executors come and go the cores at the start say little; set it there.
    """
    return int(spark.conf.get(STATE_PARTITIONS, None) or spark.sparkContext.defaultParallelism)


@contextmanager
def stream_conf(spark: SparkSession, partitions: int | None = None):
    """Settings read by a streaming query when it starts, restored afterwards."""
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.streaming.multipleWatermarkPolicy": "min",
        "spark.sql.shuffle.partitions": str(partitions or state_partitions(spark)),
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def start(
    stream: DataFrame,
    checkpoint: str,
    path: str | None = None,
    sink: Callable[[DataFrame, int], None] | None = None,
    mode: str = "append",
    every: str | None = None,
    partitions: int | None = None,
) -> StreamingQuery:
    """Start a query into a parquet folder or a ``foreachBatch`` sink.

    With ``every`` it runs on until stopped, else it takes all data there is and
    ends. The checkpoint lets a restarted query go on where it was.
    """
    spark = stream.sparkSession
    with stream_conf(spark, partitions):
        writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
        writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
        if sink is not None:
            return writer.foreachBatch(sink).start()
        return writer.format("parquet").option("path", path).start()


def run_to_end(query: StreamingQuery) -> StreamingQuery:
    """Wait for a query that ends by itself and raise what made it fail."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return query
