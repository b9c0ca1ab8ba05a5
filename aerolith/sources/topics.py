"""JSON message topics as typed DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

_UNREAD = "_unread"


def read_topic(spark: SparkSession, topic: str, servers: str, start: str = "earliest", **options) -> DataFrame:
    """Raw messages of a Kafka topic (needs the Kafka connector on the class path)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", start)
    )
    return reader.options(**options).load()


def read_message_files(spark: SparkSession, path: str, **options) -> DataFrame:
    """Messages kept as text files, one JSON object per line, as a stream."""
    return spark.readStream.options(**options).text(path)


def decode(messages: DataFrame, schema: StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Typed columns of the declared fields. Undeclared fields are not read.

    A message that is no JSON object, or of which no field can be read, gives no
    row. ``drop_malformed`` counts what it drops and asks for all declared fields.
    """
    with_rest = StructType([*schema.fields, StructField(_UNREAD, StringType())])
    body = F.from_json(F.col("value").cast("string"), with_rest, {"columnNameOfCorruptRecord": _UNREAD})
    parsed = messages.select(body.alias("_m"), *keep)
    any_read = reduce(Column.__or__, [F.col("_m")[n].isNotNull() for n in schema.names])
    read = F.col("_m").isNotNull() & (F.col("_m")[_UNREAD].isNull() | any_read)
    return parsed.filter(read).select("_m.*", *keep).drop(_UNREAD)


def read_topic_json(
    spark: SparkSession, topic: str, schema: StructType, servers: str, start: str = "earliest", **options
) -> DataFrame:
    """Typed records of a Kafka topic, with the broker ``timestamp`` as arrival time."""
    return decode(read_topic(spark, topic, servers, start, **options), schema, keep=["timestamp"])


def is_malformed(value: Column, schema: StructType, optional: Sequence[str] = ("last_seen",)) -> Column:
    """True when a message is no JSON object with exactly the declared fields."""
    names = [f.name for f in schema.fields]
    required = F.array(*[F.lit(n) for n in names if n not in optional])
    present = F.json_object_keys(value)
    unreadable = F.try_parse_json(value).isNull()
    missing = F.size(F.array_except(required, present)) > 0
    extra = F.size(F.array_except(present, F.array(*[F.lit(n) for n in names]))) > 0
    return unreadable | present.isNull() | F.coalesce(missing | extra, F.lit(True))


def drop_malformed(
    messages: DataFrame,
    schema: StructType,
    keep: Sequence[str] = (),
    metric: str = "decode",
    optional: Sequence[str] = ("last_seen",),
) -> DataFrame:
    """Typed rows of well-formed messages; the number dropped is observed as ``metric``."""
    value = F.col("value").cast("string")
    marked = messages.withColumn("_bad", is_malformed(value, schema, optional))
    counted = marked.observe(metric, F.count(F.lit(1)).alias("read"), F.count_if("_bad").alias("dropped"))
    return decode(counted.filter(~F.col("_bad")), schema, keep)


def arrival_time(messages: DataFrame, column: str | None = "timestamp") -> Column:
    """Processing time of a record: its broker timestamp, else the batch clock.

    The broker timestamp is replayable: a restarted query puts each record in the
    same window again.
    """
    if column and column in messages.columns:
        return F.col(column)
    return F.current_timestamp()
