"""Change feeds as streams.

The stream only reads and parses; each micro-batch goes through the same batch function
as a poll of the change log.  A batch that is replayed after a failure merges to the
same table, because an upsert is keyed and the later event wins.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from docloom.operators.changes import parse_messages


def kafka_changes(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Changes from a Kafka topic; broker time and offset give the order of events.

    Further reader options use ``__`` for the dots of their names.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
    )
    for key, value in options.items():
        reader = reader.option(key.replace("__", "."), value)
    return message_changes(
        reader.load(), "value", F.col("timestamp"), broker_order(F.col("timestamp"), F.col("partition"), F.col("offset"))
    )


def broker_order(time: Column, partition: Column, offset: Column) -> Column:
    """Order of messages within a second: millisecond, then partition, then offset.

    Ten bits hold the millisecond, twelve the partition (at most 4096 of them) and 41 the offset.
    """
    millis = F.pmod(F.unix_millis(time.cast("timestamp")), F.lit(1000))
    place = F.pmod(partition.cast("bigint"), F.lit(1 << 12))
    return F.shiftleft(F.shiftleft(millis.cast("bigint"), 12) + place, 41) + F.pmod(
        offset.cast("bigint"), F.lit(1 << 41)
    )


def message_changes(stream: DataFrame, value: str, time, order) -> DataFrame:
    """Change columns of a stream of JSON messages."""
    carried = stream.select(
        F.col(value).cast("string").alias("value"),
        F.unix_seconds(time.cast("timestamp")).alias("event_time"),
        order.cast("bigint").alias("seq"),
    )
    return parse_messages(carried)


def file_changes(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    pattern: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """A stream of the Parquet files that appear in a folder."""
    reader = spark.readStream.schema(schema)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run_change_stream(
    changes: DataFrame,
    apply: Callable[..., object],
    checkpoint: str,
    interval: str | None = None,
) -> StreamingQuery:
    """Feed micro-batches to ``apply`` (usually ``Indexer.near_realtime``).

    An ``apply`` with a parameter ``batch_id`` gets the number of the batch, which a replay repeats, and one
    with a parameter ``stream`` the identity of the query, which its checkpoint keeps.

    With an ``interval`` the stream runs until stopped; without one it works through
    what is there and ends.
    """

    wanted = inspect.signature(apply).parameters

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        known = {"batch_id": batch_id, "stream": query}
        apply(batch, **{name: value for name, value in known.items() if name in wanted})

    writer = changes.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()
