"""Streams and sinks. Each query drains its source, so its result is that of a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmill import session
from parcelmill.operators.history import public_history
from parcelmill.plans import domain
from parcelmill.plans.medallion import SilverTable
from parcelmill.registry.base import query, stored, whole_sums
from parcelmill.registry.cdc import HISTORY_SQL, KEYS, history_out, topics_bronze, topics_bronze_path, user_schema
from parcelmill.registry.sql import with_
from parcelmill.sinks import tables
from parcelmill.sources import changes
from parcelmill.streaming.bronze import write_bronze
from parcelmill.streaming.silver import write_silver


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = domain.table(spark, sf, "events").schema
    return changes.read_changes(spark, "parquet", {"pathGlobFilter": "events.parquet"}, sf, schema)


def message_stream(spark: SparkSession, sf: str) -> DataFrame:
    return domain.change_messages(spark, sf, event_stream(spark, sf), by_type=True)


_BY_TOPIC = with_(
    "messages",
    """SELECT concat('cdc.', upper(event_type)) AS kafka_topic, op, count(*) AS n, CAST(sum(ts_ms) AS BIGINT) AS sum_ms
FROM messages GROUP BY ALL""",
)


def _by_topic(bronze: DataFrame) -> DataFrame:
    return whole_sums(bronze.groupBy("kafka_topic", "op"), "ts_ms", "sum_ms")


@query(
    "src_cdc_stream",
    with_("messages", "SELECT concat('cdc.', upper(event_type)) AS topic, event_id AS \"offset\" FROM messages"),
)
def _(spark, sf):
    """Messages of the stream, drained into a table."""
    path = session.scratch_path(spark, "messages")
    stream = message_stream(spark, sf).select("topic", "offset")
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", f"{path}-ckpt")
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(path)


@query("sink_bronze_append", _BY_TOPIC)
def _(spark, sf):
    path = session.scratch_path(spark, "bronze-stream")
    write_bronze(changes.to_bronze(message_stream(spark, sf)), path, f"{path}-ckpt").awaitTermination()
    return _by_topic(spark.read.parquet(path))


@query("sink_available_now", _BY_TOPIC)
def _(spark, sf):
    """Drained twice from one checkpoint: the second run finds nothing new."""
    path = session.scratch_path(spark, "bronze-twice")
    for _ in range(2):
        write_bronze(changes.to_bronze(message_stream(spark, sf)), path, f"{path}-ckpt").awaitTermination()
    return _by_topic(spark.read.parquet(path))


def streamed_silver(spark: SparkSession, sf: str) -> SilverTable:
    """Silver of the users, fed from Bronze in about three batches of files: the event types arrive one
    after the other, so most changes are late."""

    def table_at(base: str) -> SilverTable:
        return SilverTable(KEYS, f"{base}/value", f"{base}/history", f"{base}/dlq")

    def write(base: str) -> None:
        path = topics_bronze_path(spark, sf)
        size = {"maxBytesPerTrigger": str(max(1, session.input_bytes(spark, path) // 3))}
        stream = changes.read_changes(spark, "parquet", size, path, topics_bronze(spark, sf).schema)
        write_silver(stream, table_at(base), f"{base}/ckpt", user_schema()).awaitTermination()

    return table_at(stored(spark, sf, "silver-stream", write))


@query("silver_foreach_batch", HISTORY_SQL)
def _(spark, sf):
    return history_out(public_history(tables.read_snapshot(spark, streamed_silver(spark, sf).history)))


@query(
    "silver_foreach_batch_value",
    with_("history", "SELECT ID, STATUS, AMOUNT FROM history WHERE is_current = 1"),
)
def _(spark, sf):
    """The current state that the same late batches leave."""
    return tables.read_snapshot(spark, streamed_silver(spark, sf).value).select("ID", "STATUS", "AMOUNT")


@query(
    "sink_overwrite",
    """SELECT event_type, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS sum_user,
       count(*) FILTER (value > 50) AS large FROM events GROUP BY event_type""",
)
def _(spark, sf):
    """A snapshot is replaced by a table computed from itself, with another schema."""
    path = session.scratch_path(spark, "snapshot")
    tables.write_snapshot(domain.table(spark, sf, "events").select("event_type", "user_id", "value"), path)
    old = tables.read_snapshot(spark, path)
    tables.write_snapshot(old.select("event_type", "user_id", (F.col("value") > 50).alias("large")), path)
    new = tables.read_snapshot(spark, path)
    return new.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("user_id").alias("sum_user"), F.count_if("large").alias("large")
    )


@query(
    "sink_append_merge_schema",
    """SELECT event_type, count(*) AS n, CAST(sum(CASE WHEN event_type = 'purchase' THEN user_id END) AS BIGINT) AS buyers
FROM events GROUP BY event_type""",
)
def _(spark, sf):
    """The second append brings a column that the first did not have."""
    path = session.scratch_path(spark, "appended")
    events = domain.table(spark, sf, "events")
    tables.append(events.filter("event_type <> 'purchase'").select("event_id", "event_type"), path)
    tables.append(
        events.filter("event_type = 'purchase'").select("event_id", "event_type", F.col("user_id").alias("BUYER")), path
    )
    return tables.read_appended(spark, path).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("BUYER").alias("buyers")
    )
