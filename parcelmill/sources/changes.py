"""Change-event log: read messages, project them to Bronze rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parcelmill.functions import cdc


def topic_pattern(prefix: str) -> str:
    return f"{prefix}.*"


def log_options(servers: str, prefix: str) -> dict[str, str]:
    """Options of ``fmt="kafka"``: every topic below the prefix, from the earliest offset."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribePattern": topic_pattern(prefix),
        "startingOffsets": "earliest",
    }


def read_changes(
    spark: SparkSession,
    fmt: str = "kafka",
    options: dict[str, str] | None = None,
    path: str | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Stream of change messages. A log needs ``options`` only; a file source needs path and schema."""
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def to_bronze(messages: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Bronze rows from log messages; works on streams and batches alike."""
    message = F.col("message")
    return (
        messages.select(
            F.col("key").cast("string").alias("kafka_key"),
            F.col("value").cast("string").alias("raw_value"),
            F.col("topic").alias("kafka_topic"),
            F.col("partition").alias("kafka_partition"),
            F.col("offset").alias("kafka_offset"),
            F.col("timestamp").alias("kafka_timestamp"),
        )
        .withColumn("message", cdc.envelope(F.col("raw_value")))
        .withColumns({"op": cdc.change_op(message), "ts_ms": cdc.change_ts_ms(message)})
        .select(
            "kafka_key",
            "raw_value",
            "op",
            "ts_ms",
            "kafka_topic",
            "kafka_partition",
            "kafka_offset",
            "kafka_timestamp",
            cdc.event_time(F.col("ts_ms")).alias("event_time"),
            (F.current_timestamp() if ingested_at is None else ingested_at).alias("ingested_at"),
        )
    )


def backfill(bronze: DataFrame) -> DataFrame:
    """Fill rows without an event time: op, ts_ms and the time are read from the message again."""
    if "event_time" not in bronze.columns:
        bronze = bronze.withColumn("event_time", F.lit(None).cast("timestamp"))
    missing, message = F.col("event_time").isNull(), F.col("_message")
    ts_ms = cdc.change_ts_ms(message)
    fixed = {"op": cdc.change_op(message), "ts_ms": ts_ms, "event_time": cdc.event_time(ts_ms)}
    parsed = bronze.withColumn("_message", F.when(missing, cdc.envelope(F.col("raw_value"))))
    return parsed.select(
        *[F.when(missing, fixed[c]).otherwise(F.col(c)).alias(c) if c in fixed else F.col(c) for c in bronze.columns]
    )


def profile(bronze: DataFrame, topic: str = "kafka_topic") -> DataFrame:
    return (
        bronze.groupBy(F.col(topic).alias("table_name"))
        .agg(
            F.count(F.lit(1)).alias("total_records"),
            F.min("event_time").alias("min_event_time"),
            F.max("event_time").alias("max_event_time"),
        )
        .orderBy(F.col("total_records").desc(), "table_name")
    )


def latest_messages(bronze: DataFrame, n: int, preview: int = 100) -> DataFrame:
    """Last ``n`` messages with the first ``preview`` characters of each."""
    return (
        bronze.orderBy(F.col("kafka_offset").desc(), "kafka_topic", "kafka_partition")
        .limit(n)
        .select(
            F.col("kafka_topic").alias("table_name"),
            "op",
            "kafka_offset",
            "event_time",
            F.substring("raw_value", 1, preview).alias("raw_sample"),
        )
    )
