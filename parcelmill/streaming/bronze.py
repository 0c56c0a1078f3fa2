"""Append-only Bronze stream sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def write_bronze(
    bronze: DataFrame,
    path: str,
    checkpoint: str,
    once: bool = True,
    interval: str = "30 seconds",
    fmt: str = "parquet",
) -> StreamingQuery:
    """Start the sink: partitioned by topic, exactly once by checkpoint and sink log.

    ``once`` drains what is there and stops; otherwise micro-batches run every ``interval``.
    """
    writer = (
        bronze.writeStream.format(fmt)
        .outputMode("append")
        .partitionBy("kafka_topic")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return writer.trigger(**trigger).start()
