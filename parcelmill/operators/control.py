"""Batch windows, watermarks, lineage and reconciliation."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmill.functions.cdc import EPOCH_START, OPEN_END
from parcelmill.schemas import LINEAGE, WATERMARKS, column_names


def batch_window(
    watermark: str | None, from_ts: str | None = None, to_ts: str | None = None, full_refresh: bool = False
) -> tuple[str, str]:
    """Inclusive bounds of a batch: full refresh, then an explicit start, then the watermark."""
    start = EPOCH_START if full_refresh else (from_ts or watermark or EPOCH_START)
    return start, to_ts or OPEN_END


def in_window(start: str, end: str) -> Column:
    """``start <= event_time <= end``. Messages without a readable time cannot be placed in a window;
    they are kept, to end in quarantine."""
    low, high = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    at = F.col("event_time")
    return at.isNull() | ((at >= low) & (at <= high))


def window_slice(bronze: DataFrame, topic: str, start: str, end: str) -> DataFrame:
    """Messages of one topic in a window of event times.

    The topic is a partition column and the bounds are literals, so both reach the scan.
    """
    return bronze.filter((F.col("kafka_topic") == topic) & in_window(start, end))


def after_cutoffs(bronze: DataFrame, topic: str, cutoffs: dict[int, int]) -> DataFrame:
    """Messages of one topic beyond the last processed offset of their log partition, whatever their time.

    One disjunct per log partition, all literals, so that the bounds reach the scan.
    """
    part, offset = F.col("kafka_partition"), F.col("kafka_offset")
    new = part.isNull() | ~part.isin(list(cutoffs)) if cutoffs else F.lit(True)
    for partition, last in cutoffs.items():
        new = new | ((part == partition) & (offset > last))
    return bronze.filter((F.col("kafka_topic") == topic) & new)


def next_cutoffs(pending: DataFrame, taken: Column) -> dict[int, tuple[str | None, int | None]]:
    """Newest event time and safe offset of each log partition after the ``taken`` part of what was pending.

    An offset is safe up to the first message that was left out. Only columns of the log are read.
    """
    left_out = ~taken
    rows = pending.groupBy("kafka_partition").agg(
        F.max(F.when(taken, F.col("event_time"))).cast("string").alias("at"),
        F.max("kafka_offset").alias("last"),
        F.min(F.when(left_out, F.col("kafka_offset"))).alias("first_out"),
    )
    return {  # one row per log partition
        r["kafka_partition"]: (r["at"], r["last"] if r["first_out"] is None else r["first_out"] - 1)
        for r in rows.collect()
        if r["kafka_partition"] is not None
    }


def high_watermark(slice_: DataFrame, *by: str) -> DataFrame:
    """Highest event time and offset of a slice; offsets compare only within a log partition."""
    return slice_.groupBy(*by).agg(
        F.max("event_time").alias("max_event_time"), F.max("kafka_offset").alias("max_offset")
    )


def load_watermarks(control: DataFrame) -> dict[str, dict[int, dict]]:
    """Watermarks by table and log partition. The table holds one row for each of these."""
    marks: dict[str, dict[int, dict]] = {}
    for r in control.filter("table_name IS NOT NULL").collect():
        marks.setdefault(r["table_name"], {})[r["kafka_partition"]] = {
            "last_processed_ts": r["last_processed_ts"] or EPOCH_START,
            "last_processed_offset": -1 if r["last_processed_offset"] is None else r["last_processed_offset"],
            "last_batch_id": r["last_batch_id"],
        }
    return marks


def watermark_frame(spark: SparkSession, marks: dict[str, dict[int, dict]], at: datetime) -> DataFrame:
    rows = [
        (t, p, m["last_processed_ts"], m["last_processed_offset"], m["last_batch_id"], at)
        for t, parts in marks.items()
        for p, m in parts.items()
    ]
    return spark.createDataFrame(rows, WATERMARKS).coalesce(1)


def lineage_frame(spark: SparkSession, records: list[dict]) -> DataFrame:
    return spark.createDataFrame([tuple(r[c] for c in column_names(LINEAGE)) for r in records], LINEAGE).coalesce(1)


def batch_metrics() -> list[Column]:
    """Metrics of a classified slice, for ``observe`` on the write that materialises it."""
    return [
        F.count(F.lit(1)).alias("read"),
        F.count_if(F.col("error_reason").isNotNull()).alias("rejected"),
    ]


def reconcile(tables: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Value rows against active history rows, one line per table."""
    value_counts, history_counts = [], []
    for name, (value, history) in tables.items():
        value_counts.append(value.agg(F.count(F.lit(1)).alias("value_count")).withColumn("table_name", F.lit(name)))
        history_counts.append(
            history.agg(
                F.count(F.lit(1)).alias("history_total"),
                F.count_if(F.col("is_current") == 1).alias("history_active"),
                F.count_if(F.col("is_current") == 0).alias("history_closed"),
            ).withColumn("table_name", F.lit(name))
        )
    union = lambda frames: reduce(DataFrame.unionByName, frames)
    both = union(value_counts).join(union(history_counts), "table_name")
    return both.select(
        "table_name",
        "value_count",
        "history_total",
        "history_active",
        "history_closed",
        (F.col("value_count") == F.col("history_active")).alias("matches"),
    )
