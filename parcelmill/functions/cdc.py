"""Column expressions over change-event envelopes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

OPEN_END = "9999-12-31 23:59:59"
EPOCH_START = "1970-01-01 00:00:00"


def envelope(raw: Column, image: DataType | None = None) -> Column:
    """The message parsed once, as a struct of both envelope forms (flat, and under ``payload``).

    ``image`` is the type of ``before`` and ``after``: a string keeps their JSON text, a struct reads
    the row in the same pass, None leaves them out. Unreadable messages give NULL fields.
    """
    level = [StructField("op", StringType()), StructField("ts_ms", StringType())]
    if image is not None:
        level += [StructField("before", image), StructField("after", image)]
    return F.from_json(raw, StructType([StructField("payload", StructType(level)), *level]))


def change_op(message: Column) -> Column:
    return F.coalesce(message["payload"]["op"], message["op"])


def change_ts_ms(message: Column) -> Column:
    return F.coalesce(message["payload"]["ts_ms"], message["ts_ms"]).try_cast("bigint")


def row_image(message: Column) -> Column:
    """The row: nested after, nested before, flat after, flat before."""
    nested = message["payload"]
    return F.coalesce(nested["after"], nested["before"], message["after"], message["before"])


def event_time(ts_ms: Column) -> Column:
    """Timestamp of the change, milliseconds kept."""
    return F.timestamp_millis(ts_ms)


def open_end() -> Column:
    return F.lit(OPEN_END).cast("timestamp")
