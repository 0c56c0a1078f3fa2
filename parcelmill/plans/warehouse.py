"""Warehouse copy of the booking table: versioned appends and a last-version-wins view."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmill.operators.dedup import last_version
from parcelmill.plans.gold import BOOKING_KEY, newer_than
from parcelmill.session import small_splits
from parcelmill.sinks import tables

REQUIRED = ["BOOKING_ID", "BOOKING_DATE", "ingested_at"]
SORT = ["BOOKING_DATE", "BOOKING_ID"]


def loadable(wide: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Rows with all required columns, stamped with the load time."""
    return wide.filter(_complete()).withColumn(
        "olap_loaded_at", F.current_timestamp() if loaded_at is None else loaded_at
    )


def rejects(wide: DataFrame) -> DataFrame:
    """The rows that ``loadable`` leaves out, with the columns that they lack."""
    return wide.withColumn("error_reason", F.concat(F.lit("MISSING "), F.array_join(_missing(), ","))).filter(~_complete())


def _complete() -> Column:
    """Reaches the scan, whose statistics tell most files without a look at their rows."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in REQUIRED])


def _missing() -> Column:
    return F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED]))


def incremental(wide: DataFrame, base: DataFrame) -> DataFrame:
    """Rows at or above the newest stamp already loaded; a row at the bound is loaded again and the
    view drops the copy."""
    return newer_than(wide, base, inclusive=True)


def month(column: str = "BOOKING_DATE") -> Column:
    return F.date_format(column, "yyyyMM").cast("int")


def write_base(rows: DataFrame, path: str, clustered: bool = False) -> None:
    """Append sorted files, one directory per booking month.

    ``clustered`` says that the rows are read from files of narrow ranges of dates; they aren't shuffled then.
    """
    if clustered:
        with small_splits(rows.sparkSession):
            sorted_rows = rows.withColumn("booking_month", month()).sortWithinPartitions("booking_month", *SORT)
            tables.append(sorted_rows, path, ["booking_month"])
    else:
        ranged = rows.repartitionByRange(*SORT).sortWithinPartitions(*SORT)
        tables.append(ranged.withColumn("booking_month", month()), path, ["booking_month"])


def final_view(base: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Newest version per key. The default key is the booking alone: a booking whose date moved to
    another month still has one live row."""
    return last_version(base, keys or BOOKING_KEY, "ingested_at", "olap_loaded_at")


def publish(spark: SparkSession, path: str, name: str = "obt_shipment_analytics") -> DataFrame:
    view = final_view(spark.read.parquet(path)).drop("booking_month")
    tables.publish_view(view, name)
    return view
