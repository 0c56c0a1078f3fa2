"""Bulk scan of an operational table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

FETCH_SIZE = 20_000


@dataclass(frozen=True)
class SplitColumn:
    """Numeric, date or timestamp column whose range is cut into ``parts`` parallel reads."""

    name: str
    lower: str
    upper: str
    parts: int


def jdbc_options(
    url: str, table: str, properties: dict[str, str], split: SplitColumn | None = None
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "fetchsize": str(FETCH_SIZE), **properties}
    if split is not None:
        options |= {
            "partitionColumn": split.name,
            "lowerBound": split.lower,
            "upperBound": split.upper,
            "numPartitions": str(split.parts),
        }
    return options


def read_table(
    spark: SparkSession, url: str, table: str, properties: dict[str, str], split: SplitColumn | None = None
) -> DataFrame:
    """Whole table; rows outside the split bounds are read by the first and last part."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, properties, split)).load()
