"""Profiles and constraint checks, each one pass per table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [
        df.agg(F.count(F.lit(1)).alias("record_count")).select(F.lit(name).alias("table_name"), "record_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs per NOT NULL column, counted in a single aggregate and then turned into rows."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "null_rows")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once. Counts combine map-side, so a hot key is one row per task."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def orphan_keys(fact: DataFrame, column: str, dim: DataFrame, key: str) -> DataFrame:
    """Foreign keys without a dimension row, with the number of fact rows; NULL is allowed.

    The fact is reduced to distinct keys with counts before the join, so the join is never skewed.
    """
    used = fact.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("fact_rows"))
    keys = dim.select(F.col(key).alias(column))
    return used.join(keys, column, "left_anti")
