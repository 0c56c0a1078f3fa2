"""Query registry and the tables that queries share within a session."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, DoubleType, TimestampNTZType

from parcelmill import session

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_stored: dict[tuple[str, str, str], str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf)`` under ``name``, with the SQL that must give the same rows."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        @wraps(fn)
        def call(spark: SparkSession, sf: str) -> DataFrame:
            session.tune(spark)
            return edge(fn(spark, sf))

        QUERIES[name] = call
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


def edge(df: DataFrame) -> DataFrame:
    """Types that every client prints alike: doubles of four decimals, dates and zoneless times as text."""

    def shaped(f):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DecimalType) and f.dataType.scale == 0:
            return c  # a whole number that no long holds
        if isinstance(f.dataType, DecimalType) and f.dataType.scale <= 4:
            return c.cast("double").alias(f.name)
        if isinstance(f.dataType, (DecimalType, DoubleType)):
            return F.round(c.cast("double"), 4).alias(f.name)
        if isinstance(f.dataType, (DateType, TimestampNTZType)):
            return c.cast("string").alias(f.name)
        return c

    return df.select(*[shaped(f) for f in df.schema.fields])


def whole_sums(groups: GroupedData, column: str, name: str) -> DataFrame:
    """Rows (``n``) and exact sums of a column of longs by group. The sums are longs if all of them fit, else decimals."""
    wide = F.sum(F.col(column).cast("decimal(20,0)")).cast("decimal(38,0)").alias(name)
    sums = session.stage(groups.agg(F.count(F.lit(1)).alias("n"), wide), "sums")
    fits = F.col(name).between(-(1 << 63), (1 << 63) - 1)
    if not sums.filter(~fits).isEmpty():
        return sums
    return sums.withColumn(name, F.col(name).cast("long"))


def stored(spark: SparkSession, sf: str, name: str, write: Callable[[str], None]) -> str:
    """Path of a table that is written once per session and input folder, for queries that read it.

    The tables stand for Bronze and Gold tables that exist before a reader comes; ``write`` builds
    them from the whole input.
    """
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _stored:
        path = session.scratch_path(spark, name)
        with session.lean_disk(spark):
            write(path)
        _stored[key] = path
    return _stored[key]
