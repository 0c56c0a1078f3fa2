"""Lake tables by path, by SQL, and by named collection."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scan(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    return spark.read.format(fmt).options(**options).load(path)


def path_relation(path: str, fmt: str = "parquet") -> str:
    """Path-addressed table for use in a FROM clause."""
    if "`" in path or not re.fullmatch(r"\w+", fmt):
        raise ValueError("not a plain path or format")
    return f"{fmt}.`{path}`"


class NamedCollections:
    """Names for base locations, so that a query names a collection and a table below it."""

    def __init__(self, locations: dict[str, str], fmt: str = "parquet"):
        self.locations, self.fmt = dict(locations), fmt

    def path(self, name: str, table: str = "") -> str:
        if name not in self.locations:
            raise KeyError(f"unknown collection {name!r}")
        return f"{self.locations[name].rstrip('/')}/{table}".rstrip("/")

    def load(self, spark: SparkSession, name: str, table: str = "") -> DataFrame:
        return scan(spark, self.path(name, table), self.fmt)


def from_file_path(partition: str) -> Column:
    """Value of ``partition`` in the directory name of the row's file (``name=value``)."""
    return F.regexp_extract(F.col("_metadata.file_path"), f"{partition}=([^/]+)", 1)
