from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from conftest_texts import TEXTS  # noqa: E402

SCHEMA = StructType(
    [StructField("doc_id", LongType()), StructField("text", StringType())]
    + [StructField(c, IntegerType()) for c in ("uid", "fp", "n", "digest", "anchor", "text_sha256", "block", "row", "bucket", "length")]
)

@pytest.fixture(scope="session")
def odd(spark):
    """Documents with every odd case, and extra columns with clashing names."""
    rows = [(i, t, *[k] * 10) for k, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
