"""Every registered query against its SQL."""

from __future__ import annotations

import pytest

import checking
from __spark_entry__ import entry, oracle_sql, queries
from parcelmill.registry import QUERIES, base


@pytest.fixture(scope="module")
def con(sf):
    return checking.connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf, con, name):
    sql = oracle_sql()[name]
    assert checking.differences(queries()[name](spark, sf), con, sql) is None


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    rows = entry(spark).collect()
    assert 0 < len(rows) <= 20


def test_sums_beyond_a_long_stay_exact(spark):
    """Sums of times in milliseconds pass 64 bits at some millions of rows."""
    rows = spark.createDataFrame([("a", 2**62), ("a", 2**62), ("a", 2**62 + 1), ("b", 5), ("c", None)], "g string, v long")
    sums = base.edge(base.whole_sums(rows.groupBy("g"), "v", "s"))
    assert sorted(map(tuple, sums.collect()), key=str) == [("a", 3, 3 * 2**62 + 1), ("b", 1, 5), ("c", 1, None)]
    small = base.edge(base.whole_sums(rows.filter("g <> 'a'").groupBy("g"), "v", "s"))
    assert small.schema["s"].dataType.simpleString() == "bigint"
