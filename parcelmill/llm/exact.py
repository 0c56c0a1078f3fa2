"""Exact duplicates: frequent digests are settled on the map side, the rest by an ordinary shuffle.

Misra-Gries summaries of a fixed number of counters are made per partition and merged; every digest held by
more than one row in ``counters + 1`` is sure to be in the merged summary. The candidates are counted exactly
(verified), and the winners, at most ``counters`` rows, are broadcast: rows that hold them are settled without
being moved. All other digests are grouped by a shuffle, where no group is larger than that share.

Defined cases: null text counts as empty; equal means identical; the row with the largest ``doc_id`` stays (a
null ``doc_id`` stays only where the group has no other); of repeated rows with that ``doc_id`` each is marked
as kept; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmill import session
from parcelmill.llm import tasks

COUNTERS = 256
MERGED_AT_ONCE = 64  # summaries that one task merges


def reduce_counters(counts: dict[str, int], counters: int) -> dict[str, int]:
    """At most ``counters`` of the counts: all are lowered by the first one left out (mergeable Misra-Gries)."""
    if len(counts) <= counters:
        return counts
    floor = sorted(counts.values(), reverse=True)[counters]
    return {k: v - floor for k, v in counts.items() if v > floor}


def _summary(batches, counters: int):
    held: dict[str, int] = {}
    for batch in batches:
        for item in pc.value_counts(batch["text_sha256"]).to_pylist():
            held[item["values"]] = held.get(item["values"], 0) + item["counts"]
        held = reduce_counters(held, counters)
    return held


def _rows(held: dict[str, int], bucket: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([bucket] * len(held), pa.int32()), pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
        ["bucket", "text_sha256", "n"],
    )


SUMMARY = "bucket int, text_sha256 string, n long"


def frequent(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` digests, among them every one held by more than ``1 / (counters + 1)`` of the rows."""

    def summed(batches):
        from pyspark import TaskContext

        yield _rows(_summary(batches, counters), TaskContext.get().partitionId())

    def merged(key: tuple, table: pa.Table) -> pa.Table:
        held: dict[str, int] = {}
        for k, v in zip(table["text_sha256"].to_pylist(), table["n"].to_pylist()):
            held[k] = held.get(k, 0) + v
        return pa.Table.from_batches([_rows(reduce_counters(held, counters), key[0].as_py())])

    parts = digests.rdd.getNumPartitions()
    found = digests.select("text_sha256").mapInArrow(summed, SUMMARY)
    while True:
        parts = tasks.shares(parts, MERGED_AT_ONCE)
        found = found.withColumn("bucket", (F.col("bucket") % parts).cast("int")).groupBy("bucket").applyInArrow(merged, SUMMARY)
        if parts == 1:
            return found.select("text_sha256")


def exact_duplicates(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row."""
    digests = tasks.texts(docs).select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
    digests = session.stage(digests, "digests")
    candidates = session.stage(frequent(digests, counters), "frequent")
    winners = (
        digests.join(F.broadcast(candidates), "text_sha256")  # at most COUNTERS rows
        .groupBy("text_sha256")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .filter("group_size > 1")
    )
    winners = session.stage(winners, "winners")
    heavy = digests.join(F.broadcast(winners), "text_sha256")
    light = digests.join(F.broadcast(winners.select("text_sha256")), "text_sha256", "left_anti")
    groups = light.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    both = heavy.unionByName(light.join(groups, "text_sha256"))
    return both.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
