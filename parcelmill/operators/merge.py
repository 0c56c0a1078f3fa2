"""MERGE semantics as joins, for tables whose format has no MERGE of its own.

Both sides are unique on the key, so neither join can be skewed by a hot key. No side is hinted:
Spark broadcasts a small change set by its size and shuffles a large one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmill.functions.shape import align_to, evolve_union
from parcelmill.operators.dedup import dedup_latest
from parcelmill.schemas import CDC_COLUMNS

UPSERT_OPS = ["r", "c", "u"]
DELETE_OP = "d"


def merge_delete(target: DataFrame, keys_of: DataFrame, keys: list[str]) -> DataFrame:
    """Target without the keys of ``keys_of``."""
    return target.join(keys_of.select(*keys), keys, "left_anti").select(*target.columns)


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Matched rows are replaced, others inserted; new source columns are added to the result."""
    source = align_to(source, target.schema)
    return evolve_union(merge_delete(target, source, keys), source)


def merge_update(
    target: DataFrame, source: DataFrame, keys: list[str], when: Column, changes: dict[str, Column]
) -> DataFrame:
    """Set columns on matched target rows for which ``when`` holds; rows are neither added nor removed.

    ``when`` and the new values may use the target's columns and the source's non-key columns.
    """
    marked = source.withColumn("_matched", F.lit(True))
    joined = target.join(marked, keys, "left")
    hit = F.coalesce(F.col("_matched") & when, F.lit(False))
    return joined.select(
        *[
            F.when(hit, changes[c]).otherwise(F.col(f"`{c}`")).cast(target.schema[c].dataType).alias(c)
            if c in changes
            else F.col(f"`{c}`")
            for c in target.columns
        ]
    )


def close_versions(history: DataFrame, first_event: DataFrame, keys: list[str]) -> DataFrame:
    """Close the current version of every key at its first new event time (``first_event_time``)."""
    return merge_update(
        history,
        first_event,
        keys,
        (F.col("is_current") == 1) & (F.col("valid_from") < F.col("first_event_time")),
        {"is_current": F.lit(0), "valid_to": F.col("first_event_time")},
    )


def merge_into_table(source: DataFrame, table: str, keys: list[str], delete: Column | None = None):
    """MERGE writer for a catalog table whose format supports it; call ``merge()`` on the result.

    Matched rows for which ``delete`` holds are removed, other matched rows replaced, the rest
    inserted. Only the files that hold matched rows are rewritten.
    """
    on = reduce(lambda a, b: a & b, [F.expr(f"{table}.{k} = source.{k}") for k in keys])
    writer = source.alias("source").mergeInto(table, on)
    if delete is not None:
        return (
            writer.whenMatched(delete).delete().whenMatched().updateAll().whenNotMatched(~delete).insertAll()
        )
    return writer.whenMatched().updateAll().whenNotMatched().insertAll()


def route_ops(latest: DataFrame, stamp: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows to upsert (stamped, without change-log columns) and rows whose keys are deleted."""
    stamp = F.current_timestamp() if stamp is None else stamp
    upserts = latest.filter(F.col("op").isin(UPSERT_OPS)).drop(*CDC_COLUMNS).withColumn("ingested_at", stamp)
    deletes = latest.filter(F.col("op") == DELETE_OP).drop(*CDC_COLUMNS)
    return upserts, deletes


def apply_value(
    current: DataFrame | None,
    valid: DataFrame,
    keys: list[str],
    full_refresh: bool = False,
    stamp: Column | None = None,
) -> DataFrame:
    """Current-state snapshot after a batch of changes; applying a batch twice changes nothing.

    Batches must come in log order. Where they may not, ``history.refresh_value`` takes the state from
    the history instead. One anti join removes both replaced and deleted keys, since the last change of a key is either.
    """
    latest = dedup_latest(valid, keys)
    upserts, _ = route_ops(latest, stamp)
    if current is None or full_refresh:
        return upserts
    upserts = align_to(upserts, current.schema)
    touched = align_to(latest.select(*keys), current.schema)
    return evolve_union(merge_delete(current, touched, keys), upserts)
