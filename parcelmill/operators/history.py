"""SCD Type 2 history that stays right under replays and late events.

A stored history row is one change: the source columns, ``op``, ``kafka_offset``, its interval
``[valid_from, valid_to)``, ``is_current`` and ``ingested_at``. A delete is stored as a zero-length
tombstone so that a later rebuild does not stretch the version before it; ``public_history`` hides it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelmill.functions.cdc import open_end
from parcelmill.functions.shape import align_to, evolve_union
from parcelmill.operators.dedup import latest_per_key
from parcelmill.operators.merge import DELETE_OP, merge_delete
from parcelmill.session import stage

# A key with more changes than this is split by time before its timeline is chained.
HOT_KEY_ROWS = 1_000_000
# Width of a slice of a hot key. Times are unique per key after the dedup and carry milliseconds,
# so one slice holds at most SLICE_MS rows.
SLICE_MS = 3_600_000

INTERVAL_COLUMNS = ["valid_from", "valid_to", "is_current", "ingested_at"]


def event_rows(valid: DataFrame, keys: list[str], stamp: Column | None = None) -> DataFrame:
    """Changes as history candidates, one per (key, event time): the highest offset wins."""
    stamp = F.current_timestamp() if stamp is None else stamp
    rows = (
        valid.drop("ts_ms", "kafka_partition", "kafka_timestamp")
        .withColumnRenamed("cdc_event_time", "valid_from")
        .withColumn("ingested_at", stamp)
    )
    return latest_per_key(rows, [*keys, "valid_from"], [F.col("kafka_offset").desc()])


def hot_keys(events: DataFrame, keys: list[str], hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    counts = events.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") > hot_rows).select(*keys, F.lit(True).alias("_hot"))


def chain(
    events: DataFrame,
    keys: list[str],
    time: str = "valid_from",
    hot_rows: int = HOT_KEY_ROWS,
    slice_ms: int = SLICE_MS,
    times: DataFrame | None = None,
) -> DataFrame:
    """Add ``next_time``, the time of the next change of the same key.

    Keys up to ``hot_rows`` changes are chained in one window. A hot key is cut into time slices that
    are chained separately; the last row of a slice takes the first time of the key's next slice.
    ``times`` may name a cheaper frame with the same keys and times (repeats do no harm), from which
    the hot keys and the slice starts are read instead of from ``events``.
    """
    times = (events if times is None else times).select(*keys, time)
    hot = hot_keys(times, keys, hot_rows)
    slice_of = F.floor(F.unix_millis(time) / F.lit(slice_ms))
    sliced = events.join(hot, keys, "left").withColumn("_slice", F.when(F.col("_hot"), slice_of))
    per_slice = Window.partitionBy(*keys, "_slice").orderBy(F.col(time), F.col("kafka_offset"))
    chained = sliced.withColumn("next_time", F.lead(time).over(per_slice))
    # one row per slice of a hot key, so this window sees hours, not changes
    per_key = Window.partitionBy(*keys).orderBy("_slice")
    starts = (
        times.join(hot, keys)
        .groupBy(*keys, slice_of.alias("_slice"))
        .agg(F.min(time).alias("_start"))
        .withColumn("_next_start", F.lead("_start").over(per_key))
        .select(*keys, "_slice", "_next_start")
    )
    return (
        chained.join(starts, [*keys, "_slice"], "left")
        .withColumn("next_time", F.coalesce("next_time", "_next_start"))
        .select(*events.columns, "next_time")
    )


def intervals(chained: DataFrame) -> DataFrame:
    """Interval and current flag from the chained times."""
    last = F.col("next_time").isNull()
    deleted = F.col("op") == DELETE_OP
    # a tombstone keeps zero length whatever follows it
    end = F.when(deleted, F.col("valid_from")).when(last, open_end()).otherwise(F.col("next_time"))
    return (
        chained.withColumn("valid_to", end)
        .withColumn("is_current", F.when(last & ~deleted, 1).otherwise(0))
        .drop("next_time")
    )


def build_history(
    valid: DataFrame, keys: list[str], stamp: Column | None = None, hot_rows: int = HOT_KEY_ROWS
) -> DataFrame:
    """History of a complete set of changes."""
    times = valid.select(*keys, F.col("cdc_event_time").alias("valid_from"))
    return _ordered(intervals(chain(event_rows(valid, keys, stamp), keys, hot_rows=hot_rows, times=times)))


def new_events(
    events: DataFrame, history: DataFrame, keys: list[str], since: DataFrame | None = None
) -> DataFrame:
    """Candidates whose (key, time, offset) is not in history yet.

    History is read from the earliest candidate time on: the bound is a scalar subquery that Spark
    pushes into the scan. ``since`` may give it as a one-row frame that is cheaper than ``events``.
    """
    since = events.agg(F.min("valid_from").alias("t")) if since is None else since
    known = history.filter(F.col("valid_from") >= since.scalar()).select(*keys, "valid_from", "kafka_offset")
    return events.join(known, [*keys, "valid_from", "kafka_offset"], "left_anti")


def rebuild(
    history: DataFrame,
    valid: DataFrame,
    keys: list[str],
    stamp: Column | None = None,
    hot_rows: int = HOT_KEY_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Versions that a batch leaves alone, and the versions that it adds or derives again."""
    return rebuild_from(history, fresh_events(history, valid, keys, stamp), keys, hot_rows)


def fresh_events(history: DataFrame, valid: DataFrame, keys: list[str], stamp: Column | None = None) -> DataFrame:
    """The changes of a batch that the history doesn't have, written aside: they are few and read several times."""
    candidates = align_to(event_rows(valid, keys, stamp), history.schema)
    earliest = valid.agg(F.min("cdc_event_time").alias("t"))
    return stage(new_events(candidates, history, keys, earliest), "new-events")


def rebuild_from(
    history: DataFrame, fresh: DataFrame, keys: list[str], hot_rows: int = HOT_KEY_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Kept and rebuilt versions, from new events.

    All events of the reopened tails are written aside as well. Versions that ended before the first new
    event of the whole batch, which is most of a long history, pass by without a join.
    """
    since = fresh.agg(F.coalesce(F.min("valid_from"), open_end()).alias("t")).scalar()
    past = history.filter(F.col("valid_to") < since)
    first = fresh.groupBy(*keys).agg(F.min("valid_from").alias("_first"))
    recent = history.filter(F.col("valid_to") >= since).join(first, keys, "left")
    # NULL _first means that no new event touches the key
    reopened = F.coalesce(F.col("valid_to") >= F.col("_first"), F.lit(False))
    kept = past.unionByName(recent.filter(~reopened).select(*history.columns))
    tail = recent.filter(reopened).drop("_first", "valid_to", "is_current")
    newest = [F.col("kafka_offset").desc(), F.col("ingested_at")]
    events = stage(latest_per_key(evolve_union(tail, fresh), [*keys, "valid_from"], newest), "reopened")
    return kept, _ordered(intervals(chain(events, keys, hot_rows=hot_rows)))


def refresh_value(value: DataFrame, rebuilt: DataFrame, keys: list[str]) -> DataFrame:
    """Current state after a batch, from the versions that the batch derived again.

    The history decides which change is the last one, so a late or repeated batch cannot put an older
    row back or revive a deleted key. A key without a current version leaves the table.
    """
    current = current_state(rebuilt)
    return evolve_union(merge_delete(value, rebuilt.select(*keys).distinct(), keys), align_to(current, value.schema))


def current_state(history: DataFrame) -> DataFrame:
    """The current version of every key as a row of the value table."""
    return current_versions(history).drop("valid_from", "valid_to", "is_current")


def apply_history(
    history: DataFrame | None,
    valid: DataFrame,
    keys: list[str],
    full_refresh: bool = False,
    stamp: Column | None = None,
    hot_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """History after a batch of changes, in any order and with any repeats.

    Only the versions of changed keys that end at or after the key's first new event are derived
    again; everything before them is kept as it is.
    """
    if history is None or full_refresh:
        return build_history(valid, keys, stamp, hot_rows)
    return join_up(*rebuild(history, valid, keys, stamp, hot_rows))


def join_up(kept: DataFrame, rebuilt: DataFrame) -> DataFrame:
    return _ordered(evolve_union(kept, rebuilt))


def history_changes(
    history: DataFrame,
    valid: DataFrame,
    keys: list[str],
    stamp: Column | None = None,
    hot_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Only the rows that a batch adds or changes: the source of a MERGE on (key, ``valid_from``).

    A table format with MERGE then rewrites the files of these rows, not the whole history.
    """
    return rebuild(history, valid, keys, stamp, hot_rows)[1]


def baseline_history(snapshot: DataFrame, loaded_at: Column) -> DataFrame:
    """First history from a bulk snapshot: every row open and current since the load.

    Offset -1 lets any change from the log win over the baseline at the same time.
    """
    return _ordered(
        snapshot.withColumn("op", F.lit("r"))
        .withColumn("kafka_offset", F.lit(-1).cast("long"))
        .withColumn("valid_from", loaded_at)
        .withColumn("valid_to", open_end())
        .withColumn("is_current", F.lit(1))
        .withColumn("ingested_at", loaded_at)
    )


def public_history(history: DataFrame) -> DataFrame:
    """Versions only: tombstones and log columns are hidden."""
    return history.filter(F.col("op") != DELETE_OP).drop("op", "kafka_offset")


def current_versions(history: DataFrame) -> DataFrame:
    return public_history(history).filter("is_current = 1")


def closed_versions(history: DataFrame) -> DataFrame:
    return public_history(history).filter("is_current = 0")


def as_of(history: DataFrame, moment: Column) -> DataFrame:
    """Versions valid at ``moment``."""
    return public_history(history).filter((F.col("valid_from") <= moment) & (F.col("valid_to") > moment))


def _ordered(history: DataFrame) -> DataFrame:
    tail = ["op", "kafka_offset", *INTERVAL_COLUMNS]
    return history.select(*[c for c in history.columns if c not in tail], *tail)
