"""Bronze to Silver: one batch per registered table."""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parcelmill.functions.cdc import EPOCH_START
from parcelmill.functions.times import to_utc
from parcelmill.operators import control, history, payload
from parcelmill.session import drop, small_splits, stage, tune
from parcelmill.sinks import tables


@dataclass(frozen=True)
class Lake:
    """Where the layers live."""

    bronze: str
    silver: str
    quarantine: str
    control: str
    topic_prefix: str = "cdc"

    def topic(self, table: str) -> str:
        return f"{self.topic_prefix}.{table}"

    @property
    def watermarks(self) -> str:
        return f"{self.control}/cutoff_watermarks"

    @property
    def lineage(self) -> str:
        return f"{self.control}/etl_batch_control"

    def table(self, name: str, keys: list[str]) -> "SilverTable":
        low = name.lower()
        return SilverTable(
            keys, f"{self.silver}/value_{low}", f"{self.silver}/history_{low}", f"{self.quarantine}/dlq_{low}"
        )


@dataclass(frozen=True)
class SilverTable:
    keys: list[str]
    value: str
    history: str
    dlq: str


@dataclass(frozen=True)
class BatchResult:
    read: int
    rejected: int
    upserted: int = 0
    history_rows: int = 0


def parse_splits(spark: SparkSession):
    """Settings for jobs that read messages: it is the parse that takes the time, so all cores should have a part of it."""
    return small_splits(spark, least="1MB")


def _observed(df: DataFrame, *metrics: Column) -> tuple[DataFrame, Observation]:
    """Metrics that are collected while ``df`` is written; nothing is counted in a pass of its own."""
    observation = Observation()
    return df.observe(observation, *metrics), observation


def apply_batch(
    bronze: DataFrame,
    table: SilverTable,
    schema: StructType | None = None,
    full_refresh: bool = False,
    units: dict[str, str] | None = None,
) -> BatchResult:
    """Parse a slice of Bronze once, then write quarantine, value and history from the parsed copy.

    All three sinks may be run again with the same slice.
    """
    spark = bronze.sparkSession
    old_value, old_rows = tables.read_snapshot(spark, table.value), tables.read_snapshot(spark, table.history)
    first = full_refresh or old_value is None or old_rows is None
    classified, schema = payload.classify(bronze, table.keys, schema, None if first else old_rows.schema)
    classified, seen = _observed(classified, *control.batch_metrics())
    parsed = stage(classified, "parsed")
    result = BatchResult(**seen.get)

    if result.rejected:
        rejects = payload.distinct_messages(payload.dead_letters(parsed))
        if tables.exists(spark, table.dlq):
            rejects = payload.new_dead_letters(rejects, tables.read_appended(spark, table.dlq))
        tables.append(rejects, table.dlq)
    if result.read == result.rejected:
        return result

    valid = payload.valid_rows(parsed, schema, units)
    stamp = F.lit(datetime.now(timezone.utc))
    changed = F.count_if(F.col("ingested_at") == stamp).alias("n")
    # the current state follows the history on every path
    # history is switched last: until then, the events still count as new and a rerun repeats both
    if first:
        rows, written = _observed(history.build_history(valid, table.keys, stamp), changed)
        new = tables.write_aside(rows, table.history)
        drop(parsed)
        rows = spark.read.schema(rows.schema).parquet(f"{table.history}/{new[0]}")
        value, upserted = _observed(history.current_state(rows), changed)
        tables.write_snapshot(value, table.value)
    else:
        fresh = history.fresh_events(old_rows, valid, table.keys, stamp)
        drop(parsed)
        if fresh.isEmpty():
            drop(fresh)
            return result
        kept, derived = history.rebuild_from(old_rows, fresh, table.keys)
        rebuilt = stage(derived, "rebuilt")
        drop(derived)  # the events of the reopened tails, the one table that these versions are read from
        value = history.refresh_value(old_value, rebuilt, table.keys)
        rows, written = _observed(history.join_up(kept, rebuilt), changed)
        value, upserted = _observed(value, changed)
        tables.write_snapshot(value, table.value)
        new = tables.write_aside(rows, table.history)
        drop(fresh, rebuilt)
    tables.switch(spark, table.history, *new)
    return replace(result, upserted=upserted.get["n"], history_rows=written.get["n"])


def run_medallion(
    spark: SparkSession,
    lake: Lake,
    registry: dict[str, list[str]],
    which: str = "ALL",
    from_ts: str | None = None,
    to_ts: str | None = None,
    full_refresh: bool = False,
    schemas: dict[str, StructType] | None = None,
    parallel: int = 4,
) -> list[dict]:
    """Process one table or all of them; returns the lineage records.

    A run takes every message beyond the last processed offset of its log partition, however old its event
    time. An explicit window takes the messages with an event time in it, processed or not; a cutoff then moves
    only up to the first message that the window left out.

    Watermarks are read once and written once, after the sinks of every table have succeeded, so a
    job that dies is simply run again. A table that is not registered is skipped. A full refresh
    rebuilds from Bronze alone and therefore drops a bulk-loaded baseline.
    """
    schemas = schemas or {}
    tune(spark)
    stored = tables.read_snapshot(spark, lake.watermarks)
    marks = {} if stored is None else control.load_watermarks(stored)
    bronze = spark.read.parquet(lake.bronze)

    def process(name: str) -> dict | None:
        started = time.time()
        own = marks.get(name, {})
        mark = max((m["last_processed_ts"] for m in own.values()), default=None)
        start, end = control.batch_window(mark, from_ts, to_ts, full_refresh)
        pending = control.after_cutoffs(
            bronze, lake.topic(name), {p: m["last_processed_offset"] for p, m in own.items()}
        )
        replay = full_refresh or from_ts is not None
        if replay:
            taken = control.in_window(start, end)
        else:
            taken = F.lit(True) if to_ts is None else control.in_window(EPOCH_START, to_ts)
        batch = control.window_slice(bronze, lake.topic(name), start, end) if replay else pending.filter(taken)
        if batch.isEmpty():
            return None
        # taken before the batch: a message that lands meanwhile stays beyond the cutoff
        cutoffs = control.next_cutoffs(pending, taken)
        result = apply_batch(batch, lake.table(name, registry[name]), schemas.get(name), full_refresh)
        now = datetime.now(timezone.utc)
        batch_id = f"BATCH-{name}-{now:%Y%m%d%H%M%S}"
        # what was read is bounded by the offsets seen before the batch; a cutoff never moves back
        for partition, (at, offset) in cutoffs.items():
            old = own.get(partition, {"last_processed_ts": EPOCH_START, "last_processed_offset": -1})
            own[partition] = {
                "last_processed_ts": max(at or EPOCH_START, old["last_processed_ts"]),
                "last_processed_offset": max(offset, old["last_processed_offset"]),
                "last_batch_id": batch_id,
            }
        marks[name] = own
        return {
            "batch_id": batch_id,
            "table_name": name,
            "source_topic": lake.topic(name),
            "start_cutoff": start,
            "end_cutoff": end,
            "records_read": result.read,
            "records_value_upserted": result.upserted,
            "records_history_updated": result.history_rows,
            "records_dlq": result.rejected,
            "status": "WARNING_DLQ" if result.rejected else "SUCCESS",
            "duration_seconds": round(time.time() - started, 2),
            "created_at": now,
        }

    chosen = [n for n in (registry if which.upper() == "ALL" else [which.upper()]) if n in registry]
    # tables are independent; side by side, a large one does not leave executors idle at its end
    with parse_splits(spark), ThreadPoolExecutor(max(1, min(parallel, len(chosen)))) as pool:
        done = list(pool.map(inheritable_thread_target(spark)(process), chosen))
    records = [r for r in done if r is not None]
    if records:
        at = datetime.now(timezone.utc)
        tables.write_snapshot(control.watermark_frame(spark, marks, at), lake.watermarks)
        tables.append_compacted(control.lineage_frame(spark, records), lake.lineage)
    return records


def bulk_initial_load(
    snapshots: dict[str, DataFrame],
    lake: Lake,
    registry: dict[str, list[str]],
    zone: str = "UTC",
    loaded_at: datetime | None = None,
) -> None:
    """Both Silver targets of each table from a bulk snapshot of the source."""
    loaded_at = F.lit(loaded_at or datetime.now(timezone.utc))
    for name, snapshot in snapshots.items():
        target = lake.table(name, registry[name])
        rows = stage(to_utc(snapshot, zone), f"bulk-{name.lower()}")
        tables.write_snapshot(rows.withColumn("ingested_at", loaded_at), target.value)
        tables.write_snapshot(history.baseline_history(rows, loaded_at), target.history)


def silver_tables(spark: SparkSession, lake: Lake, registry: dict[str, list[str]]) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Value and public history of every table that has been loaded."""
    loaded = {}
    for name, keys in registry.items():
        target = lake.table(name, keys)
        value = tables.read_snapshot(spark, target.value)
        rows = tables.read_snapshot(spark, target.history)
        if value is not None and rows is not None:
            loaded[name] = (value, history.public_history(rows))
    return loaded
