"""Silver to Gold to warehouse: jobs that read and write tables.

Gold is refreshed from what changed in each Silver table since its own bound. A bound is taken from the rows
that the run reads and is stored after all sinks have been written, so that a run that dies is simply run
again. Fact and booking table are partitioned by booking month, and a run rewrites only months that it touches.

The warehouse keeps every version. A booking that is deleted, or moves to another month, leaves a mark in the
month that it was in; so the last version can be told within a month, and a reader's month filter reaches the
partitions. A full refresh finds these, and the rows that changed, by the difference of the old and the new booking table.

Every run of Gold has a number, which its rows and marks bear and which counts once the run's bounds are stored. The
warehouse keeps a ledger of the runs that it has loaded. A load takes the runs that are not in it, and writes each to
partitions of its own, which a load that is run again replaces.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmill.operators import history
from parcelmill.operators.dedup import latest_per_key
from parcelmill.operators.merge import DELETE_OP
from parcelmill.plans import gold, warehouse
from parcelmill.plans.medallion import Lake
from parcelmill.session import drop, small_splits, stage, tune
from parcelmill.sinks import tables

MONTH = "booking_month"
RUN = "gold_run"

# Silver tables by their part in the star.
SILVER = {
    "bookings": "SHIPMENT_BOOKINGS",
    "customers": "DIM_CUSTOMERS",
    "services": "DIM_SERVICES",
    "pos": "DIM_POS_LOCATIONS",
    "statuses": "DIM_DELIVERY_STATUSES",
}
REFERENCES = gold.REFERENCES


@dataclass(frozen=True)
class Marts:
    """Where Gold and the warehouse live."""

    gold: str
    warehouse: str

    def dimension(self, part: str) -> str:
        return f"{self.gold}/dim_{part}"

    @property
    def fact(self) -> str:
        return f"{self.gold}/fact"

    @property
    def wide(self) -> str:
        return f"{self.gold}/wide"

    @property
    def left(self) -> str:
        """Rows that left their month: deleted or moved."""
        return f"{self.gold}/left"

    @property
    def bounds(self) -> str:
        return f"{self.gold}/bounds"

    @property
    def base(self) -> str:
        return f"{self.warehouse}/base"

    @property
    def rejects(self) -> str:
        return f"{self.warehouse}/rejects"

    @property
    def ledger(self) -> str:
        """Numbers of the runs of Gold that the base holds."""
        return f"{self.warehouse}/loaded"


def _since(bound: int | None) -> Column:
    return F.lit(True) if bound is None else F.col("ingested_at") > F.timestamp_micros(F.lit(bound))


def _monthly(rows: DataFrame) -> DataFrame:
    return rows.withColumn(MONTH, warehouse.month())


def _write_anew(rows: DataFrame, path: str) -> None:
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", tables.CODEC)
    writer.partitionBy(MONTH).parquet(path)


def _replace_run(rows: DataFrame, path: str, partition_by: list[str]) -> None:
    """Write rows to the partitions of their runs; what an earlier attempt left there is replaced."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", tables.CODEC)
    writer.partitionBy(*partition_by).parquet(path)


def _write_marks(marks: DataFrame, marts: Marts, run: int) -> None:
    """Add a run's marks of rows that left their month to those that an attempt before it may have written."""
    spark, marks = marks.sparkSession, marks.withColumn(RUN, F.lit(run).cast("long"))
    earlier = spark.read.parquet(marts.left).filter(F.col(RUN) == run).select(*marks.columns) if tables.exists(spark, marts.left) else None
    if earlier is None or earlier.isEmpty():
        _replace_run(marks, marts.left, [RUN])  # a booking left one month at most
        return
    marks = stage(marks.unionByName(earlier).dropDuplicates([*gold.BOOKING_KEY, MONTH]), "marks")
    _replace_run(marks, marts.left, [RUN])
    drop(marks)


def difference(old: DataFrame, new: DataFrame, run: int) -> tuple[DataFrame, DataFrame]:
    """The new table with run numbers, and the old rows that it has no more where they were.

    Both are joined in full by key and month, null-safe. A row that is as it was keeps the number of its run, so that it
    isn't loaded again; another one bears that of this run. Keys are unique in each table.
    """
    columns = [c for c in new.columns if c != RUN]
    sides = [t.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_k{i}") for i, c in enumerate([*gold.BOOKING_KEY, MONTH])], F.struct(*t.columns).alias(name)) for t, name in ((old, "was"), (new, "now"))]
    both = stage(sides[0].join(sides[1], [f"_k{i}" for i in range(len(gold.BOOKING_KEY) + 1)], "full_outer"), "difference")
    same = F.struct(*[f"was.{c}" for c in columns]).eqNullSafe(F.struct(*[f"now.{c}" for c in columns])) & F.col("was").isNotNull()
    numbered = both.filter("now IS NOT NULL").select("now.*", F.when(same, F.col(f"was.{RUN}")).otherwise(F.lit(run)).cast("long").alias(RUN))
    return numbered, both.filter("now IS NULL").select("was.*")


def deleted_keys(log: DataFrame, keys: list[str], bound: int | None) -> DataFrame:
    """Keys with a delete since the bound and no current version; the few deletes prune the versions read."""
    deletes = log.filter((F.col("op") == DELETE_OP) & _since(bound)).select(*keys).distinct()
    alive = log.filter("is_current = 1").select(*keys).join(deletes, keys, "left_semi")
    return deletes.join(alive, keys, "left_anti")


def run_gold(
    spark: SparkSession, lake: Lake, marts: Marts, registry: dict[str, list[str]], full_refresh: bool = False
) -> list[str]:
    """Refresh dimensions, fact and booking table from Silver; returns the sources that had changes.

    State comes from the histories, the last tables that a Silver batch switches. After a full refresh of
    Silver, Gold needs one too.
    """
    tune(spark)
    log = {
        part: tables.read_snapshot(spark, lake.table(name, registry[name]).history) for part, name in SILVER.items()
    }
    if missing := [SILVER[part] for part, rows in log.items() if rows is None]:
        raise ValueError(f"not in Silver yet: {', '.join(missing)}")
    stored = tables.read_snapshot(spark, marts.bounds)
    stored = [] if stored is None else stored.collect()
    run = max([row["run"] for row in stored], default=0) + 1
    bounds = {} if full_refresh else {row["source"]: row["bound"] for row in stored}
    reached = {part: rows.agg(F.unix_micros(F.max("ingested_at"))).first()[0] for part, rows in log.items()}
    changed = [part for part in SILVER if reached[part] != bounds.get(part)]
    if not changed:
        return []
    current = {part: history.current_state(rows) for part, rows in log.items()}
    projected = gold.project_dims(gold.Dims(**{part: current[part] for part in REFERENCES}))
    for part in REFERENCES:
        if part in changed:
            tables.write_snapshot(getattr(projected, part), marts.dimension(part))
    dims = gold.Dims(**{part: tables.read_snapshot(spark, marts.dimension(part)) for part in REFERENCES})

    if not bounds:
        left = None
        _write_anew(_monthly(gold.fact(current["bookings"])).hint("rebalance", F.col(MONTH)), marts.fact)
        facts = spark.read.parquet(marts.fact).drop(MONTH)
        if tables.exists(spark, marts.wide):
            rows, left = difference(spark.read.parquet(marts.wide), _monthly(gold.wide_bookings(facts, dims)), run)
            _write_marks(left, marts, run)
            rows = rows.hint("rebalance", F.col(MONTH))
        else:
            rows = gold.wide_bookings(facts, dims, lambda met: _monthly(met).hint("rebalance", F.col(MONTH)))
            rows = _monthly(rows).withColumn(RUN, F.lit(run).cast("long"))
        _write_anew(rows, marts.wide)
        if left is not None:
            drop(left)  # and with it the difference
    else:
        key = gold.BOOKING_KEY
        gone = stage(deleted_keys(log["bookings"], key, bounds["bookings"]), "gone-bookings")
        fresh = gold.fact(current["bookings"].filter(_since(bounds["bookings"])))
        tables.merge_partitions(_monthly(fresh), marts.fact, key, MONTH, gone)
        keys = {}
        for part in changed:
            touched = log[part].filter(_since(bounds[part])).select(*registry[SILVER[part]])
            keys |= {column: touched for column in REFERENCES.get(part, [])}
        facts = spark.read.parquet(marts.fact).drop(MONTH)
        # the facts of new versions bear their stamps
        touched = gold.touched_facts(facts, keys, _since(bounds["bookings"]))
        rows = gold.wide_bookings(touched, dims, lambda met: _monthly(met).hint("rebalance", F.col(MONTH)))
        rows = stage(_monthly(rows).withColumn(RUN, F.lit(run).cast("long")), "changed-bookings")
        old = spark.read.parquet(marts.wide)
        # who left is told by keys and months; only then are whole rows met
        places = rows.select(*key, F.col(MONTH).alias("_month"))
        moved = old.select(*key, MONTH).join(places, key).filter(~F.col(MONTH).eqNullSafe(F.col("_month"))).select(*key)
        leaving = stage(moved.union(gone.select(*key)), "leaving")
        _write_marks(old.join(leaving, key, "left_semi").select(*old.columns), marts, run)
        tables.merge_partitions(rows, marts.wide, key, MONTH, gone, dealt=True)
        drop(rows, gone, leaving)
    marks = spark.createDataFrame([(*item, run) for item in reached.items()], "source string, bound long, run long")
    tables.write_snapshot(marks.coalesce(1), marts.bounds)
    return changed


def load_warehouse(spark: SparkSession, marts: Marts, loaded_at: Column | None = None) -> list[int]:
    """Append the versions of the runs of Gold that the ledger lacks; returns the numbers of these runs.

    Rows without a required column go to the rejects. The ledger is written last.
    """
    tune(spark)
    done = tables.read_snapshot(spark, marts.bounds).agg(F.max("run")).first()[0]
    loaded = {row[0] for row in spark.read.parquet(marts.ledger).collect()} if tables.exists(spark, marts.ledger) else set()
    missing = [run for run in range(1, done + 1) if run not in loaded]
    if not missing:
        return []
    rows = spark.read.parquet(marts.wide).withColumn("is_deleted", F.lit(False))
    if tables.exists(spark, marts.left):
        rows = rows.unionByName(spark.read.parquet(marts.left).withColumn("is_deleted", F.lit(True)))
    rows = rows.filter(F.col(RUN).isin(missing))
    # the files of Gold hold a month each, so a task writes few of the base; nothing is shuffled, and rejects are told by the scan
    with small_splits(spark):
        _replace_run(warehouse.rejects(rows), marts.rejects, [RUN])
        good = warehouse.loadable(rows, loaded_at).sortWithinPartitions(RUN, MONTH, *warehouse.SORT)
        _replace_run(good, marts.base, [RUN, MONTH])
    tables.append_compacted(spark.createDataFrame([(run,) for run in missing], f"{RUN} long"), marts.ledger)
    return missing


def current_bookings(spark: SparkSession, marts: Marts) -> DataFrame:
    """Last version of every booking; a filter on ``booking_month`` prunes the partitions of the base."""
    base = spark.read.parquet(marts.base)
    newest = [F.col(RUN).desc(), F.col("is_deleted")]
    return latest_per_key(base, [MONTH, *gold.BOOKING_KEY], newest).filter("NOT is_deleted").drop("is_deleted")
