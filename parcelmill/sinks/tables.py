"""Materialisations on plain files: snapshots, appends, partitioned layouts, views."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmill.functions.shape import align_to, evolve_union
from parcelmill.operators.merge import merge_delete
from parcelmill.session import drop, input_bytes, lean_disk, small_splits, stage

POINTER = "_CURRENT"
CODEC = "zstd"  # of tables; about a quarter smaller than Spark's own choice
LOG_GROUP = 1 << 20  # bytes of a row group of a change log, the least that a task parses by itself
# a table with more files than this a partition, smaller than this on average, is dealt anew when it is merged into
MOST_FILES, SMALL_FILE = 8, 16 << 20


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def snapshot_dir(spark: SparkSession, path: str) -> str | None:
    """Directory of the current snapshot below ``path``."""
    fs, pointers = _fs(spark, f"{path}/{POINTER}")
    if not fs.exists(pointers):
        return None
    # one file per switch, named by its sequence, that holds the snapshot's name; the highest one is current
    switches = [s for s in fs.listStatus(pointers) if s.getLen() and not s.getPath().getName().startswith(".")]
    return f"{path}/{_named(fs, max(switches, key=_sequence))}" if switches else None


def _sequence(status) -> int:
    return int(status.getPath().getName())


def _named(fs, status) -> str:
    stream = fs.open(status.getPath())
    try:
        return stream.readUTF()
    finally:
        stream.close()


def read_snapshot(spark: SparkSession, path: str) -> DataFrame | None:
    current = snapshot_dir(spark, path)
    return None if current is None else spark.read.parquet(current)


def write_snapshot(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace the table at ``path``, schema included, even if ``df`` reads it.

    The rows go to a fresh directory first; readers switch when its pointer file appears, so a job
    that dies half-way leaves the old snapshot in place.
    """
    switch(df.sparkSession, path, *write_aside(df, path, partition_by))


def write_aside(df: DataFrame, path: str, partition_by: list[str] | None = None) -> tuple[str, int]:
    """Write a snapshot that readers don't see yet; ``switch`` takes what is returned."""
    name, last = f"snapshot-{uuid.uuid4().hex}", last_switch(df.sparkSession, path)
    df.write.option("compression", CODEC).partitionBy(*(partition_by or [])).parquet(f"{path}/{name}")
    return name, last


def last_switch(spark: SparkSession, path: str) -> int:
    fs, pointers = _fs(spark, f"{path}/{POINTER}")
    return max([_sequence(s) for s in fs.listStatus(pointers)], default=0) if fs.exists(pointers) else 0


def switch(spark: SparkSession, path: str, name: str, last: int) -> None:
    """Make snapshot ``name`` current, if no other switch followed number ``last``."""
    fs, pointer = _fs(spark, f"{path}/{POINTER}/{last + 1:012d}")
    try:
        stream = fs.create(pointer, False)
    except Py4JJavaError as error:
        raise RuntimeError(f"another writer replaced {path}") from error
    stream.writeUTF(name)
    stream.close()


def prune_snapshots(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Remove all but the newest ``keep`` snapshots; returns how many went.

    Run it when no reader can still hold an older one.
    """
    fs, pointers = _fs(spark, f"{path}/{POINTER}")
    old = sorted(fs.listStatus(pointers), key=_sequence)[:-keep]
    for status in old:
        fs.delete(_fs(spark, f"{path}/{_named(fs, status)}")[1], True)
        fs.delete(status.getPath(), False)
    return len(old)


def append(df: DataFrame, path: str, partition_by: list[str] | None = None, group: int | None = None) -> None:
    """``group`` is the size of a row group, where it isn't Spark's own."""
    writer = df.write.mode("append").option("compression", CODEC).options(**({"parquet.block.size": group} if group else {}))
    writer.partitionBy(*(partition_by or [])).parquet(path)


def append_partitioned(df: DataFrame, path: str, partition_by: list[str], group: int | None = None) -> None:
    """Append in which few tasks write to each partition directory.

    The rebalance is by the partition columns; AQE merges small partitions and splits a crowded one.
    """
    append(df.hint("rebalance", *[F.col(c) for c in partition_by]), path, partition_by, group)


def merge_partitions(
    source: DataFrame, path: str, keys: list[str], partition: str, gone: DataFrame | None = None, dealt: bool = False
) -> None:
    """Upsert by key into a partitioned table, rewriting only the partitions it touches; ``gone`` holds keys to delete.

    The new rows are dealt by partition and written aside; ``dealt`` says that ``source`` is such a table already, which is left in place. The
    old ones are read partition by partition, so they aren't dealt, unless merges before this one have left many small files; those to be replaced
    are found by their keys alone. Touched are the partitions of the new rows and those of the rows they replace; their values come
    to the driver, at most one per directory of the table, and prune the scan. Of these only the partitions that keep a row are
    read again, which counts by partition tell, and what they keep is written aside first. A partition that loses all its rows is
    removed at the end; until then a reader sees the rows that moved out of it twice.
    """
    spark = source.sparkSession
    with lean_disk(spark), small_splits(spark):
        target = spark.read.parquet(path)
        aligned = align_to(source, target.schema)
        source = aligned if dealt else stage(aligned.hint("rebalance", F.col(partition)), "merge-source")
        named = source.select(*keys) if gone is None else source.select(*keys).union(gone.select(*keys))
        replaced = stage(target.select(*keys, partition).join(named, keys, "left_semi"), "replaced")
        lost = _counts(replaced, partition)
        touched = _values(source.select(partition)) | set(lost)
        held = _counts(target.filter(_one_of(partition, touched)), partition)
        staying = _one_of(partition, {v for v, n in held.items() if n > lost.get(v, 0)})
        rows = merge_delete(target.filter(staying), replaced.filter(staying), keys)
        if _crowded(spark, path, target):
            rows = stage(evolve_union(rows, source).hint("rebalance", F.col(partition)), "merge-rows")
            aside = [rows]
        else:
            aside = [stage(rows, "merge-rows")]
            rows = evolve_union(*aside, source)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", CODEC).partitionBy(
            partition
        ).parquet(path)
    names = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for value in touched - _values(rows.select(partition)):
        text = None if value is None else str(value)
        fs, directory = _fs(spark, f"{path}/{names.getPartitionPathString(partition, text)}")
        fs.delete(directory, True)
    drop(replaced, *aside, *([] if dealt else [source]))


def _crowded(spark: SparkSession, path: str, table: DataFrame) -> bool:
    files = table.inputFiles()
    directories = {file.rsplit("/", 1)[0] for file in files}
    return len(files) > MOST_FILES * len(directories) and input_bytes(spark, path) < SMALL_FILE * len(files)


def _values(column: DataFrame) -> set:
    return {row[0] for row in column.distinct().collect()}


def _counts(rows: DataFrame, column: str) -> dict:
    """Rows by the values of a partition column, of which there are few."""
    return {row[0]: row[1] for row in rows.groupBy(column).agg(F.count(F.lit(1))).collect()}


def _one_of(column: str, values: set) -> Column:
    """Literals, so that they reach the scan."""
    listed = F.col(column).isin([v for v in values if v is not None])
    return listed | F.col(column).isNull() if None in values else listed


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """Table whose appends may have brought new columns."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def append_compacted(df: DataFrame, path: str) -> None:
    """Append of a control table: a handful of rows in one file."""
    append(df.coalesce(1), path)


def write_clustered(df: DataFrame, path: str, partition_by: dict[str, Column], sort_by: list[str]) -> None:
    """Partitioned table whose files are sorted by ``sort_by``.

    The rows are range-partitioned on the sort columns first. Ranges follow the data, so a crowded
    partition is spread over several tasks, and each task opens few partition directories.
    """
    ranged = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
    ranged.withColumns(partition_by).write.partitionBy(*partition_by).parquet(path)


def publish_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)
