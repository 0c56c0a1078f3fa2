"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job of this package relies on. Shuffle partition counts are left to the
# cluster: AQE coalesces small ones and splits skewed ones.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # an extra shuffle above a skewed join costs less than one task that holds a third of the rows
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # the JVM does not compile larger methods; a wide join chain then runs faster operator by operator
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # the dialect of the predicates users write: 1/0 and bad casts give NULL only through try_*
    "spark.sql.ansi.enabled": "true",
}

_local_scratch: dict[str, tempfile.TemporaryDirectory] = {}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def input_bytes(spark: SparkSession, path: str) -> int:
    """Bytes below ``path``, from one call to the file system."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(root).getLength()


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor sees: ``spark.checkpoint.dir``, or a local one in local mode only."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        return configured.rstrip("/")
    app = spark.sparkContext.applicationId
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.TemporaryDirectory(prefix="parcelmill-", ignore_cleanup_errors=True)
    return _local_scratch[app].name


@contextmanager
def small_splits(spark: SparkSession, size: str = "16MB", least: str | None = None) -> Iterator[None]:
    """Jobs that run inside read at most ``size`` of a table a task, so that sorting wide rows needs no disk.

    ``least`` is what a task reads at least while there are free cores; Spark's own 4 MB are much of a table that packs well.
    """
    with _settings(spark, {"spark.sql.files.maxPartitionBytes": size} | ({"spark.sql.files.openCostInBytes": least} if least else {})):
        yield


@contextmanager
def lean_disk(spark: SparkSession) -> Iterator[None]:
    """Jobs that run inside leave no shuffle files behind, and stage their tables as zstd.

    For jobs that write what they compute: a frame that is executed a second time would make its shuffles again.
    """
    with _settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd"}):
        yield


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage of ``df`` with a written table, so that several sinks can read it.

    Survives the loss of executors, keeps column pruning, and gives later joins real sizes.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(*tables: DataFrame) -> None:
    """Remove the files of tables that ``stage`` wrote, once what was made of them is written itself."""
    for table in tables:
        for file in table.inputFiles()[:1]:
            folder = table.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(file).getParent()
            if not folder.toString().startswith(_uri(table.sparkSession)):
                raise ValueError(f"{folder} is no staged table")
            folder.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _uri(spark: SparkSession) -> str:
    """The scratch folder as Spark's file listings name it."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")
    return root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(root).toString()
