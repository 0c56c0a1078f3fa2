"""Small helpers for Arrow functions that Spark runs on partitions and groups."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Rows and bytes that are handed to Python at once; texts are long, and a task holds a few such batches.
ARROW_ROWS = "1000"
ARROW_BYTES = "4m"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package's code to the Python workers, wherever they run, once a session; keep batches of texts small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="code-")) / f"{package.name}_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` of a table of documents, whatever else it holds."""
    ship(docs.sparkSession)
    return docs.select("doc_id", "text")


def unused(name: str, columns: list[str]) -> str:
    """A name like this one that none of the columns has, in whatever case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def release() -> None:
    """Return freed memory to the system: a worker waits for its next task beside the heap of its executor."""
    pa.default_memory_pool().release_unused()
    if (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)) is not None:
        trim(0)


def per_batch(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | StructType) -> DataFrame:
    """``fn`` on each Arrow batch; the worker then hands back what memory it no longer needs."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if (out := fn(batch)) is not None:
                yield out
        release()

    return df.mapInArrow(each, schema)


def total_bytes(docs: DataFrame) -> int:
    """Bytes of all texts, from one aggregate."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def shares(amount: int, each: int) -> int:
    """How many shares of at most ``each`` an amount needs."""
    return max(1, -(-amount // each))
