"""Silver straight from the Bronze stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from parcelmill.plans.medallion import SilverTable, apply_batch, parse_splits


def write_silver(
    bronze: DataFrame, table: SilverTable, checkpoint: str, schema: StructType | None = None, once: bool = True
) -> StreamingQuery:
    """Apply every micro-batch to the table's Silver targets.

    A micro-batch that is run again after a failure changes nothing, because both targets are
    idempotent; the sink therefore needs no batch bookkeeping of its own. The query keeps the settings of the session
    that it was started with, so its batches are cut into as small splits as those of a run; a small file still makes few.
    """

    def apply(batch: DataFrame, _batch_id: int) -> None:
        apply_batch(batch, table, schema=schema)

    trigger = {"availableNow": True} if once else {"processingTime": "30 seconds"}
    writer = bronze.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(**trigger)
    with parse_splits(bronze.sparkSession):
        return writer.start()
