"""Parse change payloads and split off the rows that cannot be used."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    AtomicType,
    DataType,
    DecimalType,
    DoubleType,
    NullType,
    StringType,
    StructField,
    StructType,
    VariantType,
)

from parcelmill.functions import cdc
from parcelmill.functions.shape import unfit
from parcelmill.functions.times import normalize_epochs
from parcelmill.schemas import DLQ, column_names
from parcelmill.session import stage

EMPTY = "EMPTY_OR_UNPARSABLE_PAYLOAD"
NO_KEY = "MISSING_OR_NULL_PRIMARY_KEY"
UNKNOWN_OP = "UNKNOWN_OP"
NO_TIME = "MISSING_EVENT_TIME"
TYPE_CONFLICT = "TYPE_CONFLICT"
KNOWN_OPS = ["r", "c", "u", "d"]

MESSAGE_KEY = ["kafka_topic", "kafka_partition", "kafka_offset"]


class Payloads(NamedTuple):
    valid: DataFrame
    rejects: DataFrame


def with_image(bronze: DataFrame) -> DataFrame:
    """Add the JSON text of the row."""
    return _with_row(bronze, "image", StringType())


def _with_row(bronze: DataFrame, name: str, image: DataType) -> DataFrame:
    """Parse the message as a column of its own first: one parse, however often its parts are used."""
    parsed = bronze.withColumn("_message", cdc.envelope(F.col("raw_value"), image))
    return parsed.withColumn(name, cdc.row_image(F.col("_message"))).drop("_message")


def _readable(dtype: DataType) -> DataType:
    """Types that ``from_json`` should use for what was seen in the data."""
    if isinstance(dtype, StructType):
        return StructType([StructField(f.name, _readable(f.dataType)) for f in dtype.fields])
    if isinstance(dtype, ArrayType):
        return ArrayType(_readable(dtype.elementType))
    if isinstance(dtype, DecimalType):
        # an integral decimal is an integer too wide for a long: keep its digits
        return dtype if dtype.scale == 0 else DoubleType()
    if isinstance(dtype, (VariantType, NullType)):
        return StringType()
    return dtype


def infer_schema(images: DataFrame, column: str = "image") -> StructType:
    """Schema merged over all rows, on the executors; unparsable rows are ignored.

    Only the merged DDL text comes back to the driver. Pass a declared schema to ``parse`` to skip
    this second look at the text.
    """
    rows = F.when(F.col(column).startswith("{"), F.try_parse_json(column))
    seen = images.agg(F.schema_of_variant_agg(rows).alias("s")).first()["s"]
    if seen is None or not seen.startswith("OBJECT<"):
        return StructType()
    ddl = seen.replace("OBJECT<", "STRUCT<")
    return _readable(DataType.fromDDL(ddl))


def parse(bronze: DataFrame, schema: StructType) -> DataFrame:
    """Add the row as a struct; NULL when the message has none. Envelope and row are read in one pass."""
    if not len(schema):
        return bronze.withColumn("row", F.lit(None))
    return _with_row(bronze, "row", schema)


def key_present(keys: list[str], schema: StructType) -> Column:
    """True when every key column exists in the schema and is not NULL."""
    if any(k not in schema.names for k in keys):
        return F.lit(False)
    return reduce(lambda a, b: a & b, [F.col(f"row.`{k}`").isNotNull() for k in keys])


def reject_reason(keys: list[str], schema: StructType, target: StructType | None = None) -> Column:
    """NULL for usable rows. A row with a value that the target's column can't hold is not usable."""
    misfit = F.col("_misfit") if target is None else F.col("_misfit") | unfit(schema, target)
    return (
        F.when(F.col("row").isNull(), F.lit(EMPTY))
        .when(~key_present(keys, schema), F.lit(NO_KEY))
        .when(F.coalesce(~F.col("op").isin(KNOWN_OPS), F.lit(True)), F.lit(UNKNOWN_OP))
        .when(F.col("event_time").isNull(), F.lit(NO_TIME))
        .when(misfit, F.lit(TYPE_CONFLICT))
    )


def classify(
    bronze: DataFrame, keys: list[str], schema: StructType | None = None, target: StructType | None = None
) -> tuple[DataFrame, StructType]:
    """One pass over the slice: parsed row and reject reason of each message.

    With a declared schema a field whose value doesn't fit is read as NULL; such a message is rejected, as is
    one whose values don't fit the stored ``target``. The text of usable messages is dropped here, so that a
    written copy holds the row only once.
    """
    declared = schema is not None
    schema = schema if declared else infer_schema(with_image(bronze))
    parsed = parse(bronze, schema)
    if declared and len(schema):
        # only a row with a NULL is looked at again
        given = cdc.row_image(cdc.envelope(F.col("raw_value"), StringType()))
        names = [n for n in schema.names if isinstance(schema[n].dataType, AtomicType)]
        lost = [F.col(f"row.`{n}`").isNull() & F.get_json_object(given, f"$['{n}']").isNotNull() for n in names]
        misfit = F.col("row").isNotNull() & reduce(lambda a, b: a | b, lost, F.lit(False))
    else:
        misfit = F.lit(False)
    parsed = parsed.withColumn("_misfit", misfit)
    classified = parsed.withColumn("error_reason", reject_reason(keys, schema, target)).drop("_misfit")
    rejected = F.col("error_reason").isNotNull()
    return classified.withColumn("raw_value", F.when(rejected, F.col("raw_value"))), schema


def valid_rows(classified: DataFrame, schema: StructType, units: dict[str, str] | None = None) -> DataFrame:
    flat = classified.filter("error_reason IS NULL").select(
        "op",
        "ts_ms",
        "kafka_partition",
        "kafka_offset",
        "kafka_timestamp",
        F.col("event_time").alias("cdc_event_time"),
        *[F.col(f"row.`{n}`").alias(n) for n in schema.names],
    )
    return normalize_epochs(flat, units)


def dead_letters(classified: DataFrame, quarantined_at: Column | None = None) -> DataFrame:
    stamp = F.current_timestamp() if quarantined_at is None else quarantined_at
    return (
        classified.filter("error_reason IS NOT NULL")
        .withColumn("quarantined_at", stamp)
        .select(*column_names(DLQ))
    )


def split(
    bronze: DataFrame,
    keys: list[str],
    schema: StructType | None = None,
    units: dict[str, str] | None = None,
) -> Payloads:
    """Valid rows (flattened, epochs normalised) and dead letters, both from one written parse.

    A filter on parsed columns would otherwise be pushed below the parse and repeat it.
    """
    classified, schema = classify(bronze, keys, schema)
    parsed = stage(classified, "parsed")
    return Payloads(valid_rows(parsed, schema, units), dead_letters(parsed))


def new_dead_letters(rejects: DataFrame, quarantined: DataFrame) -> DataFrame:
    """Rejects not yet in quarantine, so that a replayed slice adds nothing."""
    return distinct_messages(rejects).join(quarantined.select(*MESSAGE_KEY), MESSAGE_KEY, "left_anti")


def distinct_messages(messages: DataFrame) -> DataFrame:
    """One row per message. Rejects need it; valid rows are reduced per key anyway, so a slice is
    never shuffled by message."""
    return messages.dropDuplicates(MESSAGE_KEY)
