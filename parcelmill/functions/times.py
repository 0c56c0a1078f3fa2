"""Time columns: epoch integers, zone shifts, ISO-8601 time grains and ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, TimestampType

# Name patterns and magnitudes that mark epoch integers.
TIME_SUFFIXES = ("_AT", "_DATE", "_TIME")
TIME_PREFIX = "DATE_"
MICROS_ABOVE = 10**15
MILLIS_ABOVE = 10**12

_READERS = {"us": F.timestamp_micros, "ms": F.timestamp_millis, "s": F.timestamp_seconds}

# ISO-8601 grains -> (Spark unit, multiple).
TIME_GRAINS: dict[str, tuple[str, int]] = {
    "PT1S": ("SECOND", 1),
    "PT5S": ("SECOND", 5),
    "PT30S": ("SECOND", 30),
    "PT1M": ("MINUTE", 1),
    "PT5M": ("MINUTE", 5),
    "PT10M": ("MINUTE", 10),
    "PT15M": ("MINUTE", 15),
    "PT30M": ("MINUTE", 30),
    "PT1H": ("HOUR", 1),
    "PT6H": ("HOUR", 6),
    "P1D": ("DAY", 1),
    "P1W": ("WEEK", 1),
    "P1M": ("MONTH", 1),
    "P3M": ("QUARTER", 1),
    "P1Y": ("YEAR", 1),
}
# unit -> (enclosing unit, extractor) for multiples of a unit
_ENCLOSING = {"SECOND": ("MINUTE", F.second), "MINUTE": ("HOUR", F.minute), "HOUR": ("DAY", F.hour)}


def looks_temporal(name: str) -> bool:
    upper = name.upper()
    return upper.endswith(TIME_SUFFIXES) or upper.startswith(TIME_PREFIX)


def epoch_to_timestamp(value: Column, unit: str | None = None) -> Column:
    """Epoch integer to timestamp; the unit is guessed from the magnitude unless it is given."""
    value = value.cast("bigint")
    if unit is not None:
        return _READERS[unit](value)
    return (
        F.when(value > MICROS_ABOVE, F.timestamp_micros(value))
        .when(value > MILLIS_ABOVE, F.timestamp_millis(value))
        .otherwise(F.timestamp_seconds(value))
    )


def normalize_epochs(df: DataFrame, units: dict[str, str] | None = None) -> DataFrame:
    """Turn integer columns with a temporal name into timestamps, in one projection."""
    units = units or {}
    integers = (LongType, IntegerType)
    return df.select(
        *[
            epoch_to_timestamp(F.col(f"`{f.name}`"), units.get(f.name)).alias(f.name)
            if isinstance(f.dataType, integers) and looks_temporal(f.name)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def to_utc(df: DataFrame, zone: str) -> DataFrame:
    """Read every timestamp column as wall-clock time of ``zone`` and shift it to UTC."""
    return df.select(
        *[
            F.to_utc_timestamp(F.col(f"`{f.name}`"), zone).alias(f.name)
            if isinstance(f.dataType, TimestampType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def time_bucket(ts: Column, grain: str) -> Column:
    """Start of the ISO-8601 grain that holds ``ts``."""
    if grain not in TIME_GRAINS:
        raise ValueError(f"unknown time grain {grain!r}")
    unit, multiple = TIME_GRAINS[grain]
    if multiple == 1:
        return F.date_trunc(unit, ts)
    outer, part = _ENCLOSING[unit]
    steps = F.floor(part(ts) / multiple).cast("int") * multiple
    return F.timestamp_add(unit, steps, F.date_trunc(outer, ts))


def between(ts: Column, start: Column | str | None, end: Column | str | None) -> Column:
    """Half-open range ``[start, end)``; an open side is left out."""
    parts = []
    if start is not None:
        parts.append(ts >= (F.lit(start) if isinstance(start, str) else start))
    if end is not None:
        parts.append(ts < (F.lit(end) if isinstance(end, str) else end))
    if not parts:
        return F.lit(True)
    return parts[0] if len(parts) == 1 else parts[0] & parts[1]
