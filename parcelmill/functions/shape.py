"""Schema alignment and evolution."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    AtomicType,
    DataType,
    DateType,
    DecimalType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from parcelmill.functions.times import epoch_to_timestamp


def align_to(df: DataFrame, target: StructType) -> DataFrame:
    """Cast the columns ``df`` shares with ``target`` to the target's types; leave the others alone.

    Values that do not fit become NULL, and what a type can't hold of them is cut; ``unfit`` tells both before.
    Integers that meet a timestamp are read as epochs.
    """
    wanted = {f.name: f.dataType for f in target.fields}

    def shaped(field):
        column = F.col(f"`{field.name}`")
        goal = wanted.get(field.name)
        if goal is None or goal == field.dataType:
            return column
        if isinstance(goal, TimestampType) and isinstance(field.dataType, (LongType, IntegerType)):
            return epoch_to_timestamp(column).alias(field.name)
        return column.try_cast(goal).alias(field.name)

    return df.select(*[shaped(f) for f in df.schema.fields])


def unfit(row: StructType, target: StructType, prefix: str = "row") -> Column:
    """True where a value of a parsed row would be lost, or changed, by ``align_to``.

    A number, date or time is held by its target's type if it is the same when it is cast back. Text must be read
    without a digit cut off. Two roundings are allowed: any value as text, and a double as a float.
    """
    wanted = {f.name: f.dataType for f in target.fields}
    lost = F.lit(False)
    for field in row.fields:
        goal, column = wanted.get(field.name), F.col(f"{prefix}.`{field.name}`")
        epoch = isinstance(goal, TimestampType) and isinstance(field.dataType, (LongType, IntegerType))
        if goal is not None and goal != field.dataType and not epoch:
            lost = lost | (column.isNotNull() & ~F.coalesce(_held(column, field.dataType, goal), F.lit(False)))
    return lost


def _held(column: Column, have: DataType, goal: DataType) -> Column:
    there = column.try_cast(goal)
    if isinstance(goal, (StringType, FloatType)) or not isinstance(have, AtomicType):
        return there.isNotNull()
    if isinstance(have, StringType):
        # the same text, read with every digit
        whole = {DecimalType: DecimalType(38, 18), DateType: TimestampNTZType()}.get(type(goal))
        return there.isNotNull() if whole is None else there.try_cast(whole) == column.try_cast(whole)
    return there.try_cast(have) == column


def evolve_union(*frames: DataFrame) -> DataFrame:
    """Union by name; a column missing from one side is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
