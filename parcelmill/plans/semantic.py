"""Semantic layer: named measures and dimensions over the booking table and the driver shifts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ratio_pct(part: Column, whole: Column) -> Column:
    """Percentage; NULL when the whole is zero."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)) * 100.0


def _rows() -> Column:
    return F.count(F.lit(1))


def _group_rows(group: str) -> Column:
    return F.count_if(F.col("STATUS_GROUP") == group)


def _kg() -> Column:
    """Grams are summed as integers; only the total is divided."""
    return F.sum("WEIGHT_GRAM").cast("double") / F.lit(1000.0)


@dataclass(frozen=True)
class Cube:
    name: str
    measures: dict[str, Callable[[], Column]]
    dimensions: dict[str, str]
    time: str
    province: str


SHIPMENTS = Cube(
    name="Shipments",
    measures={
        "count": _rows,
        "totalBookings": _rows,
        "completedBookings": lambda: _group_rows("COMPLETED"),
        "failedBookings": lambda: _group_rows("FAILED"),
        "totalRevenue": lambda: F.sum("TOTAL_REVENUE"),
        "totalCost": lambda: F.sum("COST_AMOUNT"),
        "totalProfit": lambda: F.sum("PROFIT_AMOUNT"),
        "avgOrderValue": lambda: F.avg("TOTAL_REVENUE"),
        "avgProfitPerOrder": lambda: F.avg("PROFIT_AMOUNT"),
        "profitMarginPct": lambda: _ratio_pct(F.sum("PROFIT_AMOUNT"), F.sum("TOTAL_REVENUE")),
        "deliverySuccessRate": lambda: _ratio_pct(_group_rows("COMPLETED"), _rows()),
        "totalWeightKg": _kg,
        "avgWeightKg": lambda: _kg() / F.nullif(F.count("WEIGHT_GRAM"), F.lit(0)),
        "uniqueCustomers": lambda: F.count_distinct("CUSTOMER_ID"),
    },
    dimensions={
        "bookingId": "BOOKING_ID",
        "bookingDate": "BOOKING_DATE",
        "sendingProvince": "SENDING_PROVINCE",
        "sendingRegion": "SENDING_REGION",
        "receivingProvince": "RECEIVING_PROVINCE",
        "receivingRegion": "RECEIVING_REGION",
        "statusName": "STATUS_NAME",
        "statusGroup": "STATUS_GROUP",
        "serviceName": "SERVICE_NAME",
        "customerName": "CUSTOMER_NAME",
        "customerType": "CUSTOMER_TYPE",
    },
    time="bookingDate",
    province="sendingProvince",
)

DRIVER_SHIFTS = Cube(
    name="DriverShifts",
    measures={"totalShifts": _rows, "totalDistanceKm": lambda: F.sum("DISTANCE_KM")},
    dimensions={
        "shiftId": "SHIFT_ID",
        "shiftDate": "SHIFT_DATE",
        "driverName": "DRIVER_NAME",
        "sendingProvince": "SENDING_PROVINCE",
    },
    time="shiftDate",
    province="sendingProvince",
)

CUBES = {c.name: c for c in (SHIPMENTS, DRIVER_SHIFTS)}


def cube_of(members: list[str]) -> Cube:
    """The one cube that ``Cube.member`` names belong to."""
    names = {m.split(".", 1)[0] for m in members}
    unknown = names - set(CUBES)
    if unknown:
        raise ValueError(f"unknown cube {sorted(unknown)}")
    if len(names) != 1:
        raise ValueError("members of one query must belong to one cube; the cubes have no join path")
    return CUBES[names.pop()]


def dimension(cube: Cube, name: str) -> Column:
    if name not in cube.dimensions:
        raise ValueError(f"dimension {name!r} does not exist")
    return F.col(cube.dimensions[name])


def measure(cube: Cube, name: str) -> Column:
    if name not in cube.measures:
        raise ValueError(f"metric {name!r} does not exist")
    return cube.measures[name]()


def query(base: DataFrame, cube: Cube, measures: list[str], dimensions: list[str] | None = None) -> DataFrame:
    """Group ``base`` by the dimensions and compute the measures, all under their member names."""
    dims = [dimension(cube, d).alias(d) for d in dict.fromkeys(dimensions or [])]
    values = [measure(cube, m).alias(m) for m in dict.fromkeys(measures)]
    if not values:
        return base.select(*dims).distinct()
    return base.groupBy(*dims).agg(*values)


# 2^14 buckets: a standard error of about 0.8 %; a reader may count on three of them
SKETCH_BITS = 14
SKETCH_ERROR = 0.025


def customer_sketches(base: DataFrame, month: Column, dimensions: list[str]) -> DataFrame:
    """HyperLogLog sketches of the customers by month and dimensions: a small table to store beside the bookings.

    A sketch has at most 2^14 bytes and a bit, whatever it counts, and a new month only adds rows.
    """
    dims = [dimension(SHIPMENTS, d).alias(d) for d in dimensions]
    return base.groupBy(month.alias("booking_month"), *dims).agg(F.hll_sketch_agg("CUSTOMER_ID", SKETCH_BITS).alias("customers"))


def unique_customers_approx(sketches: DataFrame, dimensions: list[str] | None = None) -> DataFrame:
    """About how many different customers there are, by some of the sketches' dimensions.

    Sketches of several months or groups are merged first, so that nobody counts twice. The estimate is off by more than
    ``SKETCH_ERROR`` in about one case of three hundred; ``uniqueCustomers`` is the exact measure.
    """
    merged = sketches.groupBy(*(dimensions or [])).agg(F.hll_union_agg("customers").alias("customers"))
    return merged.select(*(dimensions or []), F.hll_sketch_estimate("customers").alias("uniqueCustomersApprox"))


def dataset(base: DataFrame, cube: Cube) -> DataFrame:
    """Columns under their member names, for the dataset query operator; measures stay available
    because the physical columns are kept."""
    extra = {member: F.col(column) for member, column in cube.dimensions.items()}
    return base.withColumns(extra)
