"""Measures and semantic queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelmill.plans import domain, warehouse
from parcelmill.plans import semantic as layer
from parcelmill.registry.base import query, stored
from parcelmill.registry.gold import stored_wide
from parcelmill.registry.sql import obt, with_

PCT_MARGIN = "CAST(sum(PROFIT_AMOUNT) AS DOUBLE) / nullif(CAST(sum(TOTAL_REVENUE) AS DOUBLE), 0) * 100.0"
PCT_SUCCESS = "CAST(count(*) FILTER (STATUS_GROUP = 'COMPLETED') AS DOUBLE) / nullif(count(*), 0) * 100.0"

# member -> SQL
MEASURE_SQL = {
    "count": "count(*)",
    "totalBookings": "count(*)",
    "completedBookings": "count(*) FILTER (STATUS_GROUP = 'COMPLETED')",
    "failedBookings": "count(*) FILTER (STATUS_GROUP = 'FAILED')",
    "totalRevenue": "round(CAST(sum(TOTAL_REVENUE) AS DOUBLE), 4)",
    "totalCost": "round(CAST(sum(COST_AMOUNT) AS DOUBLE), 4)",
    "totalProfit": "round(CAST(sum(PROFIT_AMOUNT) AS DOUBLE), 4)",
    "avgOrderValue": "round(CAST(sum(TOTAL_REVENUE) AS DOUBLE) / count(TOTAL_REVENUE), 4)",
    "avgProfitPerOrder": "round(CAST(sum(PROFIT_AMOUNT) AS DOUBLE) / count(PROFIT_AMOUNT), 4)",
    "profitMarginPct": f"round({PCT_MARGIN}, 4)",
    "deliverySuccessRate": f"round({PCT_SUCCESS}, 4)",
    "totalWeightKg": "round(CAST(sum(WEIGHT_GRAM) AS DOUBLE) / 1000.0, 4)",
    "avgWeightKg": "round(CAST(sum(WEIGHT_GRAM) AS DOUBLE) / 1000.0 / count(WEIGHT_GRAM), 4)",
    "uniqueCustomers": "count(DISTINCT CUSTOMER_ID)",
}


def measures_sql(*members: str) -> str:
    return ", ".join(f'{MEASURE_SQL[m]} AS "{m}"' for m in members)


def _register_measure(key: str, member: str) -> None:
    @query(key, obt(f"SELECT {measures_sql(member)} FROM obt"))
    def _(spark, sf):
        return layer.query(stored_wide(spark, sf), layer.SHIPMENTS, [member])


for _key, _member in {
    "metric_count": "count",
    "metric_bookings": "totalBookings",
    "metric_completed": "completedBookings",
    "metric_failed": "failedBookings",
    "metric_revenue": "totalRevenue",
    "metric_cost": "totalCost",
    "metric_profit": "totalProfit",
    "metric_aov": "avgOrderValue",
    "metric_avg_profit": "avgProfitPerOrder",
    "metric_margin_pct": "profitMarginPct",
    "metric_success_rate": "deliverySuccessRate",
    "metric_weight_kg": "totalWeightKg",
    "metric_avg_weight": "avgWeightKg",
    "metric_unique_customers": "uniqueCustomers",
}.items():
    _register_measure(_key, _member)


@query(
    "metric_unique_customers_approx",
    obt(
        """SELECT SENDING_REGION AS "sendingRegion", count(DISTINCT CUSTOMER_ID) AS exact, true AS "withinError"
FROM obt WHERE BOOKING_DATE >= DATE '1996-01-01' AND BOOKING_DATE < DATE '1998-01-01' GROUP BY ALL"""
    ),
)
def _(spark, sf):
    """Customers of two years by region, from stored sketches of months and provinces, against the exact count."""
    wide = stored_wide(spark, sf)

    def write(path: str) -> None:
        layer.customer_sketches(wide, warehouse.month(), ["sendingRegion", "sendingProvince"]).write.parquet(path)

    sketches = spark.read.parquet(stored(spark, sf, "customer-sketches", write))
    about = layer.unique_customers_approx(sketches.filter("booking_month BETWEEN 199601 AND 199712"), ["sendingRegion"])
    years = wide.filter("BOOKING_DATE >= DATE'1996-01-01' AND BOOKING_DATE < DATE'1998-01-01'")
    exact = layer.query(years, layer.SHIPMENTS, ["uniqueCustomers"], ["sendingRegion"]).withColumnRenamed("sendingRegion", "region")
    off = F.abs(F.col("uniqueCustomersApprox") - F.col("uniqueCustomers"))
    within = off <= F.greatest(F.lit(1.0), 2 * layer.SKETCH_ERROR * F.col("uniqueCustomers"))
    both = about.join(exact, F.col("sendingRegion").eqNullSafe(F.col("region")))
    return both.select("sendingRegion", F.col("uniqueCustomers").alias("exact"), within.alias("withinError"))


@query("metric_shifts", with_("driver_shifts", 'SELECT count(*) AS "totalShifts" FROM driver_shifts'))
def _(spark, sf):
    return layer.query(domain.driver_shifts(spark, sf), layer.DRIVER_SHIFTS, ["totalShifts"])


@query(
    "metric_distance",
    with_("driver_shifts", 'SELECT round(CAST(sum(DISTANCE_KM) AS DOUBLE), 4) AS "totalDistanceKm" FROM driver_shifts'),
)
def _(spark, sf):
    return layer.query(domain.driver_shifts(spark, sf), layer.DRIVER_SHIFTS, ["totalDistanceKm"])


@query(
    "semantic_query",
    obt(
        f"""SELECT SENDING_REGION AS "sendingRegion", SERVICE_NAME AS "serviceName",
       {measures_sql(*MEASURE_SQL)} FROM obt GROUP BY ALL"""
    ),
)
def _(spark, sf):
    """All measures of the booking cube by two dimensions."""
    return layer.query(
        stored_wide(spark, sf), layer.SHIPMENTS, list(layer.SHIPMENTS.measures), ["sendingRegion", "serviceName"]
    )


@query(
    "semantic_query_shifts",
    with_(
        "driver_shifts",
        """SELECT CAST(SHIFT_DATE AS VARCHAR) AS "shiftDate", SENDING_PROVINCE AS "sendingProvince",
       count(*) AS "totalShifts", round(CAST(sum(DISTANCE_KM) AS DOUBLE), 4) AS "totalDistanceKm"
FROM driver_shifts GROUP BY ALL""",
    ),
)
def _(spark, sf):
    return layer.query(
        domain.driver_shifts(spark, sf),
        layer.DRIVER_SHIFTS,
        ["totalShifts", "totalDistanceKm"],
        ["shiftDate", "sendingProvince"],
    )
