"""The dashboard's queries: metrics x dimensions over the booking table.

Charts leave their sort order to the viewer; every list here states a full order, so that a limit
keeps the same rows everywhere.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelmill.functions.times import between, time_bucket
from parcelmill.plans import semantic
from parcelmill.plans.semantic import SHIPMENTS

LANE = ["sendingProvince", "receivingProvince", "serviceName", "customerType"]
LANE_METRICS = [
    "totalBookings", "completedBookings", "failedBookings", "totalRevenue", "totalProfit", "profitMarginPct",
    "deliverySuccessRate",
]
PAGE_LENGTH = 10


@dataclass(frozen=True)
class Chart:
    metrics: list[str]
    groupby: list[str] = field(default_factory=list)
    order: list[tuple[str, bool]] = field(default_factory=list)
    limit: int | None = None


CHARTS: dict[str, Chart] = {
    "kpi_bookings": Chart(["totalBookings"]),
    "kpi_revenue": Chart(["totalRevenue"]),
    "kpi_profit": Chart(["totalProfit"]),
    "kpi_margin": Chart(["profitMarginPct"]),
    "kpi_success": Chart(["deliverySuccessRate"]),
    "kpi_aov": Chart(["avgOrderValue"]),
    "kpi_weight": Chart(["totalWeightKg"]),
    "kpi_customers": Chart(["uniqueCustomers"]),
    "region_revenue": Chart(["totalRevenue"], ["sendingRegion"]),
    "province_finance": Chart(
        ["totalRevenue", "totalProfit"], ["sendingProvince"], [("totalRevenue", False), ("sendingProvince", True)], 20
    ),
    "quality_region": Chart(["completedBookings", "failedBookings"], ["sendingRegion"]),
    "service_perf": Chart(["totalBookings", "completedBookings"], ["serviceName"]),
    "status_dist": Chart(["totalBookings"], ["statusGroup"]),
    "bookings_province": Chart(
        ["totalBookings"], ["sendingProvince"], [("totalBookings", False), ("sendingProvince", True)]
    ),
    "status_name": Chart(["totalBookings"], ["statusName"]),
}


def _sorted(df: DataFrame, order: list[tuple[str, bool]]) -> DataFrame:
    return df.orderBy(*[F.col(c).asc() if asc else F.col(c).desc() for c, asc in order]) if order else df


def chart(base: DataFrame, name: str, filters: dict[str, list] | None = None) -> DataFrame:
    """A chart under the dashboard's filters, which apply below the aggregate."""
    spec = CHARTS[name]
    result = _sorted(semantic.query(filtered(base, filters), SHIPMENTS, spec.metrics, spec.groupby), spec.order)
    return result.limit(spec.limit) if spec.limit else result


def filtered(base: DataFrame, filters: dict[str, list] | None) -> DataFrame:
    """Conjunction of multi-select filters by member name; a clicked mark is a list of one."""
    for member, values in (filters or {}).items():
        base = base.filter(semantic.dimension(SHIPMENTS, member).isin(values))
    return base


def all_tiles(base: DataFrame, names: list[str] | None = None, filters: dict[str, list] | None = None) -> DataFrame:
    """``tile, dimension, member, metric, value`` of several charts of at most one dimension each, from one scan.

    One aggregate over grouping sets, one set for each dimension and one for the totals, computes all metrics; each tile
    then takes its own set, metrics, order and limit. Limits are kept by rank, with the full order that they state.
    """
    specs = {n: CHARTS[n] for n in (names or CHARTS)}
    if wide := [n for n, spec in specs.items() if len(spec.groupby) > 1]:
        raise ValueError(f"of more than one dimension: {', '.join(wide)}")
    dims = list(dict.fromkeys(d for spec in specs.values() for d in spec.groupby))
    metrics = list(dict.fromkeys(m for spec in specs.values() for m in spec.metrics))
    rows = filtered(base, filters).withColumns({d: semantic.dimension(SHIPMENTS, d) for d in dims})
    sets = [[F.col(d)] for d in dims] + [[]]
    values = [semantic.measure(SHIPMENTS, m).cast("double").alias(m) for m in metrics]
    cube = rows.groupingSets(sets, *[F.col(d) for d in dims]).agg(*values, F.grouping_id().alias("_set"))
    # a dimension's bit is 0 in its own set
    set_of = {d: (1 << len(dims)) - 1 - (1 << (len(dims) - 1 - i)) for i, d in enumerate(dims)} | {None: (1 << len(dims)) - 1}
    member = F.coalesce(*[F.col(d).cast("string") for d in dims]) if dims else F.lit(None).cast("string")

    def entries(name: str, spec: Chart) -> list[Column]:
        mine = F.col("_set") == set_of[spec.groupby[0] if spec.groupby else None]
        return [F.when(mine, F.struct(F.lit(name).alias("tile"), F.lit(m).alias("metric"), F.col(m).alias("value"))) for m in spec.metrics]

    ranks = {}
    for name, spec in specs.items():
        if spec.limit:
            order = [F.col(c).asc() if asc else F.col(c).desc() for c, asc in spec.order]
            ranks[name] = (F.row_number().over(Window.partitionBy("_set").orderBy(*order)), spec.limit)
    ranked = cube.withColumns({f"_rank_{n}": rank for n, (rank, _) in ranks.items()})
    tiles = F.array_compact(F.array(*[e for n, spec in specs.items() for e in entries(n, spec)]))
    long = ranked.select("*", member.alias("member"), F.explode(tiles).alias("t"))
    dimension = F.lit(None).cast("string")
    for d, number in set_of.items():
        dimension = F.when(F.col("_set") == number, F.lit(d)).otherwise(dimension)
    for n, (_, limit) in ranks.items():
        long = long.filter((F.col("t.tile") != n) | (F.col(f"_rank_{n}") <= limit))
    return long.select(F.col("t.tile").alias("tile"), dimension.alias("dimension"), "member", F.col("t.metric").alias("metric"), F.col("t.value").alias("value"))


def daily_trend(base: DataFrame, start: str, end: str, limit: int | None = None) -> DataFrame:
    """A row per day; a chart may ask for the first ``limit`` days."""
    day = F.col(SHIPMENTS.dimensions[SHIPMENTS.time])
    rows = base.filter(between(day, F.lit(start).cast("date"), F.lit(end).cast("date")))
    measures = [semantic.measure(SHIPMENTS, m).alias(m) for m in ("totalBookings", "totalRevenue")]
    days = rows.groupBy(time_bucket(day, "P1D").cast("date").alias("bookingDate")).agg(*measures)
    days = days.orderBy("bookingDate")
    return days if limit is None else days.limit(limit)


def lane_drilldown(base: DataFrame, page: int = 0, page_length: int = PAGE_LENGTH) -> DataFrame:
    """One page of the lane table, largest lanes first."""
    lanes = semantic.query(base, SHIPMENTS, LANE_METRICS, LANE)
    return lanes.orderBy(F.col("totalBookings").desc(), *LANE).offset(page * page_length).limit(page_length)
