"""Dashboard queries."""

from __future__ import annotations

from parcelmill.plans import dashboards
from parcelmill.plans.semantic import SHIPMENTS
from parcelmill.registry.base import query
from parcelmill.registry.gold import stored_wide
from parcelmill.registry.semantic import measures_sql
from parcelmill.registry.sql import obt


def _chart_sql(name: str, where: str = "") -> str:
    spec = dashboards.CHARTS[name]
    dims = "".join(f'{SHIPMENTS.dimensions[d]} AS "{d}", ' for d in spec.groupby)
    sql = f"SELECT {dims}{measures_sql(*spec.metrics)} FROM obt {where}"
    if spec.groupby:
        sql += f" GROUP BY {', '.join(SHIPMENTS.dimensions[d] for d in spec.groupby)}"
    if spec.order:
        sql += " ORDER BY " + ", ".join(f'"{c}" {"ASC" if asc else "DESC"}' for c, asc in spec.order)
    if spec.limit:
        sql += f" LIMIT {spec.limit}"
    return obt(sql)


def _register_chart(name: str) -> None:
    @query(f"dash_{name}", _chart_sql(name))
    def _(spark, sf):
        return dashboards.chart(stored_wide(spark, sf), name)


for _name in dashboards.CHARTS:
    _register_chart(_name)


def _tiles_sql() -> str:
    """Each chart as its own query, one under the other."""
    parts = []
    for name, spec in dashboards.CHARTS.items():
        column = SHIPMENTS.dimensions[spec.groupby[0]] if spec.groupby else None
        member = f"CAST({column} AS VARCHAR)" if column else "CAST(NULL AS VARCHAR)"
        label = f"'{spec.groupby[0]}'" if column else "CAST(NULL AS VARCHAR)"
        one = f"SELECT {member} AS member, {measures_sql(*spec.metrics)} FROM obt" + (f" GROUP BY {column}" if column else "")
        if spec.limit:
            order = ", ".join(f'"{c}" {"ASC" if asc else "DESC"}' for c, asc in spec.order).replace('"sendingProvince"', "member")
            one += f" ORDER BY {order} LIMIT {spec.limit}"
        parts += [
            f"""SELECT '{name}' AS tile, {label} AS dimension, member, '{m}' AS metric, CAST("{m}" AS DOUBLE) AS value FROM ({one}) t"""
            for m in spec.metrics
        ]
    return obt(" UNION ALL ".join(parts))


@query("dash_all_tiles", _tiles_sql())
def _(spark, sf):
    """Every chart of one dimension or none, from one scan of the booking table."""
    return dashboards.all_tiles(stored_wide(spark, sf))


@query(
    "dash_trend_daily",
    obt(
        f"""SELECT CAST(BOOKING_DATE AS VARCHAR) AS "bookingDate", {measures_sql("totalBookings", "totalRevenue")}
FROM obt WHERE BOOKING_DATE >= DATE '1997-01-01' AND BOOKING_DATE < DATE '1998-01-01'
GROUP BY BOOKING_DATE ORDER BY BOOKING_DATE LIMIT 500"""
    ),
)
def _(spark, sf):
    return dashboards.daily_trend(stored_wide(spark, sf), "1997-01-01", "1998-01-01", limit=500)


def _lane_sql(offset: int) -> str:
    dims = ", ".join(f'{SHIPMENTS.dimensions[d]} AS "{d}"' for d in dashboards.LANE)
    return obt(
        f"""SELECT {dims}, {measures_sql(*dashboards.LANE_METRICS)} FROM obt GROUP BY {
            ", ".join(SHIPMENTS.dimensions[d] for d in dashboards.LANE)
        } ORDER BY "totalBookings" DESC, {", ".join(f'"{d}"' for d in dashboards.LANE)} LIMIT 10 OFFSET {offset}"""
    )


@query("dash_lane_drilldown", _lane_sql(0))
def _(spark, sf):
    return dashboards.lane_drilldown(stored_wide(spark, sf))


@query("dash_lane_drilldown_page3", _lane_sql(20))
def _(spark, sf):
    return dashboards.lane_drilldown(stored_wide(spark, sf), page=2)


@query(
    "dash_native_filters",
    _chart_sql(
        "province_finance",
        """WHERE SERVICE_NAME IN ('SVC ECONOMY', 'SVC PROMO') AND SENDING_REGION IN ('ASIA', 'EUROPE')
  AND STATUS_GROUP IN ('COMPLETED', 'PENDING')""",
    ),
)
def _(spark, sf):
    filters = {
        "serviceName": ["SVC ECONOMY", "SVC PROMO"],
        "sendingRegion": ["ASIA", "EUROPE"],
        "statusGroup": ["COMPLETED", "PENDING"],
    }
    return dashboards.chart(stored_wide(spark, sf), "province_finance", filters)


@query("dash_cross_filter", _chart_sql("service_perf", "WHERE SENDING_PROVINCE = 'NATION_7'"))
def _(spark, sf):
    """A click on one province filters the service chart."""
    return dashboards.chart(stored_wide(spark, sf), "service_perf", {"sendingProvince": ["NATION_7"]})
