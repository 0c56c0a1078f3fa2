"""Row-level security queries. Users come from the regions and suppliers of the input."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelmill.operators import security
from parcelmill.operators.security import Clause, ClauseRules
from parcelmill.plans import domain, semantic
from parcelmill.registry.base import query, stored
from parcelmill.registry.gold import stored_wide
from parcelmill.registry.semantic import measures_sql
from parcelmill.registry.sql import obt, with_


def permissions(spark, sf):
    """The permission matrix as a written table."""

    def write(path: str) -> None:
        domain.permissions(spark, sf).write.parquet(path)

    return spark.read.parquet(stored(spark, sf, "permissions", write))


def _as_user(spark, sf, username, measures, dimensions=None, **clauses):
    bases = {"Shipments": stored_wide(spark, sf), "DriverShifts": domain.driver_shifts(spark, sf)}
    return security.secured_query(bases, permissions(spark, sf), username, measures, dimensions, **clauses)


LOOKED_UP = ["manager_asia", "admin_asia", "idle_asia", "nobody"]


@query(
    "rls_lookup",
    with_(
        "permissions",
        f"""SELECT u AS username, coalesce(role, 'GUEST') AS role,
       coalesce(array_to_string(list_sort(province_access), ','), '') AS province_access
FROM (SELECT unnest({LOOKED_UP}) AS u) LEFT JOIN permissions ON username = u""",
    ),
)
def _(spark, sf):
    """What single users are given, an unknown one too."""
    found = [security.lookup(permissions(spark, sf), u) for u in LOOKED_UP]
    rows = [(a.username, a.role, ",".join(sorted(a.provinces))) for a in found]
    return spark.createDataFrame(rows, "username string, role string, province_access string")


@query(
    "rls_chart",
    obt(
        f"""SELECT SENDING_PROVINCE AS "sendingProvince", {measures_sql("totalBookings", "totalRevenue")} FROM obt
WHERE SENDING_PROVINCE IN (SELECT n_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA')
  AND STATUS_GROUP IN ('COMPLETED', 'FAILED')
  AND BOOKING_DATE >= DATE '1997-01-01' AND BOOKING_DATE < DATE '1998-01-01'
GROUP BY ALL ORDER BY "totalRevenue" DESC LIMIT 3"""
    ),
)
def _(spark, sf):
    """A chart with filters, time range, order and limit, as a regional manager."""
    return _as_user(
        spark,
        sf,
        "manager_asia",
        ["Shipments.totalBookings", "Shipments.totalRevenue"],
        ["Shipments.sendingProvince"],
        filters={"Shipments.statusGroup": ["COMPLETED", "FAILED"]},
        time_range=("1997-01-01", "1998-01-01"),
        order=[("Shipments.totalRevenue", False)],
        limit=3,
    )


@query(
    "rls_admin",
    obt(f'SELECT SENDING_PROVINCE AS "sendingProvince", {measures_sql("totalBookings")} FROM obt GROUP BY ALL'),
)
def _(spark, sf):
    return _as_user(spark, sf, "admin_asia", ["Shipments.totalBookings"], ["Shipments.sendingProvince"])


@query(
    "rls_regional",
    obt(
        f"""SELECT SENDING_PROVINCE AS "sendingProvince", {measures_sql("totalBookings", "totalRevenue")} FROM obt
WHERE SENDING_PROVINCE IN (SELECT n_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA')
GROUP BY ALL"""
    ),
)
def _(spark, sf):
    return _as_user(
        spark,
        sf,
        "manager_asia",
        ["Shipments.totalBookings", "Shipments.totalRevenue"],
        ["Shipments.sendingProvince"],
    )


@query(
    "rls_regional_shifts",
    with_(
        "driver_shifts",
        """SELECT SENDING_PROVINCE AS "sendingProvince", count(*) AS "totalShifts" FROM driver_shifts
WHERE SENDING_PROVINCE IN (SELECT n_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA')
GROUP BY ALL""",
    ),
)
def _(spark, sf):
    return _as_user(spark, sf, "manager_asia", ["DriverShifts.totalShifts"], ["DriverShifts.sendingProvince"])


@query(
    "rls_regional_by_table",
    obt(
        """SELECT SENDING_PROVINCE, count(*) AS n FROM obt
WHERE SENDING_PROVINCE IN (SELECT n_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE')
GROUP BY SENDING_PROVINCE"""
    ),
)
def _(spark, sf):
    """The same rule as a semi join with the permission table."""
    rows = security.secure_by_table(
        stored_wide(spark, sf), permissions(spark, sf), "manager_europe", semantic.SHIPMENTS
    )
    return rows.groupBy("SENDING_PROVINCE").agg(F.count(F.lit(1)).alias("n"))


@query(
    "rls_empty_list",
    obt('SELECT SENDING_PROVINCE AS "sendingProvince", count(*) AS "totalBookings" FROM obt WHERE false GROUP BY ALL'),
)
def _(spark, sf):
    """A manager without provinces sees nothing."""
    return _as_user(spark, sf, "idle_asia", ["Shipments.totalBookings"], ["Shipments.sendingProvince"])


@query(
    "rls_driver",
    with_(
        "driver_shifts",
        """SELECT DRIVER_NAME AS "driverName", count(*) AS "totalShifts",
       round(CAST(sum(DISTANCE_KM) AS DOUBLE), 4) AS "totalDistanceKm" FROM driver_shifts
WHERE SENDING_PROVINCE = (SELECT n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey = 1)
GROUP BY DRIVER_NAME""",
    ),
)
def _(spark, sf):
    """A driver sees the shifts of the own province and is refused the booking cube."""
    try:
        _as_user(spark, sf, "driver_1", ["Shipments.totalRevenue"])
    except PermissionError:
        return _as_user(
            spark,
            sf,
            "driver_1",
            ["DriverShifts.totalShifts", "DriverShifts.totalDistanceKm"],
            ["DriverShifts.driverName"],
        )
    raise AssertionError("a driver reached the booking cube")


@query(
    "rls_guest",
    obt('SELECT SENDING_PROVINCE AS "sendingProvince", count(*) AS "totalBookings" FROM obt WHERE false GROUP BY ALL'),
)
def _(spark, sf):
    return _as_user(spark, sf, "nobody", ["Shipments.totalBookings"], ["Shipments.sendingProvince"])


@query(
    "rls_grouped_clauses",
    obt(
        """SELECT SENDING_REGION, STATUS_GROUP, count(*) AS n FROM obt
WHERE STATUS_GROUP <> 'FAILED' AND (SENDING_REGION = 'ASIA' OR RECEIVING_REGION = 'ASIA')
  AND (WEIGHT_GRAM < 10000 OR MAIN_FEE < 20000)
GROUP BY SENDING_REGION, STATUS_GROUP"""
    ),
)
def _(spark, sf):
    rules = ClauseRules(
        [
            Clause("STATUS_GROUP <> 'FAILED'"),
            Clause("SENDING_REGION = 'ASIA'", "area"),
            Clause("RECEIVING_REGION = 'ASIA'", "area"),
            Clause("WEIGHT_GRAM < 10000", "size"),
            Clause("MAIN_FEE < 20000", "size"),
        ]
    )
    rows = rules.apply(stored_wide(spark, sf))
    return rows.groupBy("SENDING_REGION", "STATUS_GROUP").agg(F.count(F.lit(1)).alias("n"))

