"""Dataset query operator, one query per feature."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelmill.operators.dataset import Agg, Dataset, DatasetQuery, Expr, Filter, distinct_values, run, virtual_dataset
from parcelmill.plans import domain
from parcelmill.plans.semantic import SHIPMENTS
from parcelmill.registry.base import query
from parcelmill.registry.gold import stored_wide, wide
from parcelmill.registry.semantic import measures_sql
from parcelmill.registry.sql import obt, with_


def bookings_dataset(spark, sf) -> Dataset:
    return Dataset(stored_wide(spark, sf), SHIPMENTS.measures, time_column="BOOKING_DATE")


def _simple(key: str, oracle: str, **fields) -> None:
    @query(key, oracle)
    def _(spark, sf):
        return run(bookings_dataset(spark, sf), DatasetQuery(**fields))


ROWS = Agg("COUNT", "BOOKING_ID", "n")
REVENUE = Agg("SUM", "TOTAL_REVENUE", "revenue")
REVENUE_SQL = "round(CAST(sum(TOTAL_REVENUE) AS DOUBLE), 4) AS revenue"


_simple(
    "dq_simple_aggs",
    obt(
        """SELECT SENDING_REGION, count(BOOKING_ID) AS n, count(DISTINCT CUSTOMER_ID) AS customers,
       round(CAST(sum(TOTAL_REVENUE) AS DOUBLE), 4) AS revenue,
       round(CAST(sum(WEIGHT_GRAM) AS DOUBLE) / count(WEIGHT_GRAM), 4) AS avg_weight,
       CAST(min(MAIN_FEE) AS DOUBLE) AS min_fee, CAST(max(MAIN_FEE) AS DOUBLE) AS max_fee
FROM obt GROUP BY SENDING_REGION"""
    ),
    groupby=["SENDING_REGION"],
    metrics=[
        ROWS,
        Agg("COUNT_DISTINCT", "CUSTOMER_ID", "customers"),
        REVENUE,
        Agg("AVG", "WEIGHT_GRAM", "avg_weight"),
        Agg("MIN", "MAIN_FEE", "min_fee"),
        Agg("MAX", "MAIN_FEE", "max_fee"),
    ],
)

_simple(
    "dq_expr_metric",
    obt(
        """SELECT SERVICE_NAME,
       round(CAST(sum(DISCOUNT_AMOUNT) AS DOUBLE) / CAST(sum(MAIN_FEE) AS DOUBLE) * 100, 4) AS discount_pct
FROM obt GROUP BY SERVICE_NAME"""
    ),
    groupby=["SERVICE_NAME"],
    metrics=[
        Expr("cast(sum(DISCOUNT_AMOUNT) as double) / cast(sum(MAIN_FEE) as double) * 100", "discount_pct")
    ],
)

_simple(
    "dq_groupby",
    obt(
        f"""SELECT RECEIVING_REGION, STATUS_GROUP, {measures_sql("totalBookings", "totalRevenue")}
FROM obt GROUP BY RECEIVING_REGION, STATUS_GROUP"""
    ),
    groupby=["RECEIVING_REGION", "STATUS_GROUP", "RECEIVING_REGION"],
    metrics=["totalBookings", "totalRevenue"],
)

_simple(
    "dq_raw_select",
    obt(
        """SELECT BOOKING_ID, SENDING_PROVINCE, CAST(TOTAL_REVENUE AS DOUBLE) AS TOTAL_REVENUE,
       SENDING_PROVINCE = RECEIVING_PROVINCE AS same_province FROM obt"""
    ),
    columns=[
        "BOOKING_ID",
        "SENDING_PROVINCE",
        "TOTAL_REVENUE",
        Expr("SENDING_PROVINCE = RECEIVING_PROVINCE", "same_province"),
    ],
)

_simple(
    "dq_expr_dim",
    obt(
        f"""SELECT CASE WHEN WEIGHT_GRAM <= 10000 THEN 'light' WHEN WEIGHT_GRAM <= 30000 THEN 'medium' ELSE 'heavy' END AS tier,
       count(BOOKING_ID) AS n, {REVENUE_SQL} FROM obt GROUP BY 1"""
    ),
    groupby=[
        Expr(
            "case when WEIGHT_GRAM <= 10000 then 'light' when WEIGHT_GRAM <= 30000 then 'medium' else 'heavy' end",
            "tier",
        )
    ],
    metrics=[ROWS, REVENUE],
)


@query(
    "dq_time_grain",
    obt(
        f"""SELECT CAST(CAST(date_trunc('month', BOOKING_DATE) AS DATE) AS VARCHAR) AS __timestamp, SENDING_REGION,
       {measures_sql("totalBookings")} FROM obt GROUP BY ALL"""
    ),
)
def _(spark, sf):
    result = run(
        bookings_dataset(spark, sf),
        DatasetQuery(metrics=["totalBookings"], groupby=["SENDING_REGION"], is_timeseries=True, time_grain="P1M"),
    )
    return result.withColumn("__timestamp", F.col("__timestamp").cast("date"))


@query(
    "dq_time_grain_minutes",
    """SELECT epoch_us(time_bucket(INTERVAL 15 MINUTE, ts)) // 1000000 AS __timestamp, event_type, count(event_id) AS n
FROM events GROUP BY ALL""",
)
def _(spark, sf):
    """Grain that is a multiple of a unit."""
    events = domain.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    result = run(
        Dataset(events, time_column="ts"),
        DatasetQuery(
            metrics=[Agg("COUNT", "event_id", "n")], groupby=["event_type"], is_timeseries=True, time_grain="PT15M"
        ),
    )
    return result.withColumn("__timestamp", F.unix_seconds("__timestamp"))


_simple(
    "dq_time_range",
    obt(
        f"""SELECT STATUS_GROUP, {measures_sql("totalBookings")} FROM obt
WHERE BOOKING_DATE >= DATE '1997-01-01' AND BOOKING_DATE < DATE '1998-01-01' GROUP BY STATUS_GROUP"""
    ),
    groupby=["STATUS_GROUP"],
    metrics=["totalBookings"],
    granularity="BOOKING_DATE",
    from_dttm="1997-01-01",
    to_dttm="1998-01-01",
)

_simple(
    "dq_temporal_filter",
    obt(
        f"""SELECT SENDING_REGION, {measures_sql("totalBookings")} FROM obt
WHERE date_trunc('month', CREATED_AT) >= TIMESTAMP '1996-02-01' AND date_trunc('month', CREATED_AT) < TIMESTAMP '1996-05-15'
GROUP BY SENDING_REGION"""
    ),
    groupby=["SENDING_REGION"],
    metrics=["totalBookings"],
    filters=[Filter("CREATED_AT", "TEMPORAL_RANGE", "1996-02-01 : 1996-05-15", grain="P1M")],
)

_simple(
    "dq_compare",
    obt(
        f"""SELECT STATUS_GROUP, count(BOOKING_ID) AS n FROM obt
WHERE SENDING_REGION = 'ASIA' AND STATUS_GROUP <> 'FAILED' AND WEIGHT_GRAM > 5000 AND WEIGHT_GRAM <= 40000
  AND MAIN_FEE >= 1000 AND MAIN_FEE < 90000 GROUP BY STATUS_GROUP"""
    ),
    groupby=["STATUS_GROUP"],
    metrics=[ROWS],
    filters=[
        Filter("SENDING_REGION", "==", "ASIA"),
        Filter("STATUS_GROUP", "!=", "FAILED"),
        Filter("WEIGHT_GRAM", ">", 5000),
        Filter("WEIGHT_GRAM", "<=", 40000),
        Filter("MAIN_FEE", ">=", 1000),
        Filter("MAIN_FEE", "<", 90000),
    ],
)


def _nulls(key: str, oracle: str, **fields) -> None:
    """On bookings whose customer may be unknown, so that customer columns hold NULLs."""

    @query(key, oracle)
    def _(spark, sf):
        rows = wide(spark, sf, domain.verified_customers(spark, sf))
        return run(Dataset(rows, SHIPMENTS.measures, time_column="BOOKING_DATE"), DatasetQuery(**fields))


def _verified(body: str) -> str:
    return with_("obt_verified", body)


_nulls(
    "dq_in_null",
    _verified(
        """SELECT CUSTOMER_TYPE, count(BOOKING_ID) AS n FROM obt_verified
WHERE CUSTOMER_TYPE IS NULL OR CUSTOMER_TYPE IN ('BUILDING', 'MACHINERY') GROUP BY CUSTOMER_TYPE"""
    ),
    groupby=["CUSTOMER_TYPE"],
    metrics=[ROWS],
    filters=[Filter("CUSTOMER_TYPE", "IN", ["BUILDING", None, "MACHINERY"])],
)
_nulls(
    "dq_not_in_null",
    _verified(
        """SELECT CUSTOMER_TYPE, count(BOOKING_ID) AS n FROM obt_verified
WHERE NOT (CUSTOMER_TYPE IS NULL OR CUSTOMER_TYPE IN ('BUILDING', 'MACHINERY')) GROUP BY CUSTOMER_TYPE"""
    ),
    groupby=["CUSTOMER_TYPE"],
    metrics=[ROWS],
    filters=[Filter("CUSTOMER_TYPE", "NOT IN", ["BUILDING", None, "MACHINERY"])],
)
_nulls(
    "dq_null_bool",
    _verified(
        """SELECT CUSTOMER_REGION, count(BOOKING_ID) AS n FROM obt_verified
WHERE CUSTOMER_NAME IS NOT NULL AND IS_INTERNATIONAL IS NOT NULL AND CAST(IS_INTERNATIONAL AS BOOLEAN) IS FALSE
  AND (CUSTOMER_REGION = SENDING_REGION) IS TRUE
GROUP BY CUSTOMER_REGION"""
    ),
    groupby=["CUSTOMER_REGION"],
    metrics=[ROWS],
    filters=[
        Filter("CUSTOMER_NAME", "IS NOT NULL"),
        Filter("IS_INTERNATIONAL", "IS FALSE"),
        Filter(Expr("CUSTOMER_REGION = SENDING_REGION", "home"), "IS TRUE"),
    ],
)
_nulls(
    "dq_is_null",
    _verified(
        "SELECT SENDING_REGION, count(BOOKING_ID) AS n FROM obt_verified WHERE CUSTOMER_NAME IS NULL GROUP BY SENDING_REGION"
    ),
    groupby=["SENDING_REGION"],
    metrics=[ROWS],
    filters=[Filter("CUSTOMER_NAME", "IS NULL")],
)

_simple(
    "dq_like",
    obt(
        """SELECT SENDING_PROVINCE, count(BOOKING_ID) AS n FROM obt
WHERE SENDING_PROVINCE LIKE 'NATION_1%' AND CAST(WEIGHT_GRAM AS VARCHAR) LIKE '1%' GROUP BY SENDING_PROVINCE"""
    ),
    groupby=["SENDING_PROVINCE"],
    metrics=[ROWS],
    filters=[Filter("SENDING_PROVINCE", "LIKE", "NATION_1%"), Filter("WEIGHT_GRAM", "LIKE", "1%")],
)
_simple(
    "dq_ilike",
    obt("SELECT SERVICE_NAME, count(BOOKING_ID) AS n FROM obt WHERE SERVICE_NAME ILIKE '%eco%' GROUP BY SERVICE_NAME"),
    groupby=["SERVICE_NAME"],
    metrics=[ROWS],
    filters=[Filter("SERVICE_NAME", "ILIKE", "%eco%")],
)
_simple(
    "dq_where_having",
    obt(
        f"""SELECT SENDING_PROVINCE, RECEIVING_PROVINCE, count(BOOKING_ID) AS n, {REVENUE_SQL} FROM obt
WHERE MAIN_FEE > 2 * SUR_FEE AND STATUS_GROUP <> 'FAILED'
GROUP BY SENDING_PROVINCE, RECEIVING_PROVINCE HAVING count(*) > 20 AND avg(WEIGHT_GRAM) > 25000"""
    ),
    groupby=["SENDING_PROVINCE", "RECEIVING_PROVINCE"],
    metrics=[ROWS, REVENUE],
    where="MAIN_FEE > 2 * SUR_FEE AND STATUS_GROUP <> 'FAILED'",
    having="count(*) > 20 AND avg(WEIGHT_GRAM) > 25000",
)
_simple(
    "dq_orderby_hidden",
    obt(
        """SELECT CUSTOMER_ID, count(BOOKING_ID) AS n FROM obt
GROUP BY CUSTOMER_ID ORDER BY sum(TOTAL_REVENUE) DESC, CUSTOMER_ID LIMIT 25"""
    ),
    groupby=["CUSTOMER_ID"],
    metrics=[ROWS],
    orderby=[(Agg("SUM", "TOTAL_REVENUE"), False), ("CUSTOMER_ID", True)],
    row_limit=25,
)
_simple(
    "dq_limit_offset",
    obt(
        f"""SELECT SENDING_PROVINCE, RECEIVING_PROVINCE, {measures_sql("totalRevenue")} FROM obt
GROUP BY SENDING_PROVINCE, RECEIVING_PROVINCE
ORDER BY "totalRevenue" DESC, SENDING_PROVINCE, RECEIVING_PROVINCE LIMIT 15 OFFSET 30"""
    ),
    groupby=["SENDING_PROVINCE", "RECEIVING_PROVINCE"],
    metrics=["totalRevenue"],
    orderby=[("totalRevenue", False), ("SENDING_PROVINCE", True), ("RECEIVING_PROVINCE", True)],
    row_limit=15,
    row_offset=30,
)
_simple(
    "dq_series_limit",
    obt(
        f"""SELECT CAST(CAST(date_trunc('year', BOOKING_DATE) AS DATE) AS VARCHAR) AS booking_year, CUSTOMER_NAME,
       {measures_sql("totalBookings", "totalRevenue")}
FROM obt WHERE CUSTOMER_NAME IN (
    SELECT CUSTOMER_NAME FROM obt GROUP BY CUSTOMER_NAME ORDER BY sum(TOTAL_REVENUE) DESC, CUSTOMER_NAME LIMIT 12)
GROUP BY ALL"""
    ),
    groupby=[Expr("cast(date_trunc('YEAR', BOOKING_DATE) as date)", "booking_year"), "CUSTOMER_NAME"],
    metrics=["totalBookings", "totalRevenue"],
    series_columns=["CUSTOMER_NAME"],
    series_limit=12,
    series_limit_metric="totalRevenue",
)
_simple(
    "dq_rowcount",
    obt(
        """SELECT count(*) AS rowcount FROM (
    SELECT SENDING_PROVINCE, RECEIVING_PROVINCE, SERVICE_NAME FROM obt GROUP BY ALL HAVING count(*) > 5) t"""
    ),
    groupby=["SENDING_PROVINCE", "RECEIVING_PROVINCE", "SERVICE_NAME"],
    metrics=["totalBookings"],
    having="count(*) > 5",
    is_rowcount=True,
)


@query(
    "dq_distinct_values",
    obt("SELECT DISTINCT SENDING_PROVINCE FROM obt WHERE SENDING_REGION = 'EUROPE'"),
)
def _(spark, sf):
    ds = bookings_dataset(spark, sf)
    ds.fetch_predicate = "SENDING_REGION = 'EUROPE'"
    return distinct_values(ds, "SENDING_PROVINCE")


@query(
    "dq_virtual_dataset",
    obt(
        """SELECT SENDING_REGION, count(*) AS provinces, round(CAST(sum(revenue) AS DOUBLE), 4) AS revenue
FROM (SELECT SENDING_REGION, SENDING_PROVINCE, sum(TOTAL_REVENUE) AS revenue FROM obt GROUP BY ALL) t
GROUP BY SENDING_REGION"""
    ),
)
def _(spark, sf):
    ds = virtual_dataset(
        spark,
        """WITH per_province AS (
             SELECT SENDING_REGION, SENDING_PROVINCE, sum(TOTAL_REVENUE) AS revenue
             FROM dq_bookings GROUP BY SENDING_REGION, SENDING_PROVINCE)
           SELECT * FROM per_province""",
        {"dq_bookings": stored_wide(spark, sf)},
    )
    metrics = [Agg("COUNT", "SENDING_PROVINCE", "provinces"), Agg("SUM", "revenue", "revenue")]
    return run(ds, DatasetQuery(groupby=["SENDING_REGION"], metrics=metrics))


_simple(
    "dq_time_shift",
    obt(
        f"""SELECT SENDING_REGION, {measures_sql("totalBookings", "totalRevenue")} FROM obt
WHERE BOOKING_DATE >= DATE '1998-03-01' AND BOOKING_DATE < DATE '1998-09-01' GROUP BY SENDING_REGION"""
    ),
    groupby=["SENDING_REGION"],
    metrics=["totalBookings", "totalRevenue"],
    granularity="BOOKING_DATE",
    from_dttm="1999-03-01",
    to_dttm="1999-09-01",
    time_shift="1 year",
)
