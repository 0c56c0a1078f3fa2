"""Bronze to Silver to Gold to warehouse in two rounds, and the semantic layer over the result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmill.plans import dashboards, domain, marts, medallion, semantic
from parcelmill.registry.base import query, stored
from parcelmill.registry.gold import SPLIT
from parcelmill.registry.semantic import measures_sql
from parcelmill.registry.sql import obt
from parcelmill.schemas import TABLE_KEYS
from parcelmill.sinks import tables
from parcelmill.sources import changes

REGISTRY = {name: TABLE_KEYS[name] for name in marts.SILVER.values()}
DAY_MS = 86_400_000
FIRST_MS = 1_704_067_200_000


def _messages(rows: DataFrame, part: str, turn: int, deleted: Column | None = None) -> DataFrame:
    """Change messages that carry rows as they are, and the deletion of those marked."""
    name = marts.SILVER[part]
    op = F.lit("u") if deleted is None else F.when(deleted, "d").otherwise("u")
    image = F.struct(*[c for c in rows.columns if c != "ingested_at"])
    at = F.lit(FIRST_MS + turn * DAY_MS)
    envelope = F.struct(
        op.alias("op"), at.alias("ts_ms"), F.when(op == "d", image).alias("before"), F.when(op != "d", image).alias("after")
    )
    return rows.select(
        F.col(REGISTRY[name][0]).cast("string").alias("key"),
        F.to_json(envelope).alias("value"),
        F.lit(f"cdc.{name}").alias("topic"),
        F.lit(0).alias("partition"),
        (F.lit(turn << 50) + F.monotonically_increasing_id()).alias("offset"),
        F.timestamp_millis(at).alias("timestamp"),
    )


def _turn(spark: SparkSession, sf: str, turn: int) -> list[DataFrame]:
    """First: old bookings, those in progress under another date, and solvent customers of an unknown type.
    Second: new bookings, the right dates, deletions of old returned ones, and all customers."""
    rows = domain.bookings(spark, sf).withColumns(
        {c: F.date_format(c, "yyyy-MM-dd") for c in ("BOOKING_DATE", "CREATED_AT", "UPDATED_AT")}
    )
    old, in_progress, returned = F.col("CREATED_AT") < SPLIT, F.col("STATUS_ID") == "A-F", F.col("STATUS_ID") == "R-F"
    people = domain.customers(spark, sf)
    if turn == 0:
        other = F.when(in_progress, F.date_format(F.date_add("BOOKING_DATE", 40), "yyyy-MM-dd")).otherwise(F.col("BOOKING_DATE"))
        known = domain.verified_customers(spark, sf).withColumn("CUSTOMER_TYPE", F.lit("UNKNOWN"))
        return [
            _messages(rows.filter(old).withColumn("BOOKING_DATE", other), "bookings", turn),
            _messages(known, "customers", turn),
            _messages(domain.services(spark, sf), "services", turn),
            _messages(domain.pos_locations(spark, sf), "pos", turn),
            _messages(domain.delivery_statuses(spark, sf), "statuses", turn),
        ]
    return [
        _messages(rows.filter(~old | in_progress | returned), "bookings", turn, old & returned),
        _messages(people, "customers", turn),
    ]


def stored_marts(spark: SparkSession, sf: str) -> tuple[medallion.Lake, marts.Marts]:
    """Lake and marts after two rounds of all jobs."""

    def write(path: str) -> None:
        lake, out = _places(path)
        for turn in (0, 1):
            play_turn(spark, sf, lake, turn)
            marts.run_gold(spark, lake, out, REGISTRY)
            marts.load_warehouse(spark, out)

    return _places(stored(spark, sf, "marts", write))


def _places(path: str) -> tuple[medallion.Lake, marts.Marts]:
    lake = medallion.Lake(f"{path}/bronze", f"{path}/silver", f"{path}/quarantine", f"{path}/control")
    return lake, marts.Marts(f"{path}/gold", f"{path}/warehouse")


def play_turn(spark: SparkSession, sf: str, lake: medallion.Lake, turn: int) -> None:
    """A turn's messages, and Silver after them. Nobody reads the Silver of the turn before any more."""
    for batch in _turn(spark, sf, turn):
        tables.append(changes.to_bronze(batch), lake.bronze, ["kafka_topic"])
    medallion.run_medallion(spark, lake, REGISTRY)
    for name, keys in REGISTRY.items():
        for path in (lake.table(name, keys).value, lake.table(name, keys).history):
            tables.prune_snapshots(spark, path, keep=1)


def refreshed_marts(spark: SparkSession, sf: str) -> tuple[medallion.Lake, marts.Marts]:
    """Marts whose second round is a full refresh of Gold, with loads that have nothing to do after each."""

    def write(path: str) -> None:
        lake, out = _places(path)
        for turn in (0, 1):
            play_turn(spark, sf, lake, turn)
            marts.run_gold(spark, lake, out, REGISTRY, full_refresh=turn == 1)
            for _ in range(3):
                marts.load_warehouse(spark, out)

    return _places(stored(spark, sf, "refreshed-marts", write))


LIVE = f"NOT (STATUS_ID = 'R-F' AND CREATED_AT < TIMESTAMP '{SPLIT}')"


@query(
    "gold_end_to_end",
    obt(
        f"""SELECT BOOKING_ID, CAST(BOOKING_DATE AS VARCHAR) AS BOOKING_DATE, WEIGHT_GRAM,
       CAST(TOTAL_REVENUE AS DOUBLE) AS TOTAL_REVENUE, CAST(PROFIT_AMOUNT AS DOUBLE) AS PROFIT_AMOUNT, CUSTOMER_ID,
       CUSTOMER_TYPE, CUSTOMER_REGION, SERVICE_NAME, SENDING_PROVINCE, RECEIVING_PROVINCE, STATUS_GROUP
FROM obt WHERE {LIVE}"""
    ),
)
def _(spark, sf):
    """The warehouse's last versions after a change of a dimension, new, moved and deleted bookings."""
    _, out = stored_marts(spark, sf)
    return marts.current_bookings(spark, out).select(
        "BOOKING_ID", "BOOKING_DATE", "WEIGHT_GRAM", "TOTAL_REVENUE", "PROFIT_AMOUNT", "CUSTOMER_ID", "CUSTOMER_TYPE",
        "CUSTOMER_REGION", "SERVICE_NAME", "SENDING_PROVINCE", "RECEIVING_PROVINCE", "STATUS_GROUP",
    )


@query(
    "gold_full_refresh",
    obt(
        f"""SELECT BOOKING_ID, CAST(BOOKING_DATE AS VARCHAR) AS BOOKING_DATE, CAST(TOTAL_REVENUE AS DOUBLE) AS TOTAL_REVENUE,
       CUSTOMER_TYPE, SENDING_PROVINCE, STATUS_GROUP FROM obt WHERE {LIVE}"""
    ),
)
def _(spark, sf):
    """The warehouse's last versions after a full refresh of Gold found what had changed, moved and gone."""
    view = marts.current_bookings(spark, refreshed_marts(spark, sf)[1])
    return view.select("BOOKING_ID", "BOOKING_DATE", "TOTAL_REVENUE", "CUSTOMER_TYPE", "SENDING_PROVINCE", "STATUS_GROUP")


@query(
    "wh_idle_load",
    obt(
        f"""SELECT CAST(strftime(CASE WHEN STATUS_ID = 'A-F' THEN BOOKING_DATE + INTERVAL 40 DAY ELSE BOOKING_DATE END, '%Y%m') AS INTEGER)
       AS booking_month, COUNT(*) AS versions, CAST(SUM(TOTAL_REVENUE) AS DOUBLE) AS revenue
FROM obt WHERE CREATED_AT < TIMESTAMP '{SPLIT}' GROUP BY ALL"""
    ),
)
def _(spark, sf):
    """Versions of the first run in the base by month, after loads that had nothing to load."""
    base = spark.read.parquet(refreshed_marts(spark, sf)[1].base).filter(F.col(marts.RUN) == 1)
    return base.groupBy(marts.MONTH).agg(F.count(F.lit(1)).alias("versions"), F.sum("TOTAL_REVENUE").cast("double").alias("revenue"))


@query(
    "semantic_on_view",
    obt(
        f"""SELECT SENDING_REGION AS "sendingRegion", CUSTOMER_TYPE AS "customerType",
       {measures_sql("totalBookings", "totalRevenue", "totalProfit", "uniqueCustomers")} FROM obt
WHERE {LIVE} AND BOOKING_DATE >= DATE '1997-01-01' AND BOOKING_DATE < DATE '1998-01-01' GROUP BY ALL"""
    ),
)
def _(spark, sf):
    """Measures over the last versions of a year; only its months are read."""
    year = marts.current_bookings(spark, stored_marts(spark, sf)[1]).filter("booking_month BETWEEN 199701 AND 199712")
    members = ["totalBookings", "totalRevenue", "totalProfit", "uniqueCustomers"]
    return semantic.query(year, semantic.SHIPMENTS, members, ["sendingRegion", "customerType"])


@query(
    "dash_on_view",
    obt(
        f"""SELECT SENDING_REGION AS "sendingRegion", {measures_sql("completedBookings", "failedBookings")} FROM obt
WHERE {LIVE} GROUP BY ALL"""
    ),
)
def _(spark, sf):
    """A chart of the dashboard over the last versions."""
    return dashboards.chart(marts.current_bookings(spark, stored_marts(spark, sf)[1]), "quality_region")
