"""Batch control, reconciliation, profiles and constraint checks."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


from parcelmill.operators import audit, control
from parcelmill.plans import domain, medallion
from parcelmill.registry.base import query, stored
from parcelmill.registry.cdc import KEYS, history_out, topics_bronze, topics_bronze_path, user_schema
from parcelmill.registry.gold import stored_fact, wide
from parcelmill.registry.sql import with_
from parcelmill.sinks import tables

# one topic per event type; each is a table keyed by user
REGISTRY = {name: KEYS for name in ("CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW")}


def stored_lake(spark: SparkSession, sf: str) -> medallion.Lake:
    """Silver of all topics after two runs: up to 2024-01-15, then from the watermarks on."""
    bronze = topics_bronze_path(spark, sf)

    def lake_at(path: str) -> medallion.Lake:
        return medallion.Lake(bronze, f"{path}/silver", f"{path}/quarantine", f"{path}/control")

    def write(path: str) -> None:
        declared = {name: user_schema() for name in REGISTRY}
        run = lambda **k: medallion.run_medallion(spark, lake_at(path), REGISTRY, schemas=declared, **k)
        run(to_ts="2024-01-15 00:00:00")
        run()

    return lake_at(stored(spark, sf, "lake", write))


_PER_TABLE = """SELECT upper(event_type) AS table_name, *, row_number() OVER
       (PARTITION BY event_type, user_id ORDER BY event_id DESC) AS rn FROM messages WHERE NOT faulty"""


@query(
    "run_medallion_all",
    with_(
        "messages",
        """SELECT table_name, user_id AS ID, event_type AS STATUS, value AS AMOUNT FROM per_table
WHERE rn = 1 AND op <> 'd'""",
        per_table=_PER_TABLE,
    ),
)
def _(spark, sf):
    """Current state of every table."""
    rows = None
    for name, (value, _) in medallion.silver_tables(spark, stored_lake(spark, sf), REGISTRY).items():
        part = value.select(F.lit(name).alias("table_name"), "ID", "STATUS", "AMOUNT")
        rows = part if rows is None else rows.unionByName(part)
    return rows


@query(
    "run_medallion_history",
    with_(
        "messages",
        """SELECT user_id AS ID, event_type AS STATUS, value AS AMOUNT, ts_ms AS from_ms,
       coalesce(lead(ts_ms) OVER (PARTITION BY user_id ORDER BY ts_ms), 253402300799000) AS to_ms,
       CASE WHEN lead(ts_ms) OVER (PARTITION BY user_id ORDER BY ts_ms) IS NULL THEN 1 ELSE 0 END AS is_current
FROM messages WHERE NOT faulty AND event_type = 'view'""",
    ),
)
def _(spark, sf):
    _, versions = medallion.silver_tables(spark, stored_lake(spark, sf), REGISTRY)["VIEW"]
    return history_out(versions)


@query(
    "reconcile_silver",
    with_(
        "messages",
        """SELECT table_name, count(*) FILTER (rn = 1 AND op <> 'd') AS value_count,
       count(*) FILTER (op <> 'd') AS history_total, count(*) FILTER (rn = 1 AND op <> 'd') AS history_active,
       count(*) FILTER (rn > 1 AND op <> 'd') AS history_closed, true AS matches
FROM per_table GROUP BY table_name""",
        per_table=_PER_TABLE,
    ),
)
def _(spark, sf):
    return control.reconcile(medallion.silver_tables(spark, stored_lake(spark, sf), REGISTRY))


@query(
    "ctl_lineage",
    with_(
        "messages",
        """SELECT table_name, run, count(*) AS records_read, count(*) FILTER (faulty) AS records_dlq,
       CASE WHEN count(*) FILTER (faulty) > 0 THEN 'WARNING_DLQ' ELSE 'SUCCESS' END AS status
FROM (
    SELECT upper(event_type) AS table_name, 1 AS run, faulty FROM messages WHERE ts_ms <= 1705276800000
    UNION ALL
    SELECT upper(event_type), 2, faulty FROM messages WHERE ts_ms > 1705276800000) t
GROUP BY table_name, run""",
    ),
)
def _(spark, sf):
    """One record per table and run; the second run starts after the offsets of the first."""
    log = tables.read_appended(spark, stored_lake(spark, sf).lineage)
    run = F.when(F.col("start_cutoff") == "1970-01-01 00:00:00", 1).otherwise(2)
    return log.select("table_name", run.alias("run"), "records_read", "records_dlq", "status")


def _two_appends(spark, sf, name: str, first) -> medallion.Lake:
    """Silver after two runs, of which the second finds what Bronze was given after the first one."""
    rows = topics_bronze(spark, sf)

    def lake_at(path: str) -> medallion.Lake:
        return medallion.Lake(f"{path}/bronze", f"{path}/silver", f"{path}/quarantine", f"{path}/control")

    def write(path: str) -> None:
        lake = lake_at(path)
        for part in (rows.filter(first), rows.filter(~first)):
            tables.append(part, lake.bronze, ["kafka_topic"], tables.LOG_GROUP)
            medallion.run_medallion(spark, lake, REGISTRY, schemas={n: user_schema() for n in REGISTRY})

    return lake_at(stored(spark, sf, name, write))


@query(
    "run_medallion_late",
    with_(
        "messages",
        """SELECT table_name, user_id AS ID, event_type AS STATUS, value AS AMOUNT FROM per_table
WHERE rn = 1 AND op <> 'd'""",
        per_table=_PER_TABLE,
    ),
)
def _(spark, sf):
    """Current state where whole log partitions land late, with older times than what was processed."""
    lake = _two_appends(spark, sf, "late-lake", F.col("kafka_partition") == 0)
    parts = [
        value.select(F.lit(name).alias("table_name"), "ID", "STATUS", "AMOUNT")
        for name, (value, _) in medallion.silver_tables(spark, lake, REGISTRY).items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query(
    "ctl_watermarks",
    with_(
        "messages",
        """SELECT upper(event_type) AS table_name, CAST(part AS INTEGER) AS kafka_partition, max(ts_ms) AS last_ms,
       max(event_id) AS last_processed_offset FROM messages GROUP BY event_type, part""",
    ),
)
def _(spark, sf):
    """Watermarks as the runs left them, through the one read that a job makes."""
    marks = control.load_watermarks(tables.read_snapshot(spark, stored_lake(spark, sf).watermarks))
    rows = control.watermark_frame(spark, marks, datetime.now(timezone.utc))
    at = F.col("last_processed_ts").cast("timestamp")
    return rows.select("table_name", "kafka_partition", F.unix_millis(at).alias("last_ms"), "last_processed_offset")


@query(
    "ctl_high_watermark",
    with_(
        "messages",
        """SELECT concat('cdc.', upper(event_type)) AS kafka_topic, CAST(part AS INTEGER) AS kafka_partition,
       max(ts_ms) AS max_event_ms, max(event_id) AS max_offset FROM messages GROUP BY ALL""",
    ),
)
def _(spark, sf):
    marks = control.high_watermark(topics_bronze(spark, sf), "kafka_topic", "kafka_partition")
    return marks.select(
        "kafka_topic", "kafka_partition", F.unix_millis("max_event_time").alias("max_event_ms"), "max_offset"
    )


@query(
    "profile_counts",
    """SELECT 'CUSTOMERS' AS table_name, count(*) AS record_count FROM customer
UNION ALL SELECT 'POS_LOCATIONS', count(*) FROM nation
UNION ALL SELECT 'BOOKING_VERSIONS', count(*) FROM lineitem
UNION ALL SELECT 'EVENTS', count(*) FROM events""",
)
def _(spark, sf):
    return audit.profile_counts(
        {
            "CUSTOMERS": domain.table(spark, sf, "customer"),
            "POS_LOCATIONS": domain.table(spark, sf, "nation"),
            "BOOKING_VERSIONS": domain.table(spark, sf, "lineitem"),
            "EVENTS": domain.table(spark, sf, "events"),
        }
    )


@query(
    "top_n_latest",
    with_(
        "bookings",
        """SELECT BOOKING_ID, ITEM_CODE, CAST(CAST(BOOKING_DATE AS DATE) AS VARCHAR) AS BOOKING_DATE, CUSTOMER_ID,
       WEIGHT_GRAM, STATUS_ID FROM bookings ORDER BY bookings.BOOKING_DATE DESC, BOOKING_ID LIMIT 10""",
    ),
)
def _(spark, sf):
    rows = stored_fact(spark, sf).orderBy(F.col("BOOKING_DATE").desc(), "BOOKING_ID").limit(10)
    return rows.select("BOOKING_ID", "ITEM_CODE", "BOOKING_DATE", "CUSTOMER_ID", "WEIGHT_GRAM", "STATUS_ID")


@query(
    "top_n_earliest_events",
    """SELECT event_id, user_id, event_type, epoch_us(ts) // 1000 AS at_ms FROM events ORDER BY ts, event_id LIMIT 10""",
)
def _(spark, sf):
    rows = domain.table(spark, sf, "events").orderBy("ts", "event_id").limit(10)
    return rows.select(
        "event_id", "user_id", "event_type", F.unix_millis(F.col("ts").cast("timestamp")).alias("at_ms")
    )


@query(
    "audit_not_null",
    with_(
        "obt_verified",
        """SELECT 'BOOKING_ID' AS column_name, count(*) FILTER (BOOKING_ID IS NULL) AS null_rows FROM obt_verified
UNION ALL SELECT 'CUSTOMER_NAME', count(*) FILTER (CUSTOMER_NAME IS NULL) FROM obt_verified
UNION ALL SELECT 'SENDING_PROVINCE', count(*) FILTER (SENDING_PROVINCE IS NULL) FROM obt_verified
UNION ALL SELECT 'TOTAL_REVENUE', count(*) FILTER (TOTAL_REVENUE IS NULL) FROM obt_verified""",
    ),
)
def _(spark, sf):


    rows = wide(spark, sf, domain.verified_customers(spark, sf))
    return audit.null_violations(rows, ["BOOKING_ID", "CUSTOMER_NAME", "SENDING_PROVINCE", "TOTAL_REVENUE"])


@query(
    "audit_unique",
    """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def _(spark, sf):
    """Line items break their composite key."""
    return audit.duplicate_keys(domain.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "audit_foreign_key",
    with_(
        "bookings dim_verified",
        """SELECT CUSTOMER_ID, count(*) AS fact_rows FROM bookings
WHERE CUSTOMER_ID NOT IN (SELECT CUSTOMER_ID FROM dim_verified) GROUP BY CUSTOMER_ID""",
    ),
)
def _(spark, sf):
    return audit.orphan_keys(
        stored_fact(spark, sf), "CUSTOMER_ID", domain.verified_customers(spark, sf), "CUSTOMER_ID"
    )
