"""Change log, Bronze, payload, merge and history queries.

The change log is derived from all events: the row is a user's state, a click, view or purchase
updates it, a sign-up creates it, an error deletes it.
"""

from __future__ import annotations

import os
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parcelmill import session
from parcelmill.functions import cdc
from parcelmill.functions.shape import align_to, evolve_union
from parcelmill.functions.times import between, normalize_epochs, to_utc
from parcelmill.operators import control, dedup, history, merge, payload
from parcelmill.plans import domain, medallion
from parcelmill.registry.base import query, stored, whole_sums
from parcelmill.registry.sql import with_
from parcelmill.sinks import tables
from parcelmill.sources import changes, lake

KEYS = ["ID"]
STAMP = "2024-02-01 00:00:00"


def stamp():
    return F.lit(STAMP).cast("timestamp")


def user_schema():
    return StructType.fromDDL("ID bigint, STATUS string, AMOUNT double")


def topics_bronze_path(spark: SparkSession, sf: str) -> str:
    """Bronze with one topic per event type, as files."""

    def write(path: str) -> None:
        rows = changes.to_bronze(domain.change_messages(spark, sf, by_type=True), stamp())
        tables.append_partitioned(rows, path, ["kafka_topic"], tables.LOG_GROUP)

    return stored(spark, sf, "bronze", write)


def topics_bronze(spark: SparkSession, sf: str) -> DataFrame:
    return lake.scan(spark, topics_bronze_path(spark, sf))


def users_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """The same messages as changes of one table, the users."""
    return topics_bronze(spark, sf).withColumn("kafka_topic", F.lit("cdc.USERS"))


def days(bronze: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Messages of whole days ``[start, end)``."""
    return bronze.filter(between(F.col("event_time"), start, end))


def parsed_users(spark: SparkSession, sf: str) -> DataFrame:
    """The parsed messages as the batch job leaves them for its sinks."""

    def write(path: str) -> None:
        payload.classify(topics_bronze(spark, sf), KEYS, user_schema())[0].write.parquet(path)

    return spark.read.parquet(stored(spark, sf, "parsed", write))


def valid_changes(parsed: DataFrame) -> DataFrame:
    return payload.valid_rows(parsed, user_schema())


def ms(column: str):
    return F.unix_millis(column)


# -- sources ---------------------------------------------------------------------------------------


@query(
    "src_lake_scan",
    """SELECT concat('cdc.', upper(event_type)) AS kafka_topic, event_id AS kafka_offset, epoch_us(ts) // 1000 AS ts_ms
FROM events""",
)
def _(spark, sf):
    return topics_bronze(spark, sf).select("kafka_topic", "kafka_offset", "ts_ms")


@query(
    "src_path_sql",
    """SELECT concat('cdc.', upper(event_type)) AS kafka_topic, count(*) AS n, min(epoch_us(ts) // 1000) AS first_ms
FROM events GROUP BY event_type""",
)
def _(spark, sf):
    relation = lake.path_relation(topics_bronze_path(spark, sf))
    return spark.sql(f"SELECT kafka_topic, count(*) AS n, min(ts_ms) AS first_ms FROM {relation} GROUP BY kafka_topic")


@query(
    "src_named_external",
    """SELECT concat('cdc.', upper(event_type)) AS kafka_topic, max(event_id) AS last_offset
FROM events GROUP BY event_type""",
)
def _(spark, sf):
    base, table = os.path.split(topics_bronze_path(spark, sf))
    collections = lake.NamedCollections({"lake_bronze": base})
    rows = collections.load(spark, "lake_bronze", table)
    return rows.groupBy("kafka_topic").agg(F.max("kafka_offset").alias("last_offset"))


@query(
    "src_partition_from_path",
    """SELECT concat('cdc.', upper(event_type)) AS table_name, count(*) AS total_records FROM events GROUP BY event_type""",
)
def _(spark, sf):
    rows = topics_bronze(spark, sf).select(lake.from_file_path("kafka_topic").alias("table_name"))
    return rows.groupBy("table_name").agg(F.count(F.lit(1)).alias("total_records"))


# -- Bronze ----------------------------------------------------------------------------------------


@query(
    "bronze_envelope",
    with_(
        "messages",
        """SELECT CAST(user_id AS VARCHAR) AS kafka_key, op, ts_ms, 'cdc.USERS' AS kafka_topic,
       CAST(part AS INTEGER) AS kafka_partition, event_id AS kafka_offset FROM messages""",
    ),
)
def _(spark, sf):
    rows = changes.to_bronze(domain.change_messages(spark, sf), stamp())
    return rows.select(
        "kafka_key", "op", "ts_ms", "kafka_topic", "kafka_partition", "kafka_offset"
    )


@query(
    "bronze_event_time",
    with_("messages", "SELECT event_id AS kafka_offset, ts_ms AS event_time_ms FROM messages"),
)
def _(spark, sf):
    rows = changes.to_bronze(domain.change_messages(spark, sf), stamp())
    return rows.select("kafka_offset", ms("event_time").alias("event_time_ms"))


@query(
    "bronze_backfill",
    with_("messages", "SELECT event_id AS kafka_offset, op, ts_ms, ts_ms AS event_time_ms FROM messages"),
)
def _(spark, sf):
    """Bronze written before the time column existed, with lost op and ts_ms on the error events."""
    lost = F.col("op") == "d"
    old = users_bronze(spark, sf).drop("event_time")
    old = old.withColumn("ts_ms", F.when(~lost, F.col("ts_ms"))).withColumn("op", F.when(~lost, F.col("op")))
    return changes.backfill(old).select("kafka_offset", "op", "ts_ms", ms("event_time").alias("event_time_ms"))


@query(
    "bronze_window_slice",
    with_(
        "messages",
        """SELECT event_id AS kafka_offset, op, ts_ms FROM messages
WHERE event_type = 'purchase' AND ts_ms BETWEEN 1704844800000 AND 1705708800000""",
    ),
)
def _(spark, sf):
    """2024-01-10 to 2024-01-20, both bounds included."""
    start, end = control.batch_window("2024-01-10 00:00:00", to_ts="2024-01-20 00:00:00")
    rows = control.window_slice(topics_bronze(spark, sf), "cdc.PURCHASE", start, end)
    return rows.select("kafka_offset", "op", "ts_ms")


@query(
    "bronze_profile",
    with_(
        "messages",
        """SELECT concat('cdc.', upper(event_type)) AS table_name, count(*) AS total_records,
       min(ts_ms) AS min_event_ms, max(ts_ms) AS max_event_ms FROM messages GROUP BY event_type""",
    ),
)
def _(spark, sf):
    return changes.profile(topics_bronze(spark, sf)).select(
        "table_name", "total_records", ms("min_event_time").alias("min_event_ms"), ms("max_event_time").alias("max_event_ms")
    )


@query(
    "bronze_latest_n",
    with_(
        "messages",
        """SELECT concat('cdc.', upper(event_type)) AS table_name, op, event_id AS kafka_offset, ts_ms AS event_ms,
       substr(concat('{"op":"', op, '","ts_ms":', ts_ms, ',"before":', CASE WHEN op = 'd' THEN image ELSE 'null' END,
                     ',"after":', CASE WHEN op <> 'd' THEN image ELSE 'null' END, '}'), 1, 100) AS raw_sample
FROM (SELECT *, CASE WHEN faulty AND op = 'd' THEN 'null'
                     ELSE concat('{"ID":', CASE WHEN faulty THEN 'null' ELSE CAST(user_id AS VARCHAR) END,
                                 ',"STATUS":"', event_type, '","AMOUNT":', CAST(value AS VARCHAR), '}') END AS image
      FROM messages) t ORDER BY event_id DESC LIMIT 5""",
    ),
)
def _(spark, sf):
    rows = changes.latest_messages(topics_bronze(spark, sf), 5)
    return rows.select("table_name", "op", "kafka_offset", ms("event_time").alias("event_ms"), "raw_sample")


# -- payload ---------------------------------------------------------------------------------------

_HAS_IMAGE = "NOT (faulty AND op = 'd')"


@query(
    "payload_image",
    with_(
        "messages",
        f"""SELECT event_id AS kafka_offset, {_HAS_IMAGE} AS has_image,
       CASE WHEN {_HAS_IMAGE} THEN event_type END AS status FROM messages""",
    ),
)
def _(spark, sf):
    rows = payload.with_image(users_bronze(spark, sf))
    return rows.select(
        "kafka_offset",
        F.col("image").isNotNull().alias("has_image"),
        F.get_json_object("image", "$.STATUS").alias("status"),
    )


@query(
    "payload_schema_infer",
    with_(
        "messages",
        f"""SELECT f.name AS field_name, f.type AS field_type, count(*) AS images
FROM messages, (VALUES ('ID', 'bigint'), ('STATUS', 'string'), ('AMOUNT', 'double')) AS f(name, type)
WHERE {_HAS_IMAGE} GROUP BY ALL""",
    ),
)
def _(spark, sf):
    """Fields found over all images, with the number of images that were looked at."""
    images = payload.with_image(users_bronze(spark, sf)).select("image")
    schema = payload.infer_schema(images)
    fields = F.explode(
        F.array(
            *[F.struct(F.lit(f.name).alias("field_name"), F.lit(f.dataType.simpleString()).alias("field_type")) for f in schema]
        )
    )
    counted = images.filter("image IS NOT NULL").agg(F.count(F.lit(1)).alias("images"))
    return counted.select(fields.alias("f"), "images").select("f.*", "images")


@query(
    "payload_parse",
    with_(
        "messages",
        f"""SELECT event_id AS kafka_offset, CASE WHEN NOT faulty THEN user_id END AS ID, event_type AS STATUS,
       value AS AMOUNT FROM messages WHERE {_HAS_IMAGE}""",
    ),
)
def _(spark, sf):
    """Schema inferred, then every image parsed and flattened."""
    bronze = users_bronze(spark, sf)
    parsed = payload.parse(bronze, payload.infer_schema(payload.with_image(bronze)))
    return parsed.filter("row IS NOT NULL").select("kafka_offset", "row.*")


_REASON = """CASE WHEN faulty AND op = 'd' THEN 'EMPTY_OR_UNPARSABLE_PAYLOAD'
            WHEN faulty THEN 'MISSING_OR_NULL_PRIMARY_KEY' END"""


@query(
    "dlq_split",
    with_(
        "messages",
        f"""SELECT coalesce({_REASON}, 'VALID') AS outcome, count(*) AS n, CAST(sum(ts_ms) AS BIGINT) AS sum_ms
FROM messages GROUP BY 1""",
    ),
)
def _(spark, sf):
    classified, _ = payload.classify(users_bronze(spark, sf), KEYS, user_schema())
    outcomes = classified.groupBy(F.coalesce("error_reason", F.lit("VALID")).alias("outcome"))
    return whole_sums(outcomes, "ts_ms", "sum_ms")


@query(
    "dlq_records",
    with_(
        "messages",
        f"""SELECT 'cdc.USERS' AS kafka_topic, CAST(part AS INTEGER) AS kafka_partition, event_id AS kafka_offset, op, ts_ms,
       {_REASON} AS error_reason FROM messages WHERE faulty""",
    ),
)
def _(spark, sf):
    """The first ten days are quarantined already; the replay of everything adds only the rest."""
    rejects = payload.split(users_bronze(spark, sf), KEYS, user_schema()).rejects
    earlier = payload.split(days(users_bronze(spark, sf), end="2024-01-11"), KEYS, user_schema()).rejects
    both = earlier.unionByName(payload.new_dead_letters(rejects, earlier))
    return both.drop("raw_value", "quarantined_at")


@query(
    "dlq_lossy_value",
    with_(
        "messages",
        f"""SELECT event_id AS kafka_offset, value <> floor(value) AS as_whole, CAST(CAST(value AS DECIMAL(15, 1)) AS DOUBLE) <> value AS as_tenths
FROM messages WHERE {_HAS_IMAGE} AND NOT faulty AND (value <> floor(value) OR CAST(CAST(value AS DECIMAL(15, 1)) AS DOUBLE) <> value)""",
    ),
)
def _(spark, sf):
    """Amounts that a stored column of whole numbers, or one of tenths, can't hold: rejected, not cut."""
    bronze, found = users_bronze(spark, sf), []
    for name, kind in (("as_whole", "bigint"), ("as_tenths", "decimal(15,1)")):
        target = StructType.fromDDL(f"ID bigint, STATUS string, AMOUNT {kind}")
        classified, _ = payload.classify(bronze, KEYS, user_schema(), target)
        found.append(classified.filter(F.col("error_reason") == payload.TYPE_CONFLICT).select("kafka_offset", F.lit(name).alias("target")))
    targets = F.collect_set("target")
    return found[0].union(found[1]).groupBy("kafka_offset").agg(*[F.array_contains(targets, n).alias(n) for n in ("as_whole", "as_tenths")])


@query(
    "normalize_epochs",
    """SELECT event_id, epoch_us(ts) AS created_us, epoch_us(ts) // 1000 AS updated_ms, epoch_us(ts) // 1000000 AS booking_s,
       user_id AS KIND FROM events""",
)
def _(spark, sf):
    """The same moment as micro-, milli- and seconds; a column without a temporal name stays a number."""
    at = F.col("ts").cast("timestamp")
    rows = domain.table(spark, sf, "events").select(
        "event_id",
        F.unix_micros(at).alias("CREATED_AT"),
        F.unix_millis(at).alias("UPDATED_AT"),
        F.unix_seconds(at).alias("BOOKING_DATE"),
        F.col("user_id").alias("KIND"),
    )
    return normalize_epochs(rows).select(
        "event_id",
        F.unix_micros("CREATED_AT").alias("created_us"),
        F.unix_millis("UPDATED_AT").alias("updated_ms"),
        F.unix_seconds("BOOKING_DATE").alias("booking_s"),
        "KIND",
    )


@query(
    "align_schema",
    """SELECT event_id, CAST(value AS VARCHAR) AS amount, TRY_CAST(event_type AS BIGINT) AS status,
       epoch_us(ts) // 1000 AS seen_ms, user_id AS extra FROM events""",
)
def _(spark, sf):
    """Shared columns take the target's types, text that is no number becomes NULL, others stay."""
    target = StructType.fromDDL("event_id bigint, amount string, status bigint, seen timestamp, missing int")
    rows = domain.table(spark, sf, "events").select(
        "event_id",
        F.col("value").alias("amount"),
        F.col("event_type").alias("status"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("seen"),
        F.col("user_id").alias("extra"),
    )
    return align_to(rows, target).select("event_id", "amount", "status", F.unix_millis("seen").alias("seen_ms"), "extra")


@query(
    "schema_evolve",
    """SELECT event_id, event_type AS STATUS, CASE WHEN event_type = 'purchase' THEN value END AS NEW FROM events""",
)
def _(spark, sf):
    """Only purchases bring the new column."""
    events = domain.table(spark, sf, "events").withColumnRenamed("event_type", "STATUS")
    old = events.filter("STATUS <> 'purchase'").select("event_id", "STATUS")
    new = events.filter("STATUS = 'purchase'").select("event_id", "STATUS", F.col("value").alias("NEW"))
    return evolve_union(old, new)


@query("to_utc", "SELECT event_id, epoch_us(ts) // 1000 - 25200000 AS utc_ms FROM events")
def _(spark, sf):
    """Wall-clock times of a zone seven hours ahead."""
    rows = domain.table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return to_utc(rows, "Asia/Ho_Chi_Minh").select("event_id", F.unix_millis("ts").alias("utc_ms"))


# -- merge -----------------------------------------------------------------------------------------


def last_orders(spark: SparkSession, sf: str, when) -> DataFrame:
    """Last order of each customer among the orders that satisfy ``when``."""
    orders = domain.table(spark, sf, "orders").filter(when)
    last = dedup.latest_per_key(orders, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])
    return last.select(
        F.col("o_custkey").alias("CUSTOMER_ID"),
        F.col("o_orderkey").alias("ORDER_ID"),
        F.col("o_orderstatus").alias("STATUS"),
        F.col("o_orderdate").alias("ORDERED_AT"),
    )


def _last_orders_sql(where: str) -> str:
    return f"""SELECT o_custkey AS CUSTOMER_ID, o_orderkey AS ORDER_ID, o_orderstatus AS STATUS, o_orderdate AS ORDERED_AT
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders WHERE {where}) t WHERE rn = 1"""


_OLD, _NEW = "o_orderdate < TIMESTAMP '2000-01-01'", "o_orderdate >= TIMESTAMP '2000-01-01'"
_ORDER_OUT = "CUSTOMER_ID, ORDER_ID, STATUS, CAST(ORDERED_AT AS VARCHAR) AS ORDERED_AT"


def _old_and_new(spark, sf):
    cut = F.lit("2000-01-01").cast("timestamp_ntz")
    return last_orders(spark, sf, F.col("o_orderdate") < cut), last_orders(spark, sf, F.col("o_orderdate") >= cut)


@query("merge_upsert", f"SELECT {_ORDER_OUT} FROM ({_last_orders_sql('true')}) t")
def _(spark, sf):
    return merge.merge_upsert(*_old_and_new(spark, sf), ["CUSTOMER_ID"])


@query(
    "merge_delete",
    f"""SELECT {_ORDER_OUT} FROM ({_last_orders_sql(_OLD)}) t
WHERE CUSTOMER_ID NOT IN (SELECT CUSTOMER_ID FROM ({_last_orders_sql(_NEW)}) n WHERE STATUS = 'F')""",
)
def _(spark, sf):
    old, new = _old_and_new(spark, sf)
    return merge.merge_delete(old, new.filter("STATUS = 'F'"), ["CUSTOMER_ID"])


@query(
    "merge_close_version",
    f"""SELECT o.CUSTOMER_ID, o.ORDER_ID, CAST(o.ORDERED_AT AS VARCHAR) AS valid_from,
       CASE WHEN n.CUSTOMER_ID IS NULL THEN '9999-12-31 23:59:59' ELSE CAST(n.ORDERED_AT AS VARCHAR) END AS valid_to,
       CASE WHEN n.CUSTOMER_ID IS NULL THEN 1 ELSE 0 END AS is_current
FROM ({_last_orders_sql(_OLD)}) o LEFT JOIN ({_last_orders_sql(_NEW)}) n ON o.CUSTOMER_ID = n.CUSTOMER_ID""",
)
def _(spark, sf):
    old, new = _old_and_new(spark, sf)
    versions = old.select(
        "CUSTOMER_ID",
        "ORDER_ID",
        F.col("ORDERED_AT").alias("valid_from"),
        F.lit(cdc.OPEN_END).cast("timestamp_ntz").alias("valid_to"),
        F.lit(1).alias("is_current"),
    )
    first = new.select("CUSTOMER_ID", F.col("ORDERED_AT").alias("first_event_time"))
    return merge.close_versions(versions, first, ["CUSTOMER_ID"])


_LATEST = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn
      FROM messages WHERE NOT faulty) t WHERE rn = 1"""


@query(
    "dedup_latest",
    with_(
        "messages",
        "SELECT user_id AS ID, event_id AS kafka_offset, op, value AS AMOUNT FROM latest",
        latest=_LATEST,
    ),
)
def _(spark, sf):
    return dedup.dedup_latest(valid_changes(parsed_users(spark, sf)), KEYS).select("ID", "kafka_offset", "op", "AMOUNT")


@query(
    "route_ops",
    with_(
        "messages",
        """SELECT user_id AS ID, CASE WHEN op = 'd' THEN 'delete' ELSE 'upsert' END AS route,
       event_type AS STATUS FROM latest""",
        latest=_LATEST,
    ),
)
def _(spark, sf):
    upserts, deletes = merge.route_ops(dedup.dedup_latest(valid_changes(parsed_users(spark, sf)), KEYS), stamp())
    both = evolve_union(
        upserts.drop("ingested_at").withColumn("route", F.lit("upsert")), deletes.withColumn("route", F.lit("delete"))
    )
    return both.select("ID", "route", "STATUS")


# -- Silver ----------------------------------------------------------------------------------------


@query(
    "silver_value",
    with_(
        "messages",
        "SELECT user_id AS ID, event_type AS STATUS, value AS AMOUNT FROM latest WHERE op <> 'd'",
        latest=_LATEST,
    ),
)
def _(spark, sf):
    """Two batches of whole days, the second with the last days of the first once more."""
    parsed = parsed_users(spark, sf)
    first, second = valid_changes(days(parsed, end="2024-01-16")), valid_changes(days(parsed, "2024-01-12"))
    value = session.stage(merge.apply_value(None, first, KEYS, stamp=stamp()), "value-first")
    return merge.apply_value(value, second, KEYS, stamp=stamp()).select("ID", "STATUS", "AMOUNT")


HISTORY_SQL = with_("history", "SELECT * FROM history")


def history_out(rows: DataFrame) -> DataFrame:
    return rows.select(
        "ID", "STATUS", "AMOUNT", ms("valid_from").alias("from_ms"), ms("valid_to").alias("to_ms"), "is_current"
    )


def full_history(spark: SparkSession, sf: str) -> DataFrame:
    return history.build_history(valid_changes(parsed_users(spark, sf)), KEYS, stamp())


@query("silver_history", HISTORY_SQL)
def _(spark, sf):
    return history_out(history.public_history(full_history(spark, sf)))


@query("silver_history_hot_keys", HISTORY_SQL)
def _(spark, sf):
    """Every key with more than fifty changes takes the sliced path."""
    return history_out(history.public_history(history.build_history(valid_changes(parsed_users(spark, sf)), KEYS, stamp(), hot_rows=50)))


@query("silver_history_incremental", HISTORY_SQL)
def _(spark, sf):
    """Purchases and errors arrive after everything else, so most of them are late; then the last
    week is replayed. The result is that of one complete build."""
    parsed = parsed_users(spark, sf)
    late = F.col("kafka_topic").isin("cdc.PURCHASE", "cdc.ERROR")
    batches = [parsed.filter(~late), parsed.filter(late), days(parsed, "2024-01-24")]
    rows = None
    for number, batch in enumerate(batches):
        rows = history.apply_history(rows, valid_changes(batch), KEYS, stamp=stamp())
        if number + 1 < len(batches):
            rows = session.stage(rows, f"history-{number}")
    return history_out(history.public_history(rows))


@query(
    "history_new_events",
    with_(
        "changes",
        """SELECT ID, event_id AS kafka_offset, ts_ms AS from_ms FROM changes
WHERE event_id NOT IN (SELECT event_id FROM events WHERE ts < TIMESTAMP '2024-01-16')""",
    ),
)
def _(spark, sf):
    parsed = parsed_users(spark, sf)
    stored_rows = history.build_history(valid_changes(days(parsed, end="2024-01-16")), KEYS, stamp())
    candidates = history.event_rows(valid_changes(days(parsed, "2024-01-12")), KEYS, stamp())
    fresh = history.new_events(candidates, session.stage(stored_rows, "history-known"), KEYS)
    return fresh.select("ID", "kafka_offset", ms("valid_from").alias("from_ms"))


@query(
    "history_timeline",
    with_("timeline", "SELECT ID, event_id AS kafka_offset, from_ms, next_ms FROM timeline"),
)
def _(spark, sf):
    chained = history.chain(history.event_rows(valid_changes(parsed_users(spark, sf)), KEYS, stamp()), KEYS)
    return chained.select("ID", "kafka_offset", ms("valid_from").alias("from_ms"), ms("next_time").alias("next_ms"))


@query("history_closed", with_("history", "SELECT * FROM history WHERE is_current = 0"))
def _(spark, sf):
    return history_out(history.closed_versions(full_history(spark, sf)))


@query(
    "history_as_of",
    with_("history", "SELECT * FROM history WHERE from_ms <= 1705320000000 AND to_ms > 1705320000000"),
)
def _(spark, sf):
    """State of all keys at noon of 2024-01-15."""
    return history_out(history.as_of(full_history(spark, sf), F.timestamp_millis(F.lit(1705320000000))))


def bulk_loaded(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Value and history of the orders after the bulk job."""
    registry = {"ORDERS": ["ORDER_ID"]}

    def lake_at(path: str) -> medallion.Lake:
        return medallion.Lake(f"{path}/bronze", f"{path}/silver", f"{path}/quarantine", f"{path}/control")

    def write(path: str) -> None:
        orders = domain.table(spark, sf, "orders").select(
            F.col("o_orderkey").alias("ORDER_ID"),
            F.col("o_orderstatus").alias("STATUS"),
            F.col("o_orderdate").cast("timestamp").alias("ORDERED_AT"),
        )
        at = datetime(2024, 1, 1, tzinfo=timezone.utc)
        medallion.bulk_initial_load({"ORDERS": orders}, lake_at(path), registry, "Asia/Ho_Chi_Minh", at)

    return medallion.silver_tables(spark, lake_at(stored(spark, sf, "bulk", write)), registry)["ORDERS"]


@query(
    "bulk_initial_value",
    """SELECT o_orderkey AS ORDER_ID, o_orderstatus AS STATUS, epoch_us(o_orderdate) // 1000 - 25200000 AS ordered_ms
       FROM orders""",
)
def _(spark, sf):
    value, _ = bulk_loaded(spark, sf)
    return value.select("ORDER_ID", "STATUS", ms("ORDERED_AT").alias("ordered_ms"))


@query(
    "bulk_initial_load",
    """SELECT o_orderkey AS ORDER_ID, o_orderstatus AS STATUS, epoch_us(o_orderdate) // 1000 - 25200000 AS ordered_ms,
       1704067200000 AS from_ms, 253402300799000 AS to_ms, 1 AS is_current FROM orders""",
)
def _(spark, sf):
    """History that the bulk job wrote for the orders, whose times are wall-clock times seven hours ahead."""
    _, rows = bulk_loaded(spark, sf)
    return rows.select(
        "ORDER_ID",
        "STATUS",
        ms("ORDERED_AT").alias("ordered_ms"),
        ms("valid_from").alias("from_ms"),
        ms("valid_to").alias("to_ms"),
        "is_current",
    )
