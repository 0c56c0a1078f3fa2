"""Logistics tables derived from the star-schema and event tables in a folder.

Money is decimal throughout. Every function reads whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmill.operators.dedup import latest_per_key


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _first_day() -> Column:
    return F.lit("1995-01-01").cast("timestamp_ntz")


def provinces(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey)


def pos_locations(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("n_nationkey")
    return provinces(spark, sf).select(
        key.alias("POS_CODE"),
        F.concat(F.lit("POS "), "n_name").alias("POS_NAME"),
        key.alias("PROVINCE_CODE"),
        F.col("n_name").alias("PROVINCE_NAME"),
        F.col("r_name").alias("REGION"),
        F.when(key % 3 == 0, "PROVINCIAL").when(key % 3 == 1, "DISTRICT").otherwise("COMMUNE").alias("POS_LEVEL"),
        _first_day().alias("CREATED_AT"),
        _first_day().alias("ingested_at"),
    )


def customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customer rows; the balance decides on which day the row was last changed."""
    changed = F.date_add(F.lit("1995-01-01").cast("date"), F.floor(F.abs("c_acctbal") / 4).cast("int"))
    return (
        table(spark, sf, "customer")
        .join(provinces(spark, sf), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("CUSTOMER_ID"),
            F.col("c_name").alias("CUSTOMER_NAME"),
            F.col("c_mktsegment").alias("CUSTOMER_TYPE"),
            F.concat(F.lit("TX"), "c_custkey").alias("TAX_CODE"),
            F.col("n_name").alias("PROVINCE"),
            F.col("r_name").alias("REGION"),
            _first_day().alias("CREATED_AT"),
            changed.cast("timestamp_ntz").alias("ingested_at"),
        )
    )


def verified_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers without debt. Bookings of the others have no dimension row."""
    solvent = table(spark, sf, "customer").filter("c_acctbal >= 0").select(F.col("c_custkey").alias("CUSTOMER_ID"))
    return customers(spark, sf).join(solvent, "CUSTOMER_ID", "left_semi")


def services(spark: SparkSession, sf: str) -> DataFrame:
    code = F.col("p_type")
    return (
        table(spark, sf, "part")
        .select("p_type")
        .distinct()
        .select(
            code.alias("SERVICE_ID"),
            F.concat(F.lit("SVC_"), code).alias("SERVICE_CODE"),
            F.concat(F.lit("SVC "), code).alias("SERVICE_NAME"),
            F.when(code == "PROMO", 1).otherwise(0).alias("IS_INTERNATIONAL"),
            _first_day().alias("CREATED_AT"),
            _first_day().alias("ingested_at"),
        )
    )


def delivery_statuses(spark: SparkSession, sf: str) -> DataFrame:
    flag, line = F.col("l_returnflag"), F.col("l_linestatus")
    group = (
        F.when(flag == "R", "FAILED")
        .when(line == "F", "COMPLETED")
        .when(flag == "A", "IN_PROGRESS")
        .otherwise("PENDING")
    )
    return (
        table(spark, sf, "lineitem")
        .select(flag, line)
        .distinct()
        .select(
            F.concat(flag, F.lit("-"), line).alias("STATUS_ID"),
            F.concat(flag, line).alias("STATUS_CODE"),
            F.concat(F.lit("Status "), flag, line).alias("STATUS_NAME"),
            group.alias("STATUS_GROUP"),
            _first_day().alias("ingested_at"),
        )
    )


LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_tax", "l_discount"]


def _last_lines(lines: DataFrame) -> DataFrame:
    """Last version of each (order, line) pair, which may occur several times.

    The lines are dealt by order once, for this and for the join with the orders; no task sorts a whole split of the
    file first. All versions of an order's lines meet in one task, which sorts them on disk if they are many.
    """
    dealt = lines.repartition("l_orderkey")
    return latest_per_key(dealt, ["l_orderkey", "l_linenumber"], [F.col(c).desc() for c in LINE_ORDER])


def _as_bookings(spark: SparkSession, sf: str, lines: DataFrame) -> DataFrame:
    """Attach order, parties and service. Orders meet their customers before the larger line side, and amounts are computed
    after the joins, so that a line is shuffled as it was read.

    The intermediate decimals are as narrow as the amounts allow: up to 18 digits they are plain longs.
    """
    orders = (
        table(spark, sf, "orders")
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "o_custkey", "o_orderdate", "c_nationkey")
    )
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    part = table(spark, sf, "part").select("p_partkey", "p_type")
    price = F.col("l_extendedprice").cast("decimal(11,2)")
    met = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
    )
    priced = (
        met.withColumns(
            {
                "MAIN_FEE": price,
                "SUR_FEE": price * F.col("l_tax").cast("decimal(4,2)"),
                "DISCOUNT_AMOUNT": price * F.col("l_discount").cast("decimal(4,2)"),
            }
        )
        .withColumn("revenue", (F.col("MAIN_FEE") + F.col("SUR_FEE") - F.col("DISCOUNT_AMOUNT")).cast("decimal(15,4)"))
        .withColumn("cost", F.col("revenue") * F.lit("0.65").cast("decimal(2,2)"))
    )
    weight = (F.col("l_quantity") * 1000).cast("bigint")
    return (
        priced.select(
            F.concat(F.lit("BK-"), "l_orderkey", F.lit("-"), "l_linenumber").alias("BOOKING_ID"),
            F.concat(F.lit("EA"), F.lit(100000000) + F.col("l_orderkey") * 10 + F.col("l_linenumber"), F.lit("VN")).alias(
                "ITEM_CODE"
            ),
            F.col("l_shipdate").alias("BOOKING_DATE"),
            F.col("o_custkey").alias("CUSTOMER_ID"),
            F.col("p_type").alias("SERVICE_ID"),
            F.col("s_nationkey").alias("SENDING_POS_CODE"),
            F.col("c_nationkey").alias("RECEIVING_POS_CODE"),
            weight.alias("WEIGHT_GRAM"),
            F.when(weight <= 10000, "LIGHT").otherwise("HEAVY").alias("WEIGHT_TIER_ID"),
            F.lit("ROAD").alias("ROUTING_TYPE_ID"),
            F.col("MAIN_FEE").cast("decimal(15,2)").alias("MAIN_FEE"),
            F.col("SUR_FEE").cast("decimal(18,4)").alias("SUR_FEE"),
            F.col("DISCOUNT_AMOUNT").cast("decimal(18,4)").alias("DISCOUNT_AMOUNT"),
            F.col("revenue").cast("decimal(18,4)").alias("TOTAL_REVENUE"),
            F.col("cost").cast("decimal(18,4)").alias("COST_AMOUNT"),
            F.concat("l_returnflag", F.lit("-"), "l_linestatus").alias("STATUS_ID"),
            F.col("o_orderdate").alias("CREATED_AT"),
            F.col("l_shipdate").alias("UPDATED_AT"),
            F.col("o_orderdate").alias("ingested_at"),
        )
    )


def bookings(spark: SparkSession, sf: str) -> DataFrame:
    """One row per booking: the last version. Versions differ in line columns only, so they are
    reduced before any join, and money is computed for the rows that stay."""
    return _as_bookings(spark, sf, _last_lines(table(spark, sf, "lineitem")))


def driver_shifts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_id").alias("SHIFT_ID"),
        F.col("ts").cast("date").alias("SHIFT_DATE"),
        F.concat(F.lit("DRV-"), "user_id").alias("DRIVER_NAME"),
        F.concat(F.lit("NATION_"), F.col("user_id") % 25).alias("SENDING_PROVINCE"),
        F.col("value").cast("decimal(12,2)").alias("DISTANCE_KM"),
    )


def permissions(spark: SparkSession, sf: str) -> DataFrame:
    """One administrator and one manager per region, one driver per supplier, one account without
    provinces. A manager's list is bounded by the number of provinces."""
    areas = provinces(spark, sf)
    managers = areas.groupBy("r_name").agg(F.sort_array(F.collect_list("n_name")).alias("province_access")).select(
        F.concat(F.lit("manager_"), F.lower("r_name")).alias("username"),
        F.lit("REGIONAL_MANAGER").alias("role"),
        "province_access",
    )
    admins = areas.select("r_name").distinct().select(
        F.concat(F.lit("admin_"), F.lower("r_name")).alias("username"),
        F.lit("ADMIN").alias("role"),
        F.array(F.lit("ALL")).alias("province_access"),
    )
    idle = areas.select("r_name").distinct().select(
        F.concat(F.lit("idle_"), F.lower("r_name")).alias("username"),
        F.lit("REGIONAL_MANAGER").alias("role"),
        F.array().cast("array<string>").alias("province_access"),
    )
    drivers = (
        table(spark, sf, "supplier")
        .join(areas, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(F.lit("driver_"), "s_suppkey").alias("username"),
            F.lit("DRIVER").alias("role"),
            F.array("n_name").alias("province_access"),
        )
    )
    return (
        managers.unionByName(admins)
        .unionByName(idle)
        .unionByName(drivers)
        .withColumn("updated_at", F.lit("2024-01-01").cast("timestamp"))
    )


def change_messages(spark: SparkSession, sf: str, events: DataFrame | None = None, by_type: bool = False) -> DataFrame:
    """Change log over the events: the row is the user's state, the event is the change.

    Values below one stand for faults: such an ``error`` event has no image, any other has no key.
    """
    events = table(spark, sf, "events") if events is None else events
    at = F.col("ts").cast("timestamp")
    op = F.when(F.col("event_type") == "signup", "c").when(F.col("event_type") == "error", "d").otherwise("u")
    faulty = F.col("value") < 1
    image = F.when(
        ~(faulty & (op == "d")),
        F.struct(
            F.when(~faulty, F.col("user_id")).alias("ID"),
            F.col("event_type").alias("STATUS"),
            F.col("value").alias("AMOUNT"),
        ),
    )
    envelope = F.struct(
        op.alias("op"),
        F.unix_millis(at).alias("ts_ms"),
        F.when(op == "d", image).alias("before"),
        F.when(op != "d", image).alias("after"),
    )
    topic = F.concat(F.lit("cdc."), F.upper("event_type")) if by_type else F.lit("cdc.USERS")
    return events.select(
        F.col("user_id").cast("string").alias("key"),
        F.to_json(envelope, {"ignoreNullFields": "false"}).alias("value"),
        topic.alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        at.alias("timestamp"),
    )
