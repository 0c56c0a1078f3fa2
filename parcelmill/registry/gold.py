"""Gold and warehouse queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmill import session
from parcelmill.plans import domain, gold, warehouse
from parcelmill.registry.base import query, stored
from parcelmill.registry.sql import OBT_OUT, obt, with_
from parcelmill.sinks import tables

SPLIT = "2000-01-01"


def silver_dims(spark: SparkSession, sf: str) -> gold.Dims:
    return gold.project_dims(
        gold.Dims(
            domain.customers(spark, sf),
            domain.services(spark, sf),
            domain.pos_locations(spark, sf),
            domain.delivery_statuses(spark, sf),
        )
    )


def gold_dims(spark: SparkSession, sf: str, customers: DataFrame | None = None) -> gold.Dims:
    """Dimensions as written tables, whose sizes the planner knows."""

    def table(name: str) -> DataFrame:
        def write(path: str) -> None:
            getattr(silver_dims(spark, sf), name).write.parquet(path)

        return spark.read.parquet(stored(spark, sf, f"gold-{name}", write))

    dims = {name: table(name) for name in gold.DIM_COLUMNS}
    if customers is not None:
        dims["customers"] = customers
    return gold.Dims(**dims)


def wide(spark: SparkSession, sf: str, customers: DataFrame | None = None) -> DataFrame:
    return gold.wide_bookings(gold.fact(domain.bookings(spark, sf)), gold_dims(spark, sf, customers))


def stored_fact_path(spark: SparkSession, sf: str) -> str:
    def write(path: str) -> None:
        gold.fact(domain.bookings(spark, sf)).write.option("compression", tables.CODEC).parquet(path)

    return stored(spark, sf, "gold-fact", write)


def stored_fact(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(stored_fact_path(spark, sf))


RANGE_BYTES = 8 << 20  # of the fact's files for each range of the denormalised table, whose rows a task sorts in memory


def stored_wide_path(spark: SparkSession, sf: str) -> str:
    """The denormalised table, range-clustered by date: readers prune on file statistics.

    There are as many ranges as the fact has bytes for, whatever the session's number of shuffle partitions: a wide row takes
    many times what it takes in a file, and a range that outgrows its task's memory is spilled whole.
    """

    def write(path: str) -> None:
        facts = stored_fact(spark, sf)
        ranges = 1 + session.input_bytes(spark, stored_fact_path(spark, sf)) // RANGE_BYTES
        rows = gold.wide_bookings(facts, gold_dims(spark, sf), lambda met: met.repartitionByRange(ranges, *warehouse.SORT))
        rows.sortWithinPartitions(*warehouse.SORT).write.option("compression", tables.CODEC).parquet(path)

    return stored(spark, sf, "gold-obt", write)


def stored_wide(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(stored_wide_path(spark, sf))


# -- dimensions and fact ---------------------------------------------------------------------------


@query(
    "gold_dim_customers",
    with_(
        "dim_customers",
        """SELECT CUSTOMER_ID, CUSTOMER_NAME, CUSTOMER_TYPE, TAX_CODE, PROVINCE, REGION,
       CAST(CREATED_AT AS VARCHAR) AS CREATED_AT, CAST(ingested_at AS VARCHAR) AS ingested_at FROM dim_customers""",
    ),
)
def _(spark, sf):
    return silver_dims(spark, sf).customers


@query(
    "gold_dim_services",
    with_(
        "dim_services",
        """SELECT SERVICE_ID, SERVICE_CODE, SERVICE_NAME, IS_INTERNATIONAL,
       CAST(CREATED_AT AS VARCHAR) AS CREATED_AT, CAST(ingested_at AS VARCHAR) AS ingested_at FROM dim_services""",
    ),
)
def _(spark, sf):
    return silver_dims(spark, sf).services


@query(
    "gold_dim_pos",
    with_(
        "dim_pos",
        """SELECT POS_CODE, POS_NAME, PROVINCE_CODE, PROVINCE_NAME, REGION, POS_LEVEL,
       CAST(CREATED_AT AS VARCHAR) AS CREATED_AT, CAST(ingested_at AS VARCHAR) AS ingested_at FROM dim_pos""",
    ),
)
def _(spark, sf):
    return silver_dims(spark, sf).pos


@query(
    "gold_dim_statuses",
    with_(
        "dim_statuses",
        """SELECT STATUS_ID, STATUS_CODE, STATUS_NAME, STATUS_GROUP, CAST(ingested_at AS VARCHAR) AS ingested_at
FROM dim_statuses""",
    ),
)
def _(spark, sf):
    return silver_dims(spark, sf).statuses


FACT_OUT = """BOOKING_ID, ITEM_CODE, CAST(CAST(BOOKING_DATE AS DATE) AS VARCHAR) AS BOOKING_DATE, CUSTOMER_ID, SERVICE_ID,
       SENDING_POS_CODE, RECEIVING_POS_CODE, WEIGHT_GRAM, WEIGHT_TIER_ID, ROUTING_TYPE_ID,
       CAST(MAIN_FEE AS DOUBLE) AS MAIN_FEE, CAST(SUR_FEE AS DOUBLE) AS SUR_FEE,
       CAST(DISCOUNT_AMOUNT AS DOUBLE) AS DISCOUNT_AMOUNT, CAST(TOTAL_REVENUE AS DOUBLE) AS TOTAL_REVENUE,
       CAST(COST_AMOUNT AS DOUBLE) AS COST_AMOUNT, STATUS_ID, CAST(CREATED_AT AS VARCHAR) AS CREATED_AT,
       CAST(UPDATED_AT AS VARCHAR) AS UPDATED_AT, CAST(ingested_at AS VARCHAR) AS ingested_at"""


@query("gold_fact", with_("bookings", f"SELECT {FACT_OUT} FROM bookings"))
def _(spark, sf):
    return gold.fact(domain.bookings(spark, sf))


@query("gold_fact_incremental", with_("bookings", f"SELECT {FACT_OUT} FROM bookings"))
def _(spark, sf):
    """Two loads by order date; the second reads only rows above the first load's newest stamp."""
    silver = session.stage(domain.bookings(spark, sf), "silver-bookings")
    first = session.stage(gold.fact(silver.filter(F.col("ingested_at") < SPLIT)), "fact-first")
    return gold.refresh_fact(first, silver)


@query("gold_fact_partition_merge", with_("bookings", f"SELECT {FACT_OUT} FROM bookings"))
def _(spark, sf):
    """The same two loads into a table partitioned by booking month: the second rewrites only the
    months of new bookings."""
    path = session.scratch_path(spark, "fact-by-month")
    silver = stored_fact(spark, sf)
    by_month = silver.withColumn("booking_month", warehouse.month())
    tables.append_partitioned(by_month.filter(F.col("ingested_at") < SPLIT), path, ["booking_month"])
    fresh = gold.newer_than(by_month, spark.read.parquet(path))
    tables.merge_partitions(fresh, path, gold.BOOKING_KEY, "booking_month")
    return spark.read.parquet(path).drop("booking_month")


# -- denormalised table ----------------------------------------------------------------------------


@query("gold_obt", obt(f"SELECT {OBT_OUT} FROM obt"))
def _(spark, sf):
    return wide(spark, sf)


@query("gold_obt_missing_dims", with_("obt_verified", f"SELECT {OBT_OUT} FROM obt_verified"))
def _(spark, sf):
    """Outer-join misses: customers in debt have no dimension row."""
    return wide(spark, sf, domain.verified_customers(spark, sf))


def _early(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, gold.Dims, dict[str, Column]]:
    """The table as of the first load, the inputs of the second, and how far the first had read each of them. Customers
    changed since the first load were not known to it."""
    facts, dims = stored_fact(spark, sf), gold_dims(spark, sf)
    read = {"bookings": facts, **{part: getattr(dims, part) for part in gold.REFERENCES}}
    read |= {part: read[part].filter(F.col("ingested_at") < SPLIT) for part in ("bookings", "customers")}
    old_dims = gold.Dims(**{part: read[part] for part in gold.REFERENCES})
    first = gold.wide_bookings(read["bookings"], old_dims)
    return session.stage(first, "obt-first"), facts, dims, {part: gold.stamp_bound(rows) for part, rows in read.items()}


@query(
    "gold_obt_affected",
    with_(
        "bookings dim_customers",
        """SELECT BOOKING_ID FROM bookings
WHERE ingested_at > (SELECT max(ingested_at) FROM bookings WHERE ingested_at < TIMESTAMP '2000-01-01')
   OR CUSTOMER_ID IN (SELECT CUSTOMER_ID FROM dim_customers
                      WHERE ingested_at > (SELECT max(ingested_at) FROM dim_customers WHERE ingested_at < TIMESTAMP '2000-01-01'))""",
    ),
)
def _(spark, sf):
    _, facts, dims, bounds = _early(spark, sf)
    return gold.affected_facts(facts, dims, bounds).select("BOOKING_ID")


@query("gold_obt_incremental", obt(f"SELECT {OBT_OUT} FROM obt"))
def _(spark, sf):
    first, facts, dims, bounds = _early(spark, sf)
    return gold.refresh_wide_bookings(first, facts, dims, bounds)


@query(
    "gold_delete_propagation",
    obt(
        f"""SELECT {OBT_OUT} FROM obt
WHERE BOOKING_ID NOT IN (SELECT BOOKING_ID FROM bookings WHERE STATUS_ID = 'R-F')"""
    ),
)
def _(spark, sf):
    """Returned bookings are deleted in Silver; they leave the denormalised table too."""
    remaining = stored_fact(spark, sf).filter("STATUS_ID <> 'R-F'")
    return gold.drop_deleted(stored_wide(spark, sf), remaining)


@query(
    "gold_acceptance",
    obt(
        """SELECT count(*) AS total_obt, count(DISTINCT CUSTOMER_ID) AS unique_customers,
       round(CAST(sum(TOTAL_REVENUE) AS DOUBLE), 4) AS total_revenue,
       round(CAST(sum(PROFIT_AMOUNT) AS DOUBLE), 4) AS total_profit FROM obt"""
    ),
)
def _(spark, sf):
    return gold.acceptance(stored_wide(spark, sf))


# -- warehouse -------------------------------------------------------------------------------------

FIRST_LOAD, SECOND_LOAD = "2024-01-01 00:00:00", "2024-01-02 00:00:00"


@query(
    "wh_load",
    with_(
        "obt_verified",
        f"""SELECT {OBT_OUT}, '2024-01-01 00:00:00' AS olap_loaded_at
FROM obt_verified WHERE CUSTOMER_ID IS NOT NULL""",
    ),
)
def _(spark, sf):
    """Rows without a required column stay out; here the key is missing for unknown customers."""
    rows = wide(spark, sf, domain.verified_customers(spark, sf))
    keyed = rows.withColumn("BOOKING_ID", F.when(F.col("CUSTOMER_ID").isNotNull(), F.col("BOOKING_ID")))
    return warehouse.loadable(keyed, F.lit(FIRST_LOAD))


@query(
    "wh_incremental",
    obt(
        """SELECT BOOKING_ID, CAST(ingested_at AS VARCHAR) AS ingested_at FROM obt
WHERE ingested_at >= (SELECT max(ingested_at) FROM obt WHERE ingested_at < TIMESTAMP '2000-01-01')"""
    ),
)
def _(spark, sf):
    rows = stored_wide(spark, sf)
    base = warehouse.loadable(rows.filter(F.col("ingested_at") < SPLIT), F.lit(FIRST_LOAD))
    return warehouse.incremental(rows, base).select("BOOKING_ID", "ingested_at")


def stored_base(spark: SparkSession, sf: str) -> str:
    """Warehouse base after two appends. The second starts at the newest loaded stamp, so the rows at
    that stamp are there twice; those of them that failed since carry no weight in their old version."""

    def write(path: str) -> None:
        rows = stored_wide(spark, sf)
        old = rows.filter(F.col("ingested_at") < SPLIT).withColumn("WEIGHT_GRAM", F.lit(0).cast("long"))
        warehouse.write_base(warehouse.loadable(old, F.lit(FIRST_LOAD)), path, clustered=True)
        fresh = warehouse.incremental(rows, spark.read.parquet(path))
        warehouse.write_base(warehouse.loadable(fresh, F.lit(SECOND_LOAD)), path, clustered=True)

    return stored(spark, sf, "warehouse-base", write)


_BASE = dict(
    base="""SELECT BOOKING_ID, BOOKING_DATE, ingested_at, 0 AS WEIGHT_GRAM, '2024-01-01 00:00:00' AS olap_loaded_at
FROM obt WHERE ingested_at < TIMESTAMP '2000-01-01'
UNION ALL
SELECT BOOKING_ID, BOOKING_DATE, ingested_at, WEIGHT_GRAM, '2024-01-02 00:00:00'
FROM obt WHERE ingested_at >= (SELECT max(ingested_at) FROM obt WHERE ingested_at < TIMESTAMP '2000-01-01')"""
)


@query(
    "wh_append",
    with_(
        "obt",
        """SELECT olap_loaded_at, count(*) AS rows_loaded, CAST(sum(WEIGHT_GRAM) AS BIGINT) AS weight_gram
FROM base GROUP BY olap_loaded_at""",
        **_BASE,
    ),
)
def _(spark, sf):
    base = spark.read.parquet(stored_base(spark, sf))
    return base.groupBy("olap_loaded_at").agg(
        F.count(F.lit(1)).alias("rows_loaded"), F.sum("WEIGHT_GRAM").alias("weight_gram")
    )


@query(
    "wh_month_partition",
    with_(
        "obt",
        """SELECT CAST(strftime(BOOKING_DATE, '%Y%m') AS INTEGER) AS booking_month, count(*) AS rows_loaded
FROM base WHERE CAST(strftime(BOOKING_DATE, '%Y%m') AS INTEGER) BETWEEN 199701 AND 199712 GROUP BY 1""",
        **_BASE,
    ),
)
def _(spark, sf):
    """The month filter prunes directories."""
    base = spark.read.parquet(stored_base(spark, sf))
    return (
        base.filter("booking_month BETWEEN 199701 AND 199712")
        .groupBy("booking_month")
        .agg(F.count(F.lit(1)).alias("rows_loaded"))
    )


@query(
    "wh_final_view",
    with_(
        "obt",
        """SELECT BOOKING_ID, CAST(BOOKING_DATE AS VARCHAR) AS BOOKING_DATE, WEIGHT_GRAM,
       CAST(ingested_at AS VARCHAR) AS ingested_at, olap_loaded_at
FROM (SELECT *, row_number() OVER (PARTITION BY BOOKING_ID ORDER BY ingested_at DESC, olap_loaded_at DESC) AS rn
      FROM base) t WHERE rn = 1""",
        **_BASE,
    ),
)
def _(spark, sf):
    view = warehouse.publish(spark, stored_base(spark, sf), "obt_shipment_analytics")
    return view.select("BOOKING_ID", "BOOKING_DATE", "WEIGHT_GRAM", "ingested_at", "olap_loaded_at")
