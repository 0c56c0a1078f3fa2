"""Gold: conformed dimensions, typed fact, and the denormalised booking table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmill.operators.merge import merge_upsert

DIM_COLUMNS = {
    "customers": [
        "CUSTOMER_ID", "CUSTOMER_NAME", "CUSTOMER_TYPE", "TAX_CODE", "PROVINCE", "REGION", "CREATED_AT", "ingested_at",
    ],
    "services": ["SERVICE_ID", "SERVICE_CODE", "SERVICE_NAME", "IS_INTERNATIONAL", "CREATED_AT", "ingested_at"],
    "pos": [
        "POS_CODE", "POS_NAME", "PROVINCE_CODE", "PROVINCE_NAME", "REGION", "POS_LEVEL", "CREATED_AT", "ingested_at",
    ],
    "statuses": ["STATUS_ID", "STATUS_CODE", "STATUS_NAME", "STATUS_GROUP", "ingested_at"],
}

BOOKING_KEY = ["BOOKING_ID"]
NEVER = "1900-01-01"


@dataclass(frozen=True)
class Dims:
    customers: DataFrame
    services: DataFrame
    pos: DataFrame
    statuses: DataFrame


def project_dims(silver: Dims) -> Dims:
    """Gold dimensions: fixed select lists over Silver."""
    return Dims(*[getattr(silver, f.name).select(*DIM_COLUMNS[f.name]) for f in fields(Dims)])


def fact(silver_bookings: DataFrame) -> DataFrame:
    """Typed fact. Money stays decimal, so that sums are exact; callers cast at the edge."""
    money = ["MAIN_FEE", "SUR_FEE", "DISCOUNT_AMOUNT", "TOTAL_REVENUE", "COST_AMOUNT"]
    return silver_bookings.select(
        "BOOKING_ID",
        "ITEM_CODE",
        F.col("BOOKING_DATE").cast("date").alias("BOOKING_DATE"),
        "CUSTOMER_ID",
        "SERVICE_ID",
        "SENDING_POS_CODE",
        "RECEIVING_POS_CODE",
        F.col("WEIGHT_GRAM").try_cast("bigint").alias("WEIGHT_GRAM"),
        "WEIGHT_TIER_ID",
        "ROUTING_TYPE_ID",
        *[F.col(m).try_cast("decimal(18,4)").alias(m) for m in money],
        "STATUS_ID",
        "CREATED_AT",
        "UPDATED_AT",
        "ingested_at",
    )


def newer_than(source: DataFrame, target: DataFrame, inclusive: bool = False) -> DataFrame:
    """Source rows above the target's highest stamp; the bound is a scalar subquery that is pushed
    into the source scan."""
    bound, at = stamp_bound(target), F.col("ingested_at")
    return source.filter(at >= bound if inclusive else at > bound)


def refresh_fact(current: DataFrame, silver_bookings: DataFrame) -> DataFrame:
    return merge_upsert(current, fact(newer_than(silver_bookings, current)), BOOKING_KEY)


def _role(dim: DataFrame, key: str, on: str, columns: dict[str, str], stamp: str) -> DataFrame:
    return dim.select(
        F.col(key).alias(on), *[F.col(c).alias(a) for c, a in columns.items()], F.col("ingested_at").alias(stamp)
    )


def _roles(dims: Dims) -> list[tuple[str, DataFrame, str]]:
    """(fact column, dimension in that role, name of its stamp) for every foreign key."""

    def pos(prefix: str, stamp: str):
        names = {
            "POS_CODE": f"{prefix}_POS_CODE",
            "POS_NAME": f"{prefix}_POS_NAME",
            "PROVINCE_NAME": f"{prefix}_PROVINCE",
            "REGION": f"{prefix}_REGION",
        }
        return _role(dims.pos, "POS_CODE", f"_{prefix}", names, stamp)

    customers = {
        "CUSTOMER_ID": "CUSTOMER_ID",
        "CUSTOMER_NAME": "CUSTOMER_NAME",
        "CUSTOMER_TYPE": "CUSTOMER_TYPE",
        "PROVINCE": "CUSTOMER_PROVINCE",
        "REGION": "CUSTOMER_REGION",
    }
    services = {c: c for c in ["SERVICE_ID", "SERVICE_CODE", "SERVICE_NAME", "IS_INTERNATIONAL"]}
    statuses = {c: c for c in ["STATUS_ID", "STATUS_CODE", "STATUS_NAME", "STATUS_GROUP"]}
    return [
        ("CUSTOMER_ID", _role(dims.customers, "CUSTOMER_ID", "_CUSTOMER", customers, "_at_c"), "_at_c"),
        ("SERVICE_ID", _role(dims.services, "SERVICE_ID", "_SERVICE", services, "_at_s"), "_at_s"),
        ("SENDING_POS_CODE", pos("SENDING", "_at_sp"), "_at_sp"),
        ("RECEIVING_POS_CODE", pos("RECEIVING", "_at_rp"), "_at_rp"),
        ("STATUS_ID", _role(dims.statuses, "STATUS_ID", "_STATUS", statuses, "_at_st"), "_at_st"),
    ]


FACT_PART = [
    "BOOKING_ID", "ITEM_CODE", "BOOKING_DATE", "WEIGHT_GRAM", "MAIN_FEE", "SUR_FEE", "DISCOUNT_AMOUNT",
    "TOTAL_REVENUE", "COST_AMOUNT", "PROFIT_AMOUNT", "CREATED_AT", "UPDATED_AT",
]


def wide_bookings(facts: DataFrame, dims: Dims, deal: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Fact left-joined with five dimension roles; keys without a dimension row become NULL.

    The row's stamp is the newest among the fact row and its dimension rows, so a dimension-only
    change reaches every consumer that filters on the stamp. Dimensions are unique on their key and
    carry no hint: Spark broadcasts those under its size limit, and splits a hot foreign key on the
    fact side of any other.

    ``deal`` lays out the rows by columns of the fact, for the table that they are written to. That is done once they have
    met the customers, the dimension that grows; the columns of the others, which are joined after that, aren't shuffled.
    """
    foreign = {c: f"_fk_{i}" for i, (c, _, _) in enumerate(_roles(dims))}
    joined = facts.withColumnsRenamed(foreign)
    stamps, added = [F.col("ingested_at")], []
    for column, dim, stamp in _roles(dims):
        on = dim.columns[0]
        joined = joined.join(dim, F.col(foreign[column]) == F.col(on), "left").drop(on)
        stamps.append(F.col(stamp))
        added += [c for c in dim.columns[1:] if c != stamp]
        if deal and column == DIM_KEYS["customers"]:
            joined = deal(joined)
    return (
        joined.withColumn("PROFIT_AMOUNT", (F.col("TOTAL_REVENUE") - F.col("COST_AMOUNT")).cast("decimal(18,4)"))
        .withColumn("ingested_at", F.greatest(*stamps))
        .select(*FACT_PART, *added, "ingested_at")
    )


# the fact columns that refer to each dimension, and the key of the dimension
REFERENCES = {
    "customers": ["CUSTOMER_ID"],
    "services": ["SERVICE_ID"],
    "pos": ["SENDING_POS_CODE", "RECEIVING_POS_CODE"],
    "statuses": ["STATUS_ID"],
}
DIM_KEYS = {"customers": "CUSTOMER_ID", "services": "SERVICE_ID", "pos": "POS_CODE", "statuses": "STATUS_ID"}


def touched_facts(facts: DataFrame, keys: dict[str, DataFrame], also: Column | None = None) -> DataFrame:
    """Facts of which any of these columns holds one of the keys given for it, and those for which ``also`` holds.

    Each is a left join with distinct keys, whose side is broadcast or shuffled by its size at run time.
    """
    marked, hit = facts, F.lit(False) if also is None else F.coalesce(also, F.lit(False))
    for i, (column, wanted) in enumerate(keys.items()):
        mark = wanted.select(F.col(wanted.columns[0]).alias(f"_k{i}")).distinct().withColumn(f"_m{i}", F.lit(True))
        marked = marked.join(mark, F.col(column) == F.col(f"_k{i}"), "left")
        hit = hit | F.coalesce(F.col(f"_m{i}"), F.lit(False))
    return marked.filter(hit).select(*facts.columns)


def affected_facts(facts: DataFrame, dims: Dims, bounds: dict[str, Column]) -> DataFrame:
    """Facts that are newer than their own bound, or refer to a dimension row that is newer than its dimension's.

    ``bounds`` has the stamp up to which each source was read: of ``bookings`` and of each dimension. A source without
    one counts as wholly new. The stamps of the sources aren't compared with each other.
    """

    def newer(rows: DataFrame, part: str) -> DataFrame:
        return rows.filter(F.col("ingested_at") > bounds[part]) if part in bounds else rows

    keys = {BOOKING_KEY[0]: newer(facts, "bookings").select(*BOOKING_KEY)}
    for part, columns in REFERENCES.items():
        changed = newer(getattr(dims, part), part).select(DIM_KEYS[part])
        keys |= {column: changed for column in columns}
    return touched_facts(facts, keys)


def stamp_bound(target: DataFrame) -> Column:
    stamp = target.schema["ingested_at"].dataType
    return target.agg(F.coalesce(F.max("ingested_at"), F.lit(NEVER).cast(stamp)).alias("bound")).scalar()


def refresh_wide_bookings(current: DataFrame, facts: DataFrame, dims: Dims, bounds: dict[str, Column]) -> DataFrame:
    """Incremental rebuild: affected facts are joined again and merged by booking."""
    changed = affected_facts(facts, dims, bounds)
    return merge_upsert(current, wide_bookings(changed, dims), BOOKING_KEY)


def drop_deleted(target: DataFrame, silver_bookings: DataFrame) -> DataFrame:
    """Remove bookings that Silver no longer holds."""
    return target.join(silver_bookings.select(*BOOKING_KEY), BOOKING_KEY, "left_semi")


def acceptance(wide: DataFrame) -> DataFrame:
    return wide.agg(
        F.count(F.lit(1)).alias("total_obt"),
        F.count_distinct("CUSTOMER_ID").alias("unique_customers"),
        F.sum("TOTAL_REVENUE").cast("double").alias("total_revenue"),
        F.sum("PROFIT_AMOUNT").cast("double").alias("total_profit"),
    )

