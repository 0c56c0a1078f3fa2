"""Declared schemas, as DDL, of the logistics domain and of the pipeline's own tables."""

from __future__ import annotations

from pyspark.sql.types import StructType

# Source tables, their columns and keys.
SOURCE_TABLES: dict[str, tuple[list[str], str]] = {
    "DIM_CUSTOMERS": (
        ["CUSTOMER_ID"],
        "CUSTOMER_ID string, CUSTOMER_NAME string, CUSTOMER_TYPE string, TAX_CODE string, "
        "PROVINCE string, REGION string, CREATED_AT timestamp",
    ),
    "DIM_SERVICES": (
        ["SERVICE_ID"],
        "SERVICE_ID string, SERVICE_CODE string, SERVICE_NAME string, IS_INTERNATIONAL int, "
        "CREATED_AT timestamp",
    ),
    "DIM_POS_LOCATIONS": (
        ["POS_CODE"],
        "POS_CODE string, POS_NAME string, PROVINCE_CODE string, PROVINCE_NAME string, "
        "REGION string, POS_LEVEL string, CREATED_AT timestamp",
    ),
    "DIM_WEIGHT_TIERS": (
        ["WEIGHT_TIER_ID"],
        "WEIGHT_TIER_ID string, TIER_NAME string, MIN_WEIGHT_GRAM long, MAX_WEIGHT_GRAM long",
    ),
    "DIM_ROUTING_TYPES": (
        ["ROUTING_TYPE_ID"],
        "ROUTING_TYPE_ID string, ROUTING_CODE string, ROUTING_NAME string",
    ),
    "DIM_DELIVERY_STATUSES": (
        ["STATUS_ID"],
        "STATUS_ID string, STATUS_CODE string, STATUS_NAME string, STATUS_GROUP string",
    ),
    "DIM_FAILURE_REASONS": (
        ["FAILURE_REASON_ID"],
        "FAILURE_REASON_ID string, REASON_CODE string, REASON_NAME string",
    ),
    "SHIPMENT_BOOKINGS": (
        ["BOOKING_ID"],
        "BOOKING_ID string, ITEM_CODE string, BOOKING_DATE timestamp, CUSTOMER_ID string, "
        "SERVICE_ID string, SENDING_POS_CODE string, RECEIVING_POS_CODE string, WEIGHT_GRAM long, "
        "WEIGHT_TIER_ID string, ROUTING_TYPE_ID string, MAIN_FEE decimal(15,2), "
        "SUR_FEE decimal(15,2), DISCOUNT_AMOUNT decimal(15,2), TOTAL_REVENUE decimal(15,2), "
        "COST_AMOUNT decimal(15,2), STATUS_ID string, CREATED_AT timestamp, UPDATED_AT timestamp",
    ),
    "DELIVERY_REMUNERATIONS": (
        ["REMUNERATION_ID"],
        "REMUNERATION_ID string, BOOKING_ID string, COURIER_ID string, DELIVERY_POS_CODE string, "
        "DELIVERY_DATE timestamp, DELIVERY_STATUS_ID string, DELIVERY_FEE_AMOUNT decimal(15,2), "
        "BONUS_AMOUNT decimal(15,2), CREATED_AT timestamp",
    ),
    "RETURN_REMUNERATIONS": (
        ["RETURN_ID"],
        "RETURN_ID string, BOOKING_ID string, COURIER_ID string, RETURN_POS_CODE string, "
        "RETURN_DATE timestamp, FAILURE_REASON_ID string, RETURN_FEE_AMOUNT decimal(15,2), "
        "CREATED_AT timestamp",
    ),
    "SHIPMENT_EVENT_TRACKINGS": (
        ["EVENT_ID"],
        "EVENT_ID string, BOOKING_ID string, EVENT_POS_CODE string, EVENT_TIME timestamp, "
        "STATUS_ID string, OPERATOR_USER string, NOTES string, CREATED_AT timestamp",
    ),
}

TABLE_KEYS: dict[str, list[str]] = {name: keys for name, (keys, _) in SOURCE_TABLES.items()}

CHANGE_MESSAGE = (
    "key string, value string, topic string, partition int, offset long, timestamp timestamp"
)
BRONZE = (
    "kafka_key string, raw_value string, op string, ts_ms long, kafka_topic string, "
    "kafka_partition int, kafka_offset long, kafka_timestamp timestamp, event_time timestamp, "
    "ingested_at timestamp"
)
DLQ = (
    "kafka_topic string, kafka_partition int, kafka_offset long, op string, ts_ms long, "
    "error_reason string, quarantined_at timestamp, raw_value string"
)
WATERMARKS = (
    "table_name string, kafka_partition int, last_processed_ts string, last_processed_offset long, "
    "last_batch_id string, updated_at timestamp"
)
LINEAGE = (
    "batch_id string, table_name string, source_topic string, start_cutoff string, "
    "end_cutoff string, records_read long, records_value_upserted long, "
    "records_history_updated long, records_dlq long, status string, duration_seconds double, "
    "created_at timestamp"
)
PERMISSIONS = (
    "username string, role string, province_access array<string>, updated_at timestamp"
)

def column_names(ddl: str) -> list[str]:
    return [column.split(" ", 1)[0] for column in ddl.split(", ")]


# Columns the change log adds to every payload row; none of them reaches Silver value.
CDC_COLUMNS = ["op", "ts_ms", "kafka_partition", "kafka_offset", "kafka_timestamp", "cdc_event_time"]


def source_schema(table: str) -> StructType:
    return StructType.fromDDL(SOURCE_TABLES[table][1])
