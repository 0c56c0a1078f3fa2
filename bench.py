"""Time the headline queries and print one JSON line.

Every query is run to completion into a sink that discards the rows. Tables that queries share (Bronze,
parsed messages, Silver, fact, booking table, warehouse base) are built first, under their own names.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from parcelmill import session
from parcelmill.registry import QUERIES
from parcelmill.registry import cdc, control, gold

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

BUILDS = {
    "build_bronze": cdc.topics_bronze_path,
    "build_gold_fact": gold.stored_fact,
    "build_gold_obt": gold.stored_wide_path,
    "build_warehouse_base": gold.stored_base,
    "build_silver_parse": cdc.parsed_users,
    "build_silver_lake": control.stored_lake,
    "build_bulk_load": cdc.bulk_loaded,
}

HEADLINE = [
    "dash_kpi_revenue", "dash_kpi_customers", "dash_province_finance", "dash_trend_daily", "dash_lane_drilldown",
    "dash_native_filters", "semantic_query", "rls_regional", "dq_series_limit", "dq_where_having", "dq_time_grain",
    "gold_fact", "gold_obt", "gold_obt_incremental", "gold_acceptance", "wh_final_view", "wh_month_partition",
    "bronze_envelope", "bronze_window_slice", "payload_parse", "dlq_split", "merge_upsert", "dedup_latest",
    "silver_value", "silver_history", "silver_history_incremental", "history_as_of", "audit_unique",
    "audit_foreign_key",
]


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    session.tune(spark)
    times: dict[str, float] = {}
    for name, build in BUILDS.items():
        started = time.perf_counter()
        build(spark, SF_DIR)
        times[name] = round(time.perf_counter() - started, 3)
    for name in HEADLINE:
        started = time.perf_counter()
        # the query itself, without the text and rounding that the comparison with SQL adds
        QUERIES[name].__wrapped__(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
