"""Jobs, sinks and streams end to end."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parcelmill import session
from parcelmill.operators import control
from parcelmill.plans import medallion, warehouse
from parcelmill.schemas import CHANGE_MESSAGE
from parcelmill.sinks import tables
from parcelmill.sources import changes, jdbc, lake
from parcelmill.streaming import silver
from parcelmill.streaming.bronze import write_bronze

REGISTRY = {"T": ["ID"], "U": ["A", "B"]}


def messages(spark, *rows):
    """(topic, offset, json)"""
    return spark.createDataFrame([("k", v, t, 0, o, datetime(2024, 1, 1)) for t, o, v in rows], CHANGE_MESSAGE)


def event(op, seconds, **row):
    body = ",".join(f'"{k}":{v}' for k, v in row.items())
    side = "before" if op == "d" else "after"
    return f'{{"op":"{op}","ts_ms":{1704067200000 + seconds * 1000},"{side}":{{{body}}}}}'


@pytest.fixture
def lake_at(tmp_path):
    return medallion.Lake(f"{tmp_path}/bronze", f"{tmp_path}/silver", f"{tmp_path}/dlq", f"{tmp_path}/control")


def append_bronze(spark, lake_, *rows):
    tables.append(changes.to_bronze(messages(spark, *rows)), lake_.bronze, ["kafka_topic"])


def state(spark, lake_, name):
    value, rows = medallion.silver_tables(spark, lake_, REGISTRY)[name]
    return value.count(), rows.filter("is_current = 1").count(), rows.filter("is_current = 0").count()


def test_medallion_runs(spark, lake_at):
    append_bronze(
        spark,
        lake_at,
        ("cdc.T", 1, event("c", 1, ID=1, V=1)),
        ("cdc.T", 2, event("c", 2, ID=2, V=1)),
        ("cdc.T", 3, event("c", 3, ID="null", V=1)),
        ("cdc.U", 1, event("c", 1, A=1, B=1, W=5)),
        ("cdc.U", 2, event("c", 2, A=1, B=2, W=6)),
        ("cdc.OTHER", 1, event("c", 2, A=1)),
    )
    first = {r["table_name"]: r for r in medallion.run_medallion(spark, lake_at, REGISTRY)}
    assert (first["T"]["records_read"], first["T"]["records_dlq"], first["T"]["status"]) == (3, 1, "WARNING_DLQ")
    assert (first["T"]["records_value_upserted"], first["T"]["records_history_updated"]) == (2, 2)
    assert first["U"]["status"] == "SUCCESS"
    assert state(spark, lake_at, "T") == (2, 2, 0) and state(spark, lake_at, "U") == (2, 2, 0)

    # an update, a delete, a late change, and a new column
    append_bronze(
        spark,
        lake_at,
        ("cdc.T", 4, event("u", 10, ID=1, V=2, EXTRA=9)),
        ("cdc.T", 5, event("d", 11, ID=2, V=1)),
    )
    second = {r["table_name"]: r for r in medallion.run_medallion(spark, lake_at, REGISTRY)}
    assert second["T"]["start_cutoff"] == "2024-01-01 00:00:03"
    assert state(spark, lake_at, "T") == (1, 1, 2)
    value, _ = medallion.silver_tables(spark, lake_at, REGISTRY)["T"]
    assert value.select("ID", "V", "EXTRA").first() == (1, 2, 9)

    # the same window again: nothing changes, and quarantine holds each reject once
    before = state(spark, lake_at, "T")
    medallion.run_medallion(spark, lake_at, REGISTRY, "t", from_ts="1970-01-01 00:00:00")
    assert state(spark, lake_at, "T") == before
    assert tables.read_appended(spark, f"{lake_at.quarantine}/dlq_t").count() == 1
    # an old window alone: neither the older row of 1 nor the deleted 2 comes back
    medallion.run_medallion(spark, lake_at, REGISTRY, "T", "1970-01-01 00:00:00", "2024-01-01 00:00:05")
    assert state(spark, lake_at, "T") == before
    value, _ = medallion.silver_tables(spark, lake_at, REGISTRY)["T"]
    assert [tuple(r) for r in value.select("ID", "V", "EXTRA").collect()] == [(1, 2, 9)]
    marks = control.load_watermarks(tables.read_snapshot(spark, lake_at.watermarks))
    (mark,) = marks["T"].values()
    assert mark["last_processed_ts"] == "2024-01-01 00:00:11" and mark["last_processed_offset"] == 5
    assert control.reconcile(medallion.silver_tables(spark, lake_at, REGISTRY)).filter("NOT matches").count() == 0
    assert medallion.run_medallion(spark, lake_at, REGISTRY, "UNREGISTERED") == []
    assert tables.read_appended(spark, lake_at.lineage).count() == 5


def test_rejects_alone_reach_quarantine(spark, lake_at):
    append_bronze(spark, lake_at, ("cdc.T", 1, '{"op":"u","ts_ms":1704067200000,"before":null,"after":null}'), ("cdc.T", 2, "{bad"))
    (record,) = medallion.run_medallion(spark, lake_at, REGISTRY)
    assert (record["records_read"], record["records_dlq"]) == (2, 2)
    assert tables.read_appended(spark, f"{lake_at.quarantine}/dlq_t").count() == 2


def test_bulk_load_then_changes(spark, lake_at):
    snapshot = spark.createDataFrame([(1, 1), (2, 1)], "ID long, V long")
    medallion.bulk_initial_load({"T": snapshot}, lake_at, REGISTRY)
    assert state(spark, lake_at, "T") == (2, 2, 0)
    append_bronze(spark, lake_at, ("cdc.T", 1, event("u", 5, ID=1, V=2)))
    medallion.run_medallion(spark, lake_at, REGISTRY, "T")
    value, active, closed = state(spark, lake_at, "T")
    assert (value, active, closed) == (2, 2, 1)


def test_window_bounds():
    assert control.batch_window(None) == ("1970-01-01 00:00:00", "9999-12-31 23:59:59")
    assert control.batch_window("w", "f", "t") == ("f", "t")
    assert control.batch_window("w") == ("w", "9999-12-31 23:59:59")
    assert control.batch_window("w", "f", full_refresh=True)[0] == "1970-01-01 00:00:00"


def test_window_is_inclusive_and_pruned(spark, lake_at):
    append_bronze(spark, lake_at, *[("cdc.T", i, event("c", i, ID=i)) for i in range(5)], ("cdc.U", 1, event("c", 1, A=1)))
    rows = control.window_slice(
        spark.read.parquet(lake_at.bronze), "cdc.T", "2024-01-01 00:00:01", "2024-01-01 00:00:03"
    )
    assert sorted(r["kafka_offset"] for r in rows.collect()) == [1, 2, 3]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(kafka_topic" in plan and "GreaterThanOrEqual(event_time" in plan


def test_stream_is_exactly_once(spark, tmp_path):
    source = f"{tmp_path}/log"
    messages(spark, ("cdc.T", 1, event("c", 1, ID=1)), ("cdc.U", 1, event("c", 1, A=1))).write.parquet(source)
    stream = changes.read_changes(spark, "parquet", path=source, schema=StructType.fromDDL(CHANGE_MESSAGE))
    out, ckpt = f"{tmp_path}/bronze", f"{tmp_path}/ckpt"
    for expected in (2, 2):
        write_bronze(changes.to_bronze(stream), out, ckpt).awaitTermination()
        assert spark.read.parquet(out).count() == expected
    messages(spark, ("cdc.T", 2, event("u", 2, ID=1))).write.mode("append").parquet(source)
    write_bronze(changes.to_bronze(stream), out, ckpt).awaitTermination()
    rows = spark.read.parquet(out)
    assert rows.count() == 3 and rows.filter("kafka_topic = 'cdc.T'").count() == 2


def test_continuous_trigger(spark, tmp_path):
    source = f"{tmp_path}/log"
    messages(spark, ("cdc.T", 1, event("c", 1, ID=1))).write.parquet(source)
    stream = changes.read_changes(spark, "parquet", path=source, schema=StructType.fromDDL(CHANGE_MESSAGE))
    query = write_bronze(changes.to_bronze(stream), f"{tmp_path}/o", f"{tmp_path}/c", once=False, interval="1 second")
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(f"{tmp_path}/o").count() == 1


def test_log_options():
    options = changes.log_options("broker:9092", "cdc.shop")
    assert options["subscribePattern"] == "cdc.shop.*" and options["startingOffsets"] == "earliest"


def test_jdbc_scan_is_split():
    split = jdbc.SplitColumn("BOOKING_DATE", "2024-01-01", "2025-01-01", 64)
    options = jdbc.jdbc_options("jdbc:x", "S.T", {"user": "u"}, split)
    assert options["fetchsize"] == "20000" and options["numPartitions"] == "64"
    assert options["partitionColumn"] == "BOOKING_DATE" and options["user"] == "u"
    assert "partitionColumn" not in jdbc.jdbc_options("jdbc:x", "S.T", {})


def test_snapshot_switch(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert tables.read_snapshot(spark, path) is None
    for n in range(4):
        old = tables.read_snapshot(spark, path)
        new = spark.range(n, n + 1).toDF("v")
        tables.write_snapshot(new if old is None else old.union(new), path)
    assert tables.read_snapshot(spark, path).count() == 4
    assert tables.prune_snapshots(spark, path, keep=2) == 2
    assert tables.read_snapshot(spark, path).count() == 4


def test_named_collections(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/a/t")
    named = lake.NamedCollections({"gold": f"{tmp_path}/a/"})
    assert named.load(spark, "gold", "t").count() == 3
    with pytest.raises(KeyError):
        named.path("silver")
    with pytest.raises(ValueError):
        lake.path_relation("x`; drop")


def test_warehouse_required_columns_and_versions(spark):
    rows = spark.createDataFrame(
        [("A", "2024-01-01", 1), (None, "2024-01-01", 1), ("B", None, 1), ("C", "2024-01-01", None)],
        "BOOKING_ID string, BOOKING_DATE string, ingested_at int",
    )
    assert [r["BOOKING_ID"] for r in warehouse.loadable(rows).collect()] == ["A"]
    base = spark.createDataFrame(
        [("A", "2024-01-01", 1, 1, "a"), ("A", "2024-02-01", 2, 1, "b"), ("A", "2024-01-01", 2, 2, "c"), ("B", "2024-01-01", 1, 1, "d")],
        "BOOKING_ID string, BOOKING_DATE string, ingested_at int, olap_loaded_at int, v string",
    )
    assert sorted(r["v"] for r in warehouse.final_view(base).collect()) == ["c", "d"]
    per_day = warehouse.final_view(base, ["BOOKING_DATE", "BOOKING_ID"])
    assert sorted(r["v"] for r in per_day.collect()) == ["b", "c", "d"]


def test_shared_dir_comes_from_the_session(spark):
    assert session.shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    staged = session.stage(spark.range(5), "x")
    assert staged.count() == 5 and session.shared_dir(spark) in staged.inputFiles()[0]


def test_late_rows_of_other_partitions_are_not_lost(spark, lake_at):
    def land(partition, *rows):
        messages(spark, *rows).withColumn("partition", F.lit(partition).cast("int")).transform(changes.to_bronze).write.mode(
            "append"
        ).partitionBy("kafka_topic").parquet(lake_at.bronze)

    land(0, ("cdc.T", 7, event("c", 100, ID=1, V=1)))
    medallion.run_medallion(spark, lake_at, REGISTRY)
    land(1, ("cdc.T", 3, event("c", 50, ID=2, V=2)))
    (record,) = medallion.run_medallion(spark, lake_at, REGISTRY)
    assert record["records_read"] == 1 and state(spark, lake_at, "T") == (2, 2, 0)
    held = tables.snapshot_dir(spark, lake_at.table("T", ["ID"]).value)
    assert medallion.run_medallion(spark, lake_at, REGISTRY) == []
    assert tables.snapshot_dir(spark, lake_at.table("T", ["ID"]).value) == held
    # a window leaves the rest for the next run, and a message without a time is read once
    land(0, ("cdc.T", 8, event("u", 130, ID=1, V=3)), ("cdc.T", 9, event("u", 120, ID=1, V=2)), ("cdc.T", 10, '{"op":"u","after":{"ID":1}}'))
    medallion.run_medallion(spark, lake_at, REGISTRY, "T", to_ts="2024-01-01 00:02:05")
    medallion.run_medallion(spark, lake_at, REGISTRY)
    value, _ = medallion.silver_tables(spark, lake_at, REGISTRY)["T"]
    assert {(r["ID"], r["V"]) for r in value.collect()} == {(1, 3), (2, 2)}
    assert medallion.run_medallion(spark, lake_at, REGISTRY) == []


def test_first_load_out_of_order(spark, lake_at):
    append_bronze(
        spark, lake_at,
        ("cdc.T", 1, event("d", 10, ID=1, V=1)), ("cdc.T", 2, event("u", 5, ID=1, V=2)),
        ("cdc.T", 3, event("u", 20, ID=2, V=9)), ("cdc.T", 4, event("u", 15, ID=2, V=8)),
    )
    medallion.run_medallion(spark, lake_at, REGISTRY)
    value, _ = medallion.silver_tables(spark, lake_at, REGISTRY)["T"]
    assert [(r["ID"], r["V"]) for r in value.collect()] == [(2, 9)]
    assert control.reconcile(medallion.silver_tables(spark, lake_at, REGISTRY)).filter("NOT matches").count() == 0


def test_unfit_values_reach_quarantine(spark, lake_at):
    append_bronze(spark, lake_at, ("cdc.T", 1, event("c", 1, ID=1, V=1)))
    medallion.run_medallion(spark, lake_at, REGISTRY)
    append_bronze(spark, lake_at, ("cdc.T", 2, event("u", 2, ID=1, V='"abc"')))
    (record,) = medallion.run_medallion(spark, lake_at, REGISTRY)
    assert record["records_dlq"] == 1 and record["status"] == "WARNING_DLQ"
    (reject,) = tables.read_appended(spark, f"{lake_at.quarantine}/dlq_t").collect()
    assert reject["error_reason"] == "TYPE_CONFLICT" and '"abc"' in reject["raw_value"]
    value, _ = medallion.silver_tables(spark, lake_at, REGISTRY)["T"]
    assert value.first()["V"] == 1


def test_a_value_is_rejected_and_not_cut(spark, lake_at):
    append_bronze(spark, lake_at, ("cdc.T", 1, event("c", 1, ID=1, V=1)))
    medallion.run_medallion(spark, lake_at, REGISTRY)
    append_bronze(spark, lake_at, ("cdc.T", 2, event("u", 2, ID=1, V="1.75")), ("cdc.T", 3, event("u", 3, ID=2, V="2.0")))
    (record,) = medallion.run_medallion(spark, lake_at, REGISTRY)
    assert record["records_dlq"] == 1 and record["status"] == "WARNING_DLQ"
    value, _ = medallion.silver_tables(spark, lake_at, REGISTRY)["T"]
    assert {(r["ID"], r["V"]) for r in value.collect()} == {(1, 1), (2, 2)}


def test_declared_types_reject_what_does_not_fit(spark, lake_at):
    append_bronze(spark, lake_at, ("cdc.T", 1, event("c", 1, ID=1, V='"abc"')), ("cdc.T", 2, event("c", 2, ID=2, V="null")))
    declared = {"T": StructType.fromDDL("ID long, V long")}
    (record,) = medallion.run_medallion(spark, lake_at, REGISTRY, "T", schemas=declared)
    assert (record["records_read"], record["records_dlq"]) == (2, 1)


def test_two_writers_cannot_both_switch(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.write_snapshot(spark.range(1), path)
    last = tables.last_switch(spark, path)
    tables.write_snapshot(spark.range(2), path)
    with pytest.raises(RuntimeError):
        tables.switch(spark, path, "snapshot-other", last)
    assert tables.read_snapshot(spark, path).count() == 2


def test_rows_that_cannot_be_loaded_are_named(spark):
    rows = spark.createDataFrame([("A", None, None), (None, None, None)], "BOOKING_ID string, BOOKING_DATE date, ingested_at timestamp")
    assert sorted(r["error_reason"] for r in warehouse.rejects(rows).collect()) == [
        "MISSING BOOKING_DATE,ingested_at", "MISSING BOOKING_ID,BOOKING_DATE,ingested_at"
    ]


def long_log(spark, rows=12_000):
    """Bronze of one topic whose text packs badly, in one task."""
    text = F.concat_ws("", *[F.sha2(F.concat(F.col("id").cast("string"), F.lit(i)), 256) for i in "abcd"])
    image = F.struct(F.col("id").alias("ID"), text.alias("V"))
    value = F.to_json(F.struct(F.lit("u").alias("op"), F.lit(1704067200000).alias("ts_ms"), image.alias("after")))
    at = F.lit(datetime(2024, 1, 1))
    log = spark.range(0, rows, 1, 1).select(
        F.col("id").cast("string").alias("key"), value.alias("value"), F.lit("cdc.T").alias("topic"),
        F.lit(0).alias("partition"), F.col("id").alias("offset"), at.alias("timestamp"),
    )
    return changes.to_bronze(log)


def shares(rows):
    """Rows by the task that has them and reads their text."""
    found = rows.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max("raw_value"))
    return [r["n"] for r in found.collect()]


def test_one_file_of_messages_is_parsed_by_several_tasks(spark, tmp_path):
    """A log file has row groups that tasks read by themselves, though it is less than Spark gives to two tasks."""
    tables.append(long_log(spark), f"{tmp_path}/log", ["kafka_topic"], tables.LOG_GROUP)
    with medallion.parse_splits(spark):
        parts = shares(spark.read.parquet(f"{tmp_path}/log").select("raw_value"))
    assert sum(parts) == 12_000 and len(parts) > 1


def test_stream_parses_by_small_splits(spark, tmp_path, monkeypatch):
    """The batches of a Silver stream are cut as those of a run are, so that all cores parse a part."""
    seen, table = [], medallion.SilverTable(["ID"], f"{tmp_path}/v", f"{tmp_path}/h", f"{tmp_path}/d")
    monkeypatch.setattr(silver, "apply_batch", lambda batch, table, schema: seen.append(batch.sparkSession.conf.get("spark.sql.files.openCostInBytes")))
    spark.range(10).write.parquet(f"{tmp_path}/in")
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    silver.write_silver(spark.readStream.schema("id long").parquet(f"{tmp_path}/in"), table, f"{tmp_path}/c").awaitTermination()
    assert seen == ["1MB"] and spark.conf.get("spark.sql.files.openCostInBytes") == before
