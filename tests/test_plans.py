"""Physical plans: what reaches the scan, what is shuffled, what stays out."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from parcelmill import session
from parcelmill.operators import history, merge
from parcelmill.operators.dedup import latest_per_key
from parcelmill.plans import dashboards, domain, semantic, warehouse
from parcelmill.registry import QUERIES, cdc, gold
from parcelmill.registry.gold import stored_wide
from parcelmill.sinks import tables


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_all_tiles_read_the_bookings_once(spark, sf):
    tiles = dashboards.all_tiles(stored_wide(spark, sf))
    plan = tiles._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "Expand" in plan
    one = {(r.tile, r.member): r.value for r in tiles.filter("tile IN ('region_revenue', 'kpi_margin')").collect()}
    for r in dashboards.chart(stored_wide(spark, sf), "region_revenue").collect():
        assert one["region_revenue", r.sendingRegion] == float(r.totalRevenue)
    assert one["kpi_margin", None] == dashboards.chart(stored_wide(spark, sf), "kpi_margin").first()[0]


def test_sketches_merge_without_counting_twice(spark, sf):
    """Merged sketches of months estimate the customers of all of them, within the stated error."""
    wide = stored_wide(spark, sf)
    sketches = semantic.customer_sketches(wide, warehouse.month(), ["sendingRegion"])
    assert sketches.count() > 50
    about = semantic.unique_customers_approx(sketches).first()[0]
    exact = wide.select("CUSTOMER_ID").distinct().count()
    assert abs(about - exact) <= max(1, semantic.SKETCH_ERROR * exact)


def test_metrics_read_only_their_columns(spark, sf):
    text = plan(QUERIES["metric_revenue"](spark, sf))
    assert "ReadSchema: struct<TOTAL_REVENUE:decimal(18,4)>" in text


def test_row_level_filter_reaches_the_scan(spark, sf):
    text = plan(QUERIES["rls_regional"](spark, sf))
    assert re.search(r"PushedFilters: \[.*In\(SENDING_PROVINCE", text)


def test_date_range_reaches_the_scan(spark, sf):
    text = plan(QUERIES["dash_trend_daily"](spark, sf))
    assert "GreaterThanOrEqual(BOOKING_DATE,1997-01-01)" in text


def test_month_filter_prunes_directories(spark, sf):
    assert re.search(r"PartitionFilters: \[.*booking_month", plan(QUERIES["wh_month_partition"](spark, sf)))


def test_incremental_bound_is_a_pushed_subquery(spark, sf):
    text = plan(QUERIES["wh_incremental"](spark, sf))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ingested_at,ScalarSubquery", text)


def test_dimension_joins_do_not_shuffle_the_fact(spark, sf):
    facts, dims = gold.stored_fact(spark, sf), gold.gold_dims(spark, sf)
    text = plan(gold.gold.wide_bookings(facts, dims))
    assert text.count("BroadcastHashJoin") == 5 and "Exchange hashpartitioning" not in text


def test_large_dimension_is_not_broadcast(spark, sf):
    """Beyond the size limit the same plan shuffles instead."""
    facts, dims = gold.stored_fact(spark, sf), gold.gold_dims(spark, sf)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        text = plan(gold.gold.wide_bookings(facts, dims))
        assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text
        bound = F.lit("2000-01-01").cast("timestamp_ntz")
        affected = plan(gold.gold.affected_facts(facts, dims, dict.fromkeys(["bookings", *gold.gold.REFERENCES], bound)))
        assert "BroadcastHashJoin" not in affected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_latest_per_key_reduces_before_the_shuffle(spark, sf):
    orders = domain.table(spark, sf, "orders")
    text = plan(latest_per_key(orders, ["o_custkey"], [F.col("o_orderdate").desc()]))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_top_k_is_not_a_full_sort(spark, sf):
    assert "TakeOrderedAndProject" in plan(QUERIES["dash_lane_drilldown"](spark, sf))


@pytest.mark.parametrize("name", ["silver_history", "silver_value", "gold_obt", "payload_parse", "dq_series_limit", "rls_regional"])
def test_no_python_and_no_cross_join(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_history_changes_are_the_rows_that_differ(spark, sf):
    parsed = cdc.parsed_users(spark, sf)
    first = session.stage(
        history.build_history(cdc.valid_changes(cdc.days(parsed, end="2024-01-20")), cdc.KEYS, cdc.stamp()), "h"
    )
    later = cdc.valid_changes(cdc.days(parsed, "2024-01-20"))
    changes = history.history_changes(first, later, cdc.KEYS, cdc.stamp())
    merged = merge.merge_upsert(first, changes, [*cdc.KEYS, "valid_from"])
    full = history.apply_history(first, later, cdc.KEYS, stamp=cdc.stamp())
    assert merged.exceptAll(full).isEmpty() and full.exceptAll(merged).isEmpty()
    assert changes.count() < first.count()


def test_merge_is_refused_by_a_format_without_it(spark):
    """The call is well formed; only the format is missing here."""
    spark.sql("CREATE TABLE merge_target (ID INT, V INT) USING parquet")
    try:
        source = spark.createDataFrame([(1, 1, "d")], "ID int, V int, op string")
        with pytest.raises(Exception, match="MERGE"):
            merge.merge_into_table(source.drop("op"), "merge_target", ["ID"]).merge()
    finally:
        spark.sql("DROP TABLE merge_target")


def test_partition_merge_rewrites_only_touched_partitions(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = [(1, 10, "a"), (2, 10, "a"), (3, 20, "a"), (4, 30, "a")]
    tables.append_partitioned(spark.createDataFrame(rows, "ID int, P int, V string"), path, ["P"])
    before = {f for f in spark.read.parquet(path).inputFiles() if "P=20" in f}
    # 2 changes in place, 4 moves from partition 30 to 40, 5 is new
    changed = spark.createDataFrame([(2, 10, "b"), (4, 40, "b"), (5, 40, "b")], "ID int, P int, V string")
    tables.merge_partitions(changed, path, ["ID"], "P")
    after = spark.read.parquet(path)
    got = sorted((r["ID"], r["P"], r["V"]) for r in after.collect())
    assert got == [(1, 10, "a"), (2, 10, "b"), (3, 20, "a"), (4, 40, "b"), (5, 40, "b")]
    assert {f for f in after.inputFiles() if "P=20" in f} == before


def test_partition_merge_with_null_and_odd_names(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = spark.createDataFrame([(1, None), (2, None), (3, "a b/c:d"), (4, "z")], "ID int, P string")
    tables.append_partitioned(rows, path, ["P"])
    changed = spark.createDataFrame([(1, "z"), (3, None)], "ID int, P string")
    tables.merge_partitions(changed, path, ["ID"], "P")
    got = {r["ID"]: r["P"] for r in spark.read.parquet(path).collect()}
    assert got == {1: "z", 2: None, 3: None, 4: "z"}


def test_hot_topic_is_split_by_the_rebalance(spark, tmp_path):
    """A partition that holds most rows is written by several tasks."""
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "64KB")
    try:
        # the hot partition is fed by many map outputs, which is what a split is made of
        rows = spark.range(0, 200_000, 1, 16).select(
            F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 5)).alias("topic"),
            F.sha2(F.col("id").cast("string"), 256).alias("v"),
        )
        tables.append_partitioned(rows, f"{tmp_path}/t", ["topic"])
    finally:
        spark.conf.unset(size)
    files = spark.read.parquet(f"{tmp_path}/t").inputFiles()
    assert sum("topic=hot" in f for f in files) > 1


def test_lines_are_dealt_once(spark, sf):
    """By order, for the last versions and the join with the orders; no sort of a whole split comes before."""
    text = plan(domain.bookings(spark, sf))
    dealt = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert any("l_orderkey" in line for line in dealt) and not any("l_linenumber" in line for line in dealt)
    assert sum("l_orderkey" in line for line in dealt) == 1


def test_small_dimensions_are_joined_after_the_layout(spark):
    """Rows that are laid out carry no column of the small dimensions, and lose none of the result's."""
    at = F.lit("2024-01-01").cast("timestamp_ntz")

    def rows(columns: list[str]):
        return spark.range(3).select(*[(at if c == "ingested_at" else F.col("id")).alias(c) for c in columns])

    facts = rows(["BOOKING_ID", "ITEM_CODE", "BOOKING_DATE", "CUSTOMER_ID", "SERVICE_ID", "SENDING_POS_CODE", "RECEIVING_POS_CODE",
                  "WEIGHT_GRAM", "MAIN_FEE", "SUR_FEE", "DISCOUNT_AMOUNT", "TOTAL_REVENUE", "COST_AMOUNT", "STATUS_ID", "CREATED_AT",
                  "UPDATED_AT", "ingested_at"])
    dims = gold.gold.Dims(**{name: rows(columns) for name, columns in gold.gold.DIM_COLUMNS.items()})
    seen = []

    def check(met):
        seen.extend(met.columns)
        return met.repartitionByRange("BOOKING_DATE")

    laid, plain = gold.gold.wide_bookings(facts, dims, check), gold.gold.wide_bookings(facts, dims)
    assert "CUSTOMER_NAME" in seen and not {"SERVICE_NAME", "SENDING_POS_NAME", "STATUS_NAME"} & set(seen)
    assert laid.columns == plain.columns and sorted(laid.collect()) == sorted(plain.collect())


def test_base_from_clustered_rows_is_sorted_without_a_shuffle(spark, tmp_path):
    rows = spark.range(200).select(
        F.concat(F.lit("B"), F.col("id")).alias("BOOKING_ID"), F.date_add(F.lit("2024-01-01").cast("date"), (199 - F.col("id")).cast("int")).alias("BOOKING_DATE")
    )
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    warehouse.write_base(spark.read.parquet(f"{tmp_path}/in"), f"{tmp_path}/base", clustered=True)
    base = spark.read.parquet(f"{tmp_path}/base")
    assert sorted(base.select("BOOKING_ID", "BOOKING_DATE").collect()) == sorted(rows.collect())
    assert len(base.inputFiles()) == base.select("booking_month").distinct().count()
    for file in base.inputFiles():
        days = [r["BOOKING_DATE"] for r in spark.read.parquet(file).coalesce(1).collect()]
        assert days == sorted(days)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == kept


def test_rejects_are_told_by_the_scan(spark, tmp_path):
    spark.createDataFrame([("a", 1, 2), (None, 1, 2)], "BOOKING_ID string, BOOKING_DATE int, ingested_at int").write.parquet(f"{tmp_path}/w")
    wide = spark.read.parquet(f"{tmp_path}/w")
    assert "Or(" in plan(warehouse.rejects(wide)) and "IsNotNull(BOOKING_ID)" in plan(warehouse.loadable(wide))
    assert [r["error_reason"] for r in warehouse.rejects(wide).collect()] == ["MISSING BOOKING_ID"]


def test_partition_merge_deals_only_new_rows(spark, tmp_path, monkeypatch):
    """Old rows are met by the keys that are replaced, not by the new rows, and aren't dealt by partition again."""
    path, staged = str(tmp_path / "t"), {}
    old = spark.range(200).select(F.col("id").alias("ID"), (F.col("id") % 4).cast("int").alias("P"), F.lit("old").alias("V"))
    tables.append_partitioned(old, path, ["P"])

    def kept(df, label, keep=tables.stage):
        out = keep(df, label)
        staged[label] = (df.inputFiles(), df._jdf.queryExecution().logical().toString(), out.count())
        return out

    monkeypatch.setattr(tables, "stage", kept)
    new = spark.createDataFrame([(1, 2, "new"), (500, 7, "new"), (None, 2, "new")], "ID long, P int, V string")
    gone = spark.createDataFrame([(i,) for i in range(0, 200, 4)] + [(None,)], "ID long")
    tables.merge_partitions(new, path, ["ID"], "P", gone)
    got = sorted((r.ID is None, r.ID or 0, r.P, r.V) for r in spark.read.parquet(path).collect())
    expected = [(False, i, i % 4, "old") for i in range(200) if i % 4 and i != 1] + [(False, 1, 2, "new"), (False, 500, 7, "new"), (True, 0, 2, "new")]
    assert got == sorted(expected)
    assert not (tmp_path / "t" / "P=0").exists()
    files, plan, _ = staged["merge-rows"]
    assert any("/replaced-" in f for f in files) and "rebalance" not in plan.lower()
    assert staged["replaced"][2] == 51


def test_partition_merge_deals_many_small_files_anew(spark, tmp_path):
    path = str(tmp_path / "t")
    for k in range(12):
        tables.append(spark.createDataFrame([(k, 0, "old")], "ID long, P int, V string").coalesce(1), path, ["P"])
    tables.merge_partitions(spark.createDataFrame([(3, 0, "new")], "ID long, P int, V string"), path, ["ID"], "P")
    rows = spark.read.parquet(path)
    assert len(rows.inputFiles()) == 1 and sorted((r.ID, r.V) for r in rows.collect()) == [(k, "new" if k == 3 else "old") for k in range(12)]


def test_lines_are_shuffled_as_they_were_read(spark, sf):
    """Amounts are computed above all joins, so that no shuffle carries them."""
    plan = domain.bookings(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("Join")]
    assert "BK-" in above and plan.count("0.65") == above.count("0.65") > 0


def test_ranges_of_the_booking_table_follow_its_bytes(spark, sf, tmp_path, monkeypatch):
    """Not the session's shuffle partitions, of which one may hold more rows than a task can sort in memory."""
    known = stored_wide(spark, sf)
    monkeypatch.setattr(gold, "RANGE_BYTES", 1 + session.input_bytes(spark, gold.stored_fact_path(spark, sf)) // 9)
    monkeypatch.setattr(gold, "stored", lambda spark, sf, name, write, keep=gold.stored: _fresh(write, tmp_path) if name == "gold-obt" else keep(spark, sf, name, write))
    rows = spark.read.parquet(gold.stored_wide_path(spark, sf))
    assert len(rows.inputFiles()) == 9 and rows.count() == known.count() and rows.exceptAll(known).isEmpty()


def _fresh(write, tmp_path):
    write(str(tmp_path / "obt"))
    return str(tmp_path / "obt")
