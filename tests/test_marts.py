"""Gold and warehouse jobs on written tables."""

from __future__ import annotations

import dataclasses

import pytest
from pyspark.sql import functions as F

from parcelmill import session
from parcelmill.plans import marts, medallion
from parcelmill.registry import base
from parcelmill.registry.marts import REGISTRY, refreshed_marts, stored_marts
from parcelmill.sinks import tables
from parcelmill.sources import changes


def test_view_equals_gold(spark, sf):
    """The warehouse's last versions are the rows of the booking table; deleted and moved ones left a mark."""
    _, out = stored_marts(spark, sf)
    wide = spark.read.parquet(out.wide)
    view = marts.current_bookings(spark, out).select(*wide.columns)
    assert view.count() == wide.count() == wide.select("BOOKING_ID").distinct().count() > 0
    assert view.exceptAll(wide).isEmpty()
    assert spark.read.parquet(out.left).count() > 0


def test_nothing_new_writes_nothing(spark, sf):
    lake, out = stored_marts(spark, sf)
    before = set(spark.read.parquet(out.wide).inputFiles())
    assert marts.run_gold(spark, lake, out, REGISTRY) == []
    assert set(spark.read.parquet(out.wide).inputFiles()) == before


def test_bounds_are_kept_by_source(spark, sf):
    lake, out = stored_marts(spark, sf)
    bounds = {r["source"]: r["bound"] for r in tables.read_snapshot(spark, out.bounds).collect()}
    assert set(bounds) == set(marts.SILVER)
    for part, name in marts.SILVER.items():
        rows = tables.read_snapshot(spark, lake.table(name, REGISTRY[name]).history)
        assert bounds[part] == rows.agg(F.unix_micros(F.max("ingested_at"))).first()[0]


def test_month_filter_reaches_the_partitions(spark, sf):
    _, out = stored_marts(spark, sf)
    year = marts.current_bookings(spark, out).filter("booking_month BETWEEN 199701 AND 199712").select("BOOKING_ID")
    plan = year._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert "booking_month" in filters and "199701" in filters


def _counts(spark, out):
    return {t: spark.read.parquet(getattr(out, t)).count() for t in ("base", "ledger")}


def test_full_refresh_equals_gold(spark, sf):
    """After a full refresh the view is the booking table, and only what changed was loaded again."""
    _, out = refreshed_marts(spark, sf)
    wide, base = spark.read.parquet(out.wide), spark.read.parquet(out.base)
    view = marts.current_bookings(spark, out).select(*wide.columns)
    assert view.count() == wide.count() > 0 and view.exceptAll(wide).isEmpty()
    assert view.agg(F.sum("TOTAL_REVENUE")).first() == wide.agg(F.sum("TOTAL_REVENUE")).first()
    assert base.filter("gold_run = 2 AND NOT is_deleted").count() == wide.filter("gold_run = 2").count()
    assert 0 < spark.read.parquet(out.left).count() == base.filter("gold_run = 2 AND is_deleted").count()


def test_a_refresh_without_changes_loads_nothing(spark, sf, monkeypatch):
    lake, out = refreshed_marts(spark, sf)
    before = spark.read.parquet(out.base).count()
    assert marts.run_gold(spark, lake, out, REGISTRY, full_refresh=True)
    # a load that dies before its ledger row leaves no double, and neither does one that has nothing to load
    with monkeypatch.context() as dying:
        dying.setattr(tables, "append_compacted", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            marts.load_warehouse(spark, out)
    assert marts.load_warehouse(spark, out) == [3]
    assert marts.load_warehouse(spark, out) == []
    assert spark.read.parquet(out.base).count() == before


def test_a_load_that_dies_is_run_again(spark, sf, monkeypatch):
    _, out = refreshed_marts(spark, sf)
    marts.load_warehouse(spark, out)
    before = _counts(spark, out)
    copy = dataclasses.replace(out, warehouse=f"{out.warehouse}-again")
    with monkeypatch.context() as dying:
        dying.setattr(tables, "append_compacted", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            marts.load_warehouse(spark, copy)
    marts.load_warehouse(spark, copy)
    assert marts.load_warehouse(spark, copy) == []
    keys = ["BOOKING_ID", "booking_month", "gold_run"]
    base = spark.read.parquet(copy.base)
    assert base.select(*keys).distinct().count() == base.count() <= before["base"]
    assert marts.current_bookings(spark, copy).count() == spark.read.parquet(out.wide).count()


def test_difference_of_tables(spark):
    """Rows that stay keep their run; changed, new and moved ones get the new; gone and moved ones leave a mark."""
    kind = "BOOKING_ID long, booking_month int, v string"
    old = spark.createDataFrame([(1, 1, "a", 1), (2, 1, None, 1), (3, 1, "c", 1), (4, None, "d", 1), (5, 2, "e", 1), (6, 2, None, 1)], f"{kind}, gold_run long")
    new = spark.createDataFrame([(1, 1, "a"), (2, 1, None), (3, 2, "c"), (4, None, "x"), (6, 2, "f"), (7, 3, None)], kind)
    rows, left = marts.difference(old, new, 9)
    assert sorted(map(tuple, rows.select("BOOKING_ID", "gold_run").collect())) == [(1, 1), (2, 1), (3, 9), (4, 9), (6, 9), (7, 9)]
    assert sorted(map(tuple, left.select("BOOKING_ID", "booking_month").collect())) == [(3, 1), (5, 2)]


def test_merge_deletes_and_drops_empty_partitions(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = spark.createDataFrame([(1, "a", 10), (2, "b", 10), (3, "c", 20), (4, "d", 30)], "k int, v string, p int")
    tables.append(rows, path, ["p"])
    kept = {f for f in spark.read.parquet(path).inputFiles() if "p=30" in f}
    new = spark.createDataFrame([(1, "z", 20)], "k int, v string, p int")
    tables.merge_partitions(new, path, ["k"], "p", spark.createDataFrame([(3,), (9,)], "k int"))
    got = spark.read.parquet(path)
    assert sorted(map(tuple, got.select("k", "v", "p").collect())) == [(1, "z", 20), (2, "b", 10), (4, "d", 30)]
    assert kept <= set(got.inputFiles())


def test_marts_leave_one_copy_of_silver_on_disk(spark, sf):
    """Of Silver the current snapshots alone are left, and none of the tables that batches write aside."""
    lake, _ = stored_marts(spark, sf)
    jvm = spark.sparkContext._jvm
    for name, keys in REGISTRY.items():
        for path in (lake.table(name, keys).value, lake.table(name, keys).history):
            folder = jvm.org.apache.hadoop.fs.Path(path)
            names = [s.getPath().getName() for s in folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)]
            assert len([n for n in names if n.startswith("snapshot-")]) == 1
            assert tables.read_snapshot(spark, path).count() > 0


def test_a_later_batch_leaves_nothing_aside(spark, tmp_path, monkeypatch):
    """The events of the reopened tails go once the versions derived from them are written."""
    monkeypatch.setattr(session, "shared_dir", lambda spark: f"file://{tmp_path}/aside")
    table = medallion.SilverTable(["ID"], f"{tmp_path}/value", f"{tmp_path}/history", f"{tmp_path}/dlq")
    for n, state in enumerate(("a", "b", "c")):
        row = '{"op":"u","ts_ms":%d,"before":null,"after":{"ID":1,"STATUS":"%s"}}' % (1_704_067_200_000 + n * 1000, state)
        messages = spark.createDataFrame([("1", row, "cdc.T", 0, n)], "key string, value string, topic string, partition int, offset long")
        batch = changes.to_bronze(messages.withColumn("timestamp", F.lit("2024-01-01").cast("timestamp")))
        medallion.apply_batch(batch, table)
    assert [r.STATUS for r in tables.read_snapshot(spark, table.history).orderBy("valid_from").collect()] == ["a", "b", "c"]
    assert [r.STATUS for r in tables.read_snapshot(spark, table.value).collect()] == ["c"]
    assert not [p for p in (tmp_path / "aside").glob("*/*")]


def test_stored_tables_leave_no_shuffle_files(spark, sf):
    """Settings of the jobs that write shared tables; they are as they were afterwards."""
    names = ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.parquet.compression.codec")
    before, seen = [spark.conf.get(n) for n in names], []
    base.stored(spark, sf, "settings-seen", lambda path: seen.append([spark.conf.get(n) for n in names]))
    assert seen == [["true", "zstd"]] and [spark.conf.get(n) for n in names] == before


def _staged(monkeypatch, module):
    """Label and plan of each table that the module writes aside."""
    seen = []

    def kept(df, label, keep=module.stage):
        seen.append((label, df._jdf.queryExecution().executedPlan().toString()))
        return keep(df, label)

    monkeypatch.setattr(module, "stage", kept)
    return seen


def test_a_dealt_table_is_merged_as_it_is(spark, tmp_path, monkeypatch):
    """New rows that are written aside already aren't written again, and partitions that lose all their rows aren't read."""
    path = f"{tmp_path}/t"
    tables.append(spark.createDataFrame([(1, "a", 10), (2, "b", 10), (3, "c", 20), (4, "d", 20), (5, "e", None)], "k int, v string, p int"), path, ["p"])
    new = session.stage(spark.createDataFrame([(1, "x", 10), (2, "y", 30), (3, "z", 20), (5, "n", None)], "k int, v string, p int"), "new")
    seen = _staged(monkeypatch, tables)
    tables.merge_partitions(new, path, ["k"], "p", dealt=True)
    got = sorted((r.k, r.v, r.p) for r in spark.read.parquet(path).collect())
    assert got == [(1, "x", 10), (2, "y", 30), (3, "z", 20), (4, "d", 20), (5, "n", None)]
    assert [label for label, _ in seen] == ["replaced", "merge-rows"]
    filters = dict(seen)["merge-rows"].split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert "20" in filters and "10" not in filters and "isnull" not in filters
    assert new.count() == 4


def test_a_load_writes_nothing_aside(spark, sf, monkeypatch):
    _, out = stored_marts(spark, sf)
    copy = dataclasses.replace(out, warehouse=f"{out.warehouse}-direct")
    seen = _staged(monkeypatch, marts)
    assert marts.load_warehouse(spark, copy) == [1, 2] and not seen
    assert marts.current_bookings(spark, copy).count() == spark.read.parquet(out.wide).count()


def test_marks_of_an_attempt_before_are_kept_once(spark, tmp_path):
    out = marts.Marts(f"{tmp_path}/gold", f"{tmp_path}/warehouse")
    rows = lambda *keys: spark.createDataFrame([(k, 1, "v") for k in keys], "BOOKING_ID string, booking_month int, V string")
    for run, keys in ((2, "ab"), (3, "cd"), (3, "de")):
        marts._write_marks(rows(*keys), out, run)
    assert sorted((r.BOOKING_ID, r.gold_run) for r in spark.read.parquet(out.left).collect()) == [("a", 2), ("b", 2), ("c", 3), ("d", 3), ("e", 3)]
