"""Current state and SCD2 history: micro-cases and properties."""

from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelmill.operators import history, merge

T0 = datetime(2024, 1, 1)
SCHEMA = (
    "op string, ts_ms long, kafka_partition int, kafka_offset long, kafka_timestamp timestamp, "
    "cdc_event_time timestamp, ID string, V int"
)
KEYS = ["ID"]


def changes(spark, *rows):
    """(op, seconds, offset, key, value)"""
    data = [(op, sec * 1000, 0, off, T0, T0 + timedelta(seconds=sec), key, v) for op, sec, off, key, v in rows]
    return spark.createDataFrame(data, SCHEMA)


def seconds(t):
    return None if t.year == 9999 else int((t - T0).total_seconds())


def public(df):
    rows = history.public_history(df).collect()
    return sorted((r["ID"], r["V"], seconds(r["valid_from"]), seconds(r["valid_to"]), r["is_current"]) for r in rows)


def stamp():
    return F.lit(T0)


def test_insert_update_delete(spark):
    df = changes(spark, ("c", 1, 1, "A", 1), ("u", 5, 2, "A", 2), ("d", 9, 3, "A", 2))
    assert public(history.build_history(df, KEYS)) == [("A", 1, 1, 5, 0), ("A", 2, 5, 9, 0)]
    assert merge.apply_value(None, df, KEYS).count() == 0


def test_delete_then_insert_leaves_a_gap(spark):
    df = changes(spark, ("c", 1, 1, "A", 1), ("d", 3, 2, "A", 1), ("c", 4, 3, "A", 7))
    assert public(history.build_history(df, KEYS)) == [("A", 1, 1, 3, 0), ("A", 7, 4, None, 1)]


def test_same_time_highest_offset_wins(spark):
    df = changes(spark, ("u", 1, 7, "A", 1), ("u", 1, 9, "A", 2))
    assert public(history.build_history(df, KEYS)) == [("A", 2, 1, None, 1)]
    assert merge.apply_value(None, df, KEYS).first()["V"] == 2


def test_late_event_goes_into_the_middle(spark):
    first = history.build_history(changes(spark, ("c", 1, 1, "A", 1), ("u", 10, 2, "A", 3)), KEYS)
    out = history.apply_history(first, changes(spark, ("u", 5, 3, "A", 2)), KEYS)
    assert public(out) == [("A", 1, 1, 5, 0), ("A", 2, 5, 10, 0), ("A", 3, 10, None, 1)]


def test_update_after_a_stored_delete_does_not_stretch_the_old_version(spark):
    first = history.build_history(changes(spark, ("c", 1, 1, "A", 1), ("d", 3, 2, "A", 1)), KEYS)
    out = history.apply_history(first, changes(spark, ("c", 8, 3, "A", 2)), KEYS)
    assert public(out) == [("A", 1, 1, 3, 0), ("A", 2, 8, None, 1)]
    late = history.apply_history(out, changes(spark, ("u", 2, 4, "A", 5)), KEYS)
    assert public(late) == [("A", 1, 1, 2, 0), ("A", 2, 8, None, 1), ("A", 5, 2, 3, 0)]


def test_replay_changes_nothing(spark):
    df = changes(spark, ("c", 1, 1, "A", 1), ("u", 5, 2, "A", 2), ("d", 6, 3, "B", 1), ("c", 2, 4, "B", 1))
    once = history.build_history(df, KEYS, stamp())
    again = history.apply_history(once, df, KEYS, stamp=F.lit(T0 + timedelta(days=1)))
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, again.collect()))
    value = merge.apply_value(None, df, KEYS, stamp=stamp())
    replayed = merge.apply_value(value, df, KEYS, stamp=stamp())
    assert sorted(map(tuple, value.collect())) == sorted(map(tuple, replayed.collect()))


def test_baseline_and_earlier_change(spark):
    """A change that precedes the bulk load becomes a closed version, not a second current one."""
    snapshot = spark.createDataFrame([("A", 5), ("B", 6)], "ID string, V int")
    base = history.baseline_history(snapshot, F.lit(T0 + timedelta(seconds=100)))
    out = history.apply_history(base, changes(spark, ("u", 40, 1, "A", 4), ("u", 200, 2, "B", 7)), KEYS)
    assert public(out) == [
        ("A", 4, 40, 100, 0),
        ("A", 5, 100, None, 1),
        ("B", 6, 100, 200, 0),
        ("B", 7, 200, None, 1),
    ]


def test_as_of_and_closed(spark):
    df = changes(spark, ("c", 1, 1, "A", 1), ("u", 5, 2, "A", 2), ("c", 3, 3, "B", 9))
    rows = history.build_history(df, KEYS)
    at = lambda s: F.lit(T0 + timedelta(seconds=s))
    assert [r["V"] for r in history.as_of(rows, at(4)).orderBy("ID").collect()] == [1, 9]
    assert [r["V"] for r in history.as_of(rows, at(5)).orderBy("ID").collect()] == [2, 9]
    assert [r["V"] for r in history.closed_versions(rows).collect()] == [1]
    assert history.current_versions(rows).count() == 2


def test_new_columns_survive(spark):
    first = history.build_history(changes(spark, ("c", 1, 1, "A", 1)), KEYS)
    wider = changes(spark, ("u", 5, 2, "A", 2)).withColumn("NEW", F.lit("x"))
    rows = {r["V"]: r["NEW"] for r in history.apply_history(first, wider, KEYS).collect()}
    assert rows == {1: None, 2: "x"}


def test_full_refresh_ignores_what_is_stored(spark):
    old = history.build_history(changes(spark, ("c", 1, 1, "Z", 1)), KEYS)
    out = history.apply_history(old, changes(spark, ("c", 1, 1, "A", 1)), KEYS, full_refresh=True)
    assert public(out) == [("A", 1, 1, None, 1)]
    value = merge.apply_value(None, changes(spark, ("c", 1, 1, "Z", 1)), KEYS)
    assert [r["ID"] for r in merge.apply_value(value, changes(spark, ("c", 1, 1, "A", 1)), KEYS, True).collect()] == ["A"]


def brute_force(rows):
    """History by a plain loop over the changes of each key."""
    out = []
    for key in sorted({r[3] for r in rows}):
        last = {}
        for r in rows:
            if r[3] == key and (r[1] not in last or r[2] > last[r[1]][2]):
                last[r[1]] = r
        times = sorted(last)
        for i, t in enumerate(times):
            if last[t][0] == "d":
                continue
            end = times[i + 1] if i + 1 < len(times) else None
            out.append((key, last[t][4], t, end, int(end is None)))
    return sorted(out)


def random_changes(rng, n, keys):
    """A third of the changes belong to one key."""
    hot = rng.random(n) < 1 / 3
    who = np.where(hot, 0, rng.integers(0, keys, n))
    ops = rng.choice(["c", "u", "u", "d"], n)
    return [(str(o), int(s), i, f"K{k}", i) for i, (o, s, k) in enumerate(zip(ops, rng.integers(0, 20000, n), who))]


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_any_order_any_repeat(spark, seed):
    rng = np.random.default_rng(seed)
    rows = random_changes(rng, 400, 12)
    want = brute_force(rows)
    assert public(history.build_history(changes(spark, *rows), KEYS)) == want
    shuffled = [rows[i] for i in rng.permutation(len(rows))]
    batches = [shuffled[:150], shuffled[150:260], shuffled[100:200], shuffled[260:]]
    stored = None
    for batch in batches:
        stored = history.apply_history(stored, changes(spark, *batch), KEYS, stamp=stamp())
        stored = spark.createDataFrame(stored.collect(), stored.schema)
    assert public(stored) == want
    current = [r for r in public(stored) if r[4] == 1]
    assert len(current) == len({r[0] for r in current})


@pytest.mark.parametrize("slice_ms", [1000, 60_000, 3_600_000])
def test_hot_keys_are_chained_in_slices(spark, slice_ms):
    rows = random_changes(np.random.default_rng(3), 600, 5)
    events = history.event_rows(changes(spark, *rows), KEYS, stamp())
    plain = history.chain(events, KEYS)
    sliced = history.chain(events, KEYS, hot_rows=20, slice_ms=slice_ms)
    assert sorted(map(tuple, plain.collect()), key=str) == sorted(map(tuple, sliced.collect()), key=str)


def test_conditional_update_touches_matched_rows_only(spark):
    target = spark.createDataFrame([("A", 1, 10), ("B", 2, 20), ("C", 3, 30)], "ID string, V int, W int")
    source = spark.createDataFrame([("A", 100), ("C", 5), ("X", 1)], "ID string, limit int")
    out = merge.merge_update(target, source, KEYS, F.col("W") < F.col("limit"), {"V": F.col("limit")})
    assert sorted(map(tuple, out.collect())) == [("A", 100, 10), ("B", 2, 20), ("C", 3, 30)]


def test_upsert_adds_columns(spark):
    target = spark.createDataFrame([("A", 1), ("B", 2)], "ID string, V int")
    source = spark.createDataFrame([("B", "7", "n")], "ID string, V string, N string")
    out = merge.merge_upsert(target, source, KEYS)
    assert sorted(map(tuple, out.collect()), key=str) == [("A", 1, None), ("B", 7, "n")]
