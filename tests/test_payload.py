"""Envelope, payload and quarantine micro-cases."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parcelmill.functions.shape import align_to, unfit
from parcelmill.functions.times import epoch_to_timestamp, normalize_epochs, time_bucket
from parcelmill.operators import payload
from parcelmill.schemas import CHANGE_MESSAGE, SOURCE_TABLES, TABLE_KEYS, source_schema
from parcelmill.sources.changes import backfill, to_bronze

AT = datetime(2023, 11, 14)


def bronze(spark, *values, topic="cdc.T"):
    rows = [("k", v, topic, 0, i, AT) for i, v in enumerate(values)]
    return to_bronze(spark.createDataFrame(rows, CHANGE_MESSAGE))


def reasons(spark, *values, keys=("ID",), schema=None):
    classified, _ = payload.classify(bronze(spark, *values), list(keys), schema)
    return [r["error_reason"] for r in classified.orderBy("kafka_offset").collect()]


FLAT = '{"op":"c","ts_ms":1700000000100,"before":null,"after":{"ID":"A","V":1}}'
NESTED = '{"payload":{"op":"u","ts_ms":1700000000200,"before":{"ID":"A","V":1},"after":{"ID":"A","V":2}}}'
DELETE = '{"op":"d","ts_ms":1700000000300,"before":{"ID":"A","V":2},"after":null}'


def test_both_envelopes(spark):
    rows = bronze(spark, FLAT, NESTED, DELETE).orderBy("kafka_offset").collect()
    assert [r["op"] for r in rows] == ["c", "u", "d"]
    assert [r["ts_ms"] for r in rows] == [1700000000100, 1700000000200, 1700000000300]
    assert rows[0]["event_time"].microsecond == 100000


def test_image_prefers_after_then_before(spark):
    valid = payload.split(bronze(spark, FLAT, NESTED, DELETE), ["ID"]).valid
    assert [(r["op"], r["V"]) for r in valid.orderBy("kafka_offset").collect()] == [("c", 1), ("u", 2), ("d", 2)]


def test_snapshot_read_is_valid(spark):
    assert reasons(spark, FLAT.replace('"c"', '"r"')) == [None]


def test_reject_reasons(spark):
    got = reasons(
        spark,
        FLAT,
        '{"op":"c","ts_ms":1,"after":{"ID":null}}',
        '{"op":"c","ts_ms":1,"after":{"V":1}}',
        '{"op":"u","ts_ms":1,"before":null,"after":null}',
        "{bad",
        '{"op":"t","ts_ms":1,"after":{"ID":"A"}}',
        '{"ts_ms":1,"after":{"ID":"A"}}',
        '{"op":"u","after":{"ID":"A"}}',
    )
    assert got == [
        None,
        payload.NO_KEY,
        payload.NO_KEY,
        payload.EMPTY,
        payload.EMPTY,
        payload.UNKNOWN_OP,
        payload.UNKNOWN_OP,
        payload.NO_TIME,
    ]


def test_key_column_absent_everywhere(spark):
    assert reasons(spark, '{"op":"c","ts_ms":1,"after":{"V":1}}') == [payload.NO_KEY]


def test_composite_key_needs_every_part(spark):
    got = reasons(
        spark,
        '{"op":"c","ts_ms":1,"after":{"A":1,"B":2}}',
        '{"op":"c","ts_ms":1,"after":{"A":1,"B":null}}',
        keys=("A", "B"),
    )
    assert got == [None, payload.NO_KEY]


def test_only_rejects(spark):
    assert reasons(spark, '{"op":"u","before":null,"after":null}') == [payload.EMPTY]
    assert reasons(spark, "{bad", "nonsense") == [payload.EMPTY, payload.EMPTY]


def test_dead_letters_keep_the_text_and_valid_rows_do_not(spark):
    classified, _ = payload.classify(bronze(spark, FLAT, "{bad"), ["ID"])
    assert [r["raw_value"] for r in classified.orderBy("kafka_offset").collect()] == [None, "{bad"]
    assert payload.dead_letters(classified).first()["raw_value"] == "{bad"


def test_replayed_rejects_add_nothing(spark):
    rejects = payload.split(bronze(spark, FLAT, "{bad", "{worse"), ["ID"]).rejects
    assert payload.new_dead_letters(rejects.union(rejects), rejects.filter("kafka_offset = 1")).count() == 1


def test_schema_covers_every_row(spark):
    """A field that only the last row has is found, and conflicting types become text."""
    texts = ['{"op":"c","ts_ms":1,"after":{"ID":%d,"X":%d}}' % (i, i) for i in range(60)]
    texts += ['{"op":"c","ts_ms":1,"after":{"ID":60,"X":"y","NEW":5.5,"BIG":12345678901234567890}}', '{"op":"c","after":7}']
    schema = payload.infer_schema(payload.with_image(bronze(spark, *texts)))
    types = {f.name: f.dataType.simpleString() for f in schema}
    assert types == {"ID": "bigint", "X": "string", "NEW": "double", "BIG": "decimal(20,0)"}


def test_wrong_type_of_one_field_is_rejected(spark):
    schema = StructType.fromDDL("ID string, V bigint")
    parts = payload.split(bronze(spark, '{"op":"c","ts_ms":1,"after":{"ID":"A","V":"many"}}'), ["ID"], schema)
    assert parts.valid.count() == 0
    assert parts.rejects.first()["error_reason"] == payload.TYPE_CONFLICT


def test_epoch_units(spark):
    df = spark.createDataFrame(
        [(1700000000123456,), (1700000000123,), (1700000000,), (None,)], "CREATED_AT long"
    )
    got = [r[0] for r in normalize_epochs(df).collect()]
    assert got[0] == datetime(2023, 11, 14, 22, 13, 20, 123456)
    assert got[1] == datetime(2023, 11, 14, 22, 13, 20, 123000)
    assert got[2] == datetime(2023, 11, 14, 22, 13, 20)
    assert got[3] is None


def test_epoch_unit_can_be_declared(spark):
    """Milliseconds before 2001-09-09 look like seconds; a declared unit reads them right."""
    df = spark.createDataFrame([(946684800000,)], "v long")
    assert df.select(epoch_to_timestamp(F.col("v"), "ms")).first()[0] == datetime(2000, 1, 1)


def test_names_decide_what_is_an_epoch(spark):
    df = spark.createDataFrame([(1, 1, 1, 1, 1)], "DATE_X long, ORDER_DATE int, at_time long, AMOUNT long, STATE int")
    types = dict(normalize_epochs(df).dtypes)
    assert [types[c] for c in df.columns] == ["timestamp", "timestamp", "timestamp", "bigint", "int"]


def test_align_casts_shared_columns(spark):
    df = spark.createDataFrame([("12", "x", 1700000000)], "a string, b string, t long")
    out = align_to(df, StructType.fromDDL("a int, b int, t timestamp, other string"))
    row = out.first()
    assert (row["a"], row["b"], row["t"]) == (12, None, datetime(2023, 11, 14, 22, 13, 20))
    assert out.columns == ["a", "b", "t"]


def test_backfill_in_one_run(spark):
    """Rows that lost ts_ms get their time from the message, at once."""
    old = bronze(spark, FLAT, NESTED).drop("event_time").withColumn("ts_ms", F.lit(None).cast("long"))
    rows = backfill(old).orderBy("kafka_offset").collect()
    assert [r["ts_ms"] for r in rows] == [1700000000100, 1700000000200]
    assert all(r["event_time"] is not None for r in rows)


@pytest.mark.parametrize(
    "grain, expected",
    [
        ("PT1S", datetime(2024, 5, 16, 13, 47, 38)),
        ("PT5S", datetime(2024, 5, 16, 13, 47, 35)),
        ("PT30S", datetime(2024, 5, 16, 13, 47, 30)),
        ("PT10M", datetime(2024, 5, 16, 13, 40)),
        ("PT6H", datetime(2024, 5, 16, 12)),
        ("P1D", datetime(2024, 5, 16)),
        ("P1W", datetime(2024, 5, 13)),
        ("P3M", datetime(2024, 4, 1)),
        ("P1Y", datetime(2024, 1, 1)),
    ],
)
def test_time_grains(spark, grain, expected):
    df = spark.createDataFrame([(datetime(2024, 5, 16, 13, 47, 38, 900000),)], "t timestamp")
    assert df.select(time_bucket(F.col("t"), grain)).first()[0] == expected


def test_registered_tables_declare_their_keys(spark):
    assert len(SOURCE_TABLES) == 11
    for name, keys in TABLE_KEYS.items():
        assert set(keys) <= set(source_schema(name).names)


@pytest.mark.parametrize(
    "have, value, goal, held",
    [
        ("double", 1.75, "bigint", False), ("double", 2.0, "bigint", True), ("double", 1e30, "bigint", False),
        ("double", float("nan"), "bigint", False), ("double", 12.345, "decimal(15,2)", False),
        ("double", 12.34, "decimal(15,2)", True), ("double", 0.1, "float", True), ("bigint", 2**53 + 1, "double", False),
        ("bigint", 2**53, "double", True), ("bigint", 300, "tinyint", False), ("string", "1.75", "bigint", False),
        ("string", "17", "bigint", True), ("string", "12.345", "decimal(15,2)", False), ("string", "12.30", "decimal(15,1)", True),
        ("string", "2024-01-02 10:00:00", "date", False), ("string", "2024-01-02", "date", True), ("string", "x", "date", False),
        ("timestamp", datetime(2024, 1, 2, 10), "date", False), ("timestamp", datetime(2024, 1, 2), "date", True),
        ("bigint", 7, "string", True), ("bigint", None, "tinyint", True),
    ],
)
def test_values_that_a_type_cannot_hold(spark, have, value, goal, held):
    row = spark.createDataFrame([((value,),)], f"row struct<V: {have}>")
    found = row.select(unfit(row.schema["row"].dataType, StructType.fromDDL(f"V {goal}")).alias("lost")).first()["lost"]
    assert found is not held
