"""Row-level security and dataset query rules."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from parcelmill.operators import dataset as dq
from parcelmill.operators import security
from parcelmill.operators.dataset import Agg, Dataset, DatasetQuery, Expr, Filter, QueryError
from parcelmill.plans import semantic
from parcelmill.schemas import PERMISSIONS


@pytest.fixture(scope="module")
def permissions(spark):
    return spark.createDataFrame(
        [
            ("admin", "ADMIN", ["X"], None),
            ("all", "DRIVER", ["ALL"], None),
            ("north", "REGIONAL_MANAGER", ["P1", "P2", "NOWHERE"], None),
            ("empty", "REGIONAL_MANAGER", [], None),
            ("driver", "DRIVER", ["P1"], None),
            ("staff", "STAFF", ["P1"], None),
            ("o'neil", "REGIONAL_MANAGER", ["P3"], None),
        ],
        PERMISSIONS,
    )


@pytest.fixture(scope="module")
def bases(spark):
    shipments = spark.createDataFrame(
        [(f"B{i}", f"P{i % 4}", "COMPLETED", i, 10, 5) for i in range(20)] + [("BX", None, "FAILED", 1, 1, 1)],
        "BOOKING_ID string, SENDING_PROVINCE string, STATUS_GROUP string, TOTAL_REVENUE int, COST_AMOUNT int, PROFIT_AMOUNT int",
    )
    shifts = spark.createDataFrame([(i, f"P{i % 4}", 1.0) for i in range(8)], "SHIFT_ID int, SENDING_PROVINCE string, DISTANCE_KM double")
    return {"Shipments": shipments, "DriverShifts": shifts}


def ask(bases, permissions, user, measure="Shipments.totalBookings"):
    cube = measure.split(".")[0]
    rows = security.secured_query(bases, permissions, user, [measure], [f"{cube}.sendingProvince"]).collect()
    return {r[0]: r[1] for r in rows}


def test_the_latest_of_several_permission_rows_counts(spark):
    kind = "username string, role string, province_access array<string>, updated_at timestamp"
    rows = [
        ("ann", "ADMIN", ["ALL"], datetime(2024, 1, 1)), ("ann", "REGIONAL_MANAGER", ["P1"], datetime(2024, 3, 1)),
        ("ann", "DRIVER", ["P2"], datetime(2024, 2, 1)), ("bob", "ADMIN", None, None), ("bob", "GUEST", None, datetime(2020, 1, 1)),
    ]
    for shuffled in (rows, rows[::-1]):
        table = spark.createDataFrame(shuffled, kind).repartition(3)
        assert security.lookup(table, "ann") == security.Access("ann", "REGIONAL_MANAGER", ("P1",))
        assert security.lookup(table, "bob").role == "GUEST"


def test_roles(bases, permissions):
    everything = {"P0": 5, "P1": 5, "P2": 5, "P3": 5, None: 1}
    assert ask(bases, permissions, "admin") == everything
    assert ask(bases, permissions, "all") == everything
    assert ask(bases, permissions, "north") == {"P1": 5, "P2": 5}
    assert ask(bases, permissions, "o'neil") == {"P3": 5}
    for user in ("empty", "staff", "unknown", "x' OR '1'='1"):
        assert ask(bases, permissions, user) == {}
    assert ask(bases, permissions, "driver", "DriverShifts.totalShifts") == {"P1": 2}
    assert ask(bases, permissions, "unknown", "DriverShifts.totalShifts") == {}
    with pytest.raises(PermissionError):
        ask(bases, permissions, "driver")


def test_guest_total_is_zero(bases, permissions):
    assert security.secured_query(bases, permissions, "nobody", ["Shipments.count"]).first()[0] == 0


def test_one_cube_per_query(bases, permissions):
    with pytest.raises(ValueError):
        security.secured_query(bases, permissions, "admin", ["Shipments.count", "DriverShifts.totalShifts"])
    with pytest.raises(ValueError):
        ask(bases, permissions, "admin", "Elsewhere.count")
    with pytest.raises(ValueError):
        security.secured_query(bases, permissions, "admin", ["Shipments.nothing"])


def test_ratio_of_nothing_is_null(bases):
    rows = semantic.query(bases["Shipments"].filter("false"), semantic.SHIPMENTS, ["profitMarginPct", "deliverySuccessRate"])
    assert tuple(rows.first()) == (None, None)


def ds(bases, **k):
    return Dataset(bases["Shipments"], semantic.SHIPMENTS.measures, **k)


@pytest.mark.parametrize(
    "query",
    [
        DatasetQuery(),
        DatasetQuery(metrics=["nothing"]),
        DatasetQuery(metrics=[Agg("MEDIAN", "TOTAL_REVENUE")]),
        DatasetQuery(metrics=["count"], is_timeseries=True),
        DatasetQuery(metrics=["count"], granularity="NO_COLUMN"),
        DatasetQuery(metrics=["count"], filters=[Filter("SENDING_PROVINCE", "IN", [])]),
        DatasetQuery(metrics=["count"], filters=[Filter("SENDING_PROVINCE", ">", None)]),
        DatasetQuery(metrics=["count"], filters=[Filter("SENDING_PROVINCE", "NEAR", "x")]),
        DatasetQuery(metrics=["count"], orderby=[("NO_COLUMN", True)]),
    ],
)
def test_bad_queries(bases, query):
    with pytest.raises(QueryError):
        dq.run(ds(bases), query)


def test_null_membership(bases):
    def provinces(op, values):
        q = DatasetQuery(metrics=["count"], groupby=["SENDING_PROVINCE"], filters=[Filter("SENDING_PROVINCE", op, values)])
        return {r[0] for r in dq.run(ds(bases), q).collect()}

    assert provinces("IN", ["P1", None]) == {"P1", None}
    assert provinces("IN", [None]) == {None}
    assert provinces("NOT IN", ["P1"]) == {"P0", "P2", "P3"}
    assert provinces("NOT IN", ["P1", None]) == {"P0", "P2", "P3"}
    assert provinces("NOT IN", [None]) == {"P0", "P1", "P2", "P3"}


def test_filter_on_unknown_column_is_ignored(bases):
    q = DatasetQuery(metrics=["count"], filters=[Filter("NO_COLUMN", "==", 1)])
    assert dq.run(ds(bases), q).first()[0] == 21


def test_hidden_order_and_row_level(bases):
    q = DatasetQuery(
        metrics=["count"],
        groupby=["SENDING_PROVINCE"],
        orderby=[(Agg("SUM", "TOTAL_REVENUE"), False)],
        row_limit=2,
    )
    rows = dq.run(ds(bases, row_level=F.expr("SENDING_PROVINCE <> 'P3'")), q)
    assert rows.columns == ["SENDING_PROVINCE", "count"]
    assert [r[0] for r in rows.collect()] == ["P2", "P1"]


def test_having_may_use_a_label(bases):
    q = DatasetQuery(metrics=[Agg("COUNT", "BOOKING_ID", "n")], groupby=["SENDING_PROVINCE"], having="n > 1")
    assert dq.run(ds(bases), q).count() == 4


def test_series_limit_drops_null_groups(bases):
    q = DatasetQuery(
        metrics=["totalRevenue"], groupby=["SENDING_PROVINCE"], series_columns=["SENDING_PROVINCE"], series_limit=9
    )
    assert {r[0] for r in dq.run(ds(bases), q).collect()} == {"P0", "P1", "P2", "P3"}
    # the NULL group is ranked first here: it takes a place, but its rows match nothing
    q.series_limit, q.order_desc = 2, False
    assert [r[0] for r in dq.run(ds(bases), q).collect()] == ["P0"]


def test_virtual_dataset_is_one_select(spark, bases):
    view = {"virtual_rows": bases["Shipments"]}
    made = dq.virtual_dataset(spark, "SELECT SENDING_PROVINCE AS p FROM virtual_rows;", view)
    assert dq.run(made, DatasetQuery(columns=["p"])).count() == 21
    for text in ("", " ; ", "SELECT 1; SELECT 2", "DROP VIEW virtual_rows", "INSERT INTO virtual_rows VALUES (1)"):
        with pytest.raises(Exception):
            dq.virtual_dataset(spark, text, view).rows.count()


def test_expression_dimension_and_offset(bases):
    q = DatasetQuery(
        metrics=["count"], groupby=[Expr("TOTAL_REVENUE % 5", "r")], orderby=[("r", True)], row_limit=2, row_offset=1
    )
    assert [tuple(r) for r in dq.run(ds(bases), q).collect()] == [(1, 5), (2, 4)]


def test_both_forms_of_row_security_agree(spark):
    base = spark.createDataFrame([("N",), ("S",), (None,)], "SENDING_PROVINCE string")
    grants = [
        ("admin", security.ADMIN, []), ("every", security.MANAGER, [security.ALL]), ("north", security.MANAGER, ["N", "X"]),
        ("none", security.MANAGER, []), ("null", security.MANAGER, None), ("guest", security.GUEST, ["N"]), ("odd", None, ["N"]),
        ("driver", security.DRIVER, ["N"]), ("all_guest", security.GUEST, [security.ALL]),
    ]
    table = spark.createDataFrame(grants, "username string, role string, province_access array<string>")
    for user in [g[0] for g in grants] + ["unknown"]:
        def rows(secured):
            try:
                return sorted(str(r[0]) for r in secured().collect())
            except PermissionError:
                return "refused"

        plain = rows(lambda: security.secure(base, security.lookup(table, user), semantic.SHIPMENTS))
        assert rows(lambda: security.secure_by_table(base, table, user, semantic.SHIPMENTS)) == plain, user
