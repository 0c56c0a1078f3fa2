"""Domain tables as common table expressions for the checking SQL."""

from __future__ import annotations

# name -> (tables it needs, body)
CTES: dict[str, tuple[list[str], str]] = {
    "provinces": ([], "SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey"),
    "dim_pos": (
        ["provinces"],
        """SELECT n_nationkey AS POS_CODE, concat('POS ', n_name) AS POS_NAME, n_nationkey AS PROVINCE_CODE,
       n_name AS PROVINCE_NAME, r_name AS REGION,
       CASE WHEN n_nationkey % 3 = 0 THEN 'PROVINCIAL' WHEN n_nationkey % 3 = 1 THEN 'DISTRICT'
            ELSE 'COMMUNE' END AS POS_LEVEL,
       TIMESTAMP '1995-01-01' AS CREATED_AT, TIMESTAMP '1995-01-01' AS ingested_at
FROM provinces""",
    ),
    "dim_customers": (
        ["provinces"],
        """SELECT c_custkey AS CUSTOMER_ID, c_name AS CUSTOMER_NAME, c_mktsegment AS CUSTOMER_TYPE,
       concat('TX', c_custkey) AS TAX_CODE, n_name AS PROVINCE, r_name AS REGION,
       TIMESTAMP '1995-01-01' AS CREATED_AT,
       CAST(DATE '1995-01-01' + CAST(floor(abs(c_acctbal) / 4) AS INTEGER) AS TIMESTAMP) AS ingested_at
FROM customer JOIN provinces ON c_nationkey = n_nationkey""",
    ),
    "dim_verified": (
        ["dim_customers"],
        "SELECT * FROM dim_customers WHERE CUSTOMER_ID IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)",
    ),
    "dim_services": (
        [],
        """SELECT DISTINCT p_type AS SERVICE_ID, concat('SVC_', p_type) AS SERVICE_CODE,
       concat('SVC ', p_type) AS SERVICE_NAME, CASE WHEN p_type = 'PROMO' THEN 1 ELSE 0 END AS IS_INTERNATIONAL,
       TIMESTAMP '1995-01-01' AS CREATED_AT, TIMESTAMP '1995-01-01' AS ingested_at
FROM part""",
    ),
    "dim_statuses": (
        [],
        """SELECT DISTINCT concat(l_returnflag, '-', l_linestatus) AS STATUS_ID,
       concat(l_returnflag, l_linestatus) AS STATUS_CODE,
       concat('Status ', l_returnflag, l_linestatus) AS STATUS_NAME,
       CASE WHEN l_returnflag = 'R' THEN 'FAILED' WHEN l_linestatus = 'F' THEN 'COMPLETED'
            WHEN l_returnflag = 'A' THEN 'IN_PROGRESS' ELSE 'PENDING' END AS STATUS_GROUP,
       TIMESTAMP '1995-01-01' AS ingested_at
FROM lineitem""",
    ),
    "booking_versions": (
        [],
        """SELECT concat('BK-', l_orderkey, '-', l_linenumber) AS BOOKING_ID,
       concat('EA', 100000000 + l_orderkey * 10 + l_linenumber, 'VN') AS ITEM_CODE,
       l_shipdate AS BOOKING_DATE, o_custkey AS CUSTOMER_ID, p_type AS SERVICE_ID,
       s_nationkey AS SENDING_POS_CODE, c_nationkey AS RECEIVING_POS_CODE,
       CAST(l_quantity * 1000 AS BIGINT) AS WEIGHT_GRAM,
       CAST(l_extendedprice AS DECIMAL(15,2)) AS MAIN_FEE,
       CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS SUR_FEE,
       CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS DISCOUNT_AMOUNT,
       concat(l_returnflag, '-', l_linestatus) AS STATUS_ID,
       o_orderdate AS ingested_at, l_partkey AS v1, l_suppkey AS v2
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
     JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey""",
    ),
    "bookings": (
        ["booking_versions"],
        """SELECT BOOKING_ID, ITEM_CODE, BOOKING_DATE, CUSTOMER_ID, SERVICE_ID, SENDING_POS_CODE, RECEIVING_POS_CODE,
       WEIGHT_GRAM, CASE WHEN WEIGHT_GRAM <= 10000 THEN 'LIGHT' ELSE 'HEAVY' END AS WEIGHT_TIER_ID,
       'ROAD' AS ROUTING_TYPE_ID, MAIN_FEE, SUR_FEE, DISCOUNT_AMOUNT,
       CAST(MAIN_FEE + SUR_FEE - DISCOUNT_AMOUNT AS DECIMAL(18,4)) AS TOTAL_REVENUE,
       CAST((MAIN_FEE + SUR_FEE - DISCOUNT_AMOUNT) * 0.65 AS DECIMAL(18,4)) AS COST_AMOUNT,
       STATUS_ID, ingested_at AS CREATED_AT, BOOKING_DATE AS UPDATED_AT, ingested_at
FROM (SELECT *, row_number() OVER (PARTITION BY BOOKING_ID
             ORDER BY BOOKING_DATE DESC, v1 DESC, v2 DESC, MAIN_FEE DESC, WEIGHT_GRAM DESC,
                      SUR_FEE DESC, DISCOUNT_AMOUNT DESC) AS rn
      FROM booking_versions) t
WHERE rn = 1""",
    ),
    "driver_shifts": (
        [],
        """SELECT event_id AS SHIFT_ID, CAST(ts AS DATE) AS SHIFT_DATE, concat('DRV-', user_id) AS DRIVER_NAME,
       concat('NATION_', user_id % 25) AS SENDING_PROVINCE, CAST(value AS DECIMAL(12,2)) AS DISTANCE_KM
FROM events""",
    ),
    "permissions": (
        ["provinces"],
        """SELECT concat('manager_', lower(r_name)) AS username, 'REGIONAL_MANAGER' AS role,
       list(n_name ORDER BY n_name) AS province_access FROM provinces GROUP BY r_name
UNION ALL SELECT concat('admin_', lower(r_name)), 'ADMIN', ['ALL'] FROM region
UNION ALL SELECT concat('idle_', lower(r_name)), 'REGIONAL_MANAGER', CAST([] AS VARCHAR[]) FROM region
UNION ALL SELECT concat('driver_', s_suppkey), 'DRIVER', [n_name]
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    ),
    "messages": (
        [],
        """SELECT event_id, user_id, event_type, value, epoch_us(ts) // 1000 AS ts_ms,
       CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
       value < 1 AS faulty, user_id % 3 AS part
FROM events""",
    ),
    "changes": (
        ["messages"],
        """SELECT user_id AS ID, event_type AS STATUS, value AS AMOUNT, op, ts_ms, event_id
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, ts_ms ORDER BY event_id DESC) AS rn
      FROM messages WHERE NOT faulty) t WHERE rn = 1""",
    ),
    "timeline": (
        ["changes"],
        """SELECT *, ts_ms AS from_ms, lead(ts_ms) OVER (PARTITION BY ID ORDER BY ts_ms) AS next_ms FROM changes""",
    ),
    "history": (
        ["timeline"],
        """SELECT ID, STATUS, AMOUNT, from_ms, coalesce(next_ms, 253402300799000) AS to_ms,
       CASE WHEN next_ms IS NULL THEN 1 ELSE 0 END AS is_current
FROM timeline WHERE op <> 'd'""",
    ),
}


# Columns of the booking table that come from the fact, and for each role of a dimension its
# table, the fact's column, the dimension's key, and the names under which its columns appear.
FROM_FACT = (
    "BOOKING_ID ITEM_CODE WEIGHT_GRAM MAIN_FEE SUR_FEE DISCOUNT_AMOUNT TOTAL_REVENUE COST_AMOUNT CREATED_AT UPDATED_AT"
).split()
OFFICE = {"POS_CODE": "POS_CODE", "POS_NAME": "POS_NAME", "PROVINCE": "PROVINCE_NAME", "REGION": "REGION"}
ROLES: dict[str, tuple[str, str, str, dict[str, str]]] = {
    "customer": (
        "dim_customers",
        "CUSTOMER_ID",
        "CUSTOMER_ID",
        {c: c for c in ("CUSTOMER_ID", "CUSTOMER_NAME", "CUSTOMER_TYPE")}
        | {f"CUSTOMER_{c}": c for c in ("PROVINCE", "REGION")},
    ),
    "service": (
        "dim_services",
        "SERVICE_ID",
        "SERVICE_ID",
        {c: c for c in ("SERVICE_ID", "SERVICE_CODE", "SERVICE_NAME", "IS_INTERNATIONAL")},
    ),
    "sender": ("dim_pos", "SENDING_POS_CODE", "POS_CODE", {f"SENDING_{k}": c for k, c in OFFICE.items()}),
    "receiver": ("dim_pos", "RECEIVING_POS_CODE", "POS_CODE", {f"RECEIVING_{k}": c for k, c in OFFICE.items()}),
    "status": (
        "dim_statuses",
        "STATUS_ID",
        "STATUS_ID",
        {c: c for c in ("STATUS_ID", "STATUS_CODE", "STATUS_NAME", "STATUS_GROUP")},
    ),
}


def obt_body(customers: str = "dim_customers") -> str:
    """The booking table: each role is a renamed dimension that is joined to the bookings."""
    columns = [f"bookings.{c}" for c in FROM_FACT]
    columns.append("CAST(bookings.BOOKING_DATE AS DATE) AS BOOKING_DATE")
    columns.append("CAST(TOTAL_REVENUE - COST_AMOUNT AS DECIMAL(18,4)) AS PROFIT_AMOUNT")
    stamps, joins = ["bookings.ingested_at"], []
    for role, (table, reference, key, names) in ROLES.items():
        renamed = ", ".join(f"{c} AS {name}" for name, c in names.items())
        source = customers if role == "customer" else table
        joins.append(
            f"LEFT JOIN (SELECT {key} AS {role}_key, ingested_at AS {role}_at, {renamed} FROM {source}) AS {role}\n"
            f"     ON {role}_key = bookings.{reference}"
        )
        columns += [f"{role}.{name}" for name in names]
        stamps.append(f"{role}_at")
    body = "\n".join(["FROM bookings", *joins])
    return f"SELECT {', '.join(columns)},\n       greatest({', '.join(stamps)}) AS ingested_at\n{body}"


_DIMS = ["dim_services", "dim_pos", "dim_statuses", "bookings"]
CTES["obt"] = (["dim_customers", *_DIMS], obt_body())
CTES["obt_verified"] = (["dim_verified", *_DIMS], obt_body("dim_verified"))

# The booking table as text and doubles, the way registered queries return it.
OBT_OUT = """BOOKING_ID, ITEM_CODE, CAST(BOOKING_DATE AS VARCHAR) AS BOOKING_DATE, WEIGHT_GRAM,
       CAST(MAIN_FEE AS DOUBLE) AS MAIN_FEE, CAST(SUR_FEE AS DOUBLE) AS SUR_FEE,
       CAST(DISCOUNT_AMOUNT AS DOUBLE) AS DISCOUNT_AMOUNT, CAST(TOTAL_REVENUE AS DOUBLE) AS TOTAL_REVENUE,
       CAST(COST_AMOUNT AS DOUBLE) AS COST_AMOUNT, CAST(PROFIT_AMOUNT AS DOUBLE) AS PROFIT_AMOUNT,
       CAST(CREATED_AT AS VARCHAR) AS CREATED_AT, CAST(UPDATED_AT AS VARCHAR) AS UPDATED_AT,
       CUSTOMER_ID, CUSTOMER_NAME, CUSTOMER_TYPE, CUSTOMER_PROVINCE, CUSTOMER_REGION, SERVICE_ID, SERVICE_CODE,
       SERVICE_NAME, IS_INTERNATIONAL, SENDING_POS_CODE, SENDING_POS_NAME, SENDING_PROVINCE, SENDING_REGION,
       RECEIVING_POS_CODE, RECEIVING_POS_NAME, RECEIVING_PROVINCE, RECEIVING_REGION, STATUS_ID, STATUS_CODE,
       STATUS_NAME, STATUS_GROUP, CAST(ingested_at AS VARCHAR) AS ingested_at"""


def with_(names: str, body: str, **extra: str) -> str:
    """``WITH`` clause holding ``names`` (space separated) and all they need, then ``extra``, then ``body``."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for needed in CTES[name][0]:
                visit(needed)
            order.append(name)

    for name in names.split():
        visit(name)
    parts = [f"{n} AS (\n{CTES[n][1]}\n)" for n in order] + [f"{n} AS (\n{b}\n)" for n, b in extra.items()]
    return f"WITH {', '.join(parts)}\n{body}"


def obt(body: str) -> str:
    return with_("obt", body)
