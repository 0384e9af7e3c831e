"""SQL of the given tables as source tables and of their histories, for the checks."""

# Source tables.
ORDERS = """
SELECT o_orderkey AS id, o_custkey AS user_id, o_orderpriority AS product_name,
       CAST(o_totalprice AS DECIMAL(10,2)) AS amount, o_orderdate AS created_at, o_orderstatus
FROM orders"""

USERS = """
SELECT c_custkey AS id, c_name AS full_name, lower(c_name) || '@example.com' AS email,
       TIMESTAMP '2024-01-01 00:00:00' + to_seconds(c_custkey) AS created_at,
       c_mktsegment, c_nationkey
FROM customer"""

EVENTS = """
SELECT event_id AS id, user_id, event_type AS kind, value, props, ts AS created_at
FROM events"""

# Change logs: first event, update, delete.
ORDERS_LOG = f"""
WITH t AS ({ORDERS}),
f AS (SELECT *, product_name IN ('1-URGENT', '2-HIGH') AS updated,
             o_orderstatus = 'P' AND product_name IN ('5-LOW', '2-HIGH') AS deleted,
             created_at < TIMESTAMP '1998-01-01' AS keyed
      FROM t),
log AS (
SELECT id AS pk_id, CASE WHEN o_orderstatus = 'F' THEN 'r' ELSE 'c' END AS op, id, user_id,
       product_name, CAST(amount AS DECIMAL(20,2)) AS amount, created_at,
       created_at AS event_ts, false AS is_deleted, id * 10 AS lsn FROM f
UNION ALL
SELECT id, 'u', id, user_id, product_name, CAST(amount + 1 AS DECIMAL(20,2)), created_at,
       created_at + INTERVAL 1 SECOND, false, id * 10 + 1 FROM f WHERE updated
UNION ALL
SELECT id, 'd', id, CASE WHEN NOT keyed THEN user_id END,
       CASE WHEN NOT keyed THEN product_name END,
       CASE WHEN NOT keyed THEN CAST(amount + CASE WHEN updated THEN 1 ELSE 0 END
                                     AS DECIMAL(20,2)) END,
       CASE WHEN NOT keyed THEN created_at END,
       created_at + INTERVAL 2 SECOND, true, id * 10 + 2 FROM f WHERE deleted)
"""

USERS_LOG = f"""
WITH t AS ({USERS}),
f AS (SELECT *, c_mktsegment IN ('BUILDING', 'MACHINERY') AS updated,
             c_mktsegment = 'MACHINERY' AND c_nationkey >= 12 AS deleted,
             c_nationkey >= 18 AS keyed
      FROM t),
log AS (
SELECT id AS pk_id, CASE WHEN c_nationkey < 5 THEN 'r' ELSE 'c' END AS op, id, full_name, email,
       created_at, created_at AS event_ts, false AS is_deleted, id * 10 AS lsn FROM f
UNION ALL
SELECT id, 'u', id, full_name || ' Updated', email, created_at,
       created_at + INTERVAL 1 SECOND, false, id * 10 + 1 FROM f WHERE updated
UNION ALL
SELECT id, 'd', id, CASE WHEN NOT keyed THEN full_name || ' Updated' END,
       CASE WHEN NOT keyed THEN email END, CASE WHEN NOT keyed THEN created_at END,
       created_at + INTERVAL 2 SECOND, true, id * 10 + 2 FROM f WHERE deleted)
"""

EVENTS_LOG = f"""
WITH t AS ({EVENTS}),
f AS (SELECT *, kind IN ('purchase', 'error') AS updated, kind = 'error' AS deleted,
             value < 10 AS keyed
      FROM t),
exact AS (
SELECT id AS pk_id, CASE WHEN kind = 'signup' THEN 'r' ELSE 'c' END AS op, id, user_id, kind,
       value, props, created_at,
       created_at AS event_at, false AS is_deleted, id * 10 AS lsn FROM f
UNION ALL
SELECT id, 'u', id, user_id, kind, value + 1, props, created_at,
       created_at + INTERVAL 1 SECOND, false, id * 10 + 1 FROM f WHERE updated
UNION ALL
SELECT id, 'd', id, CASE WHEN NOT keyed THEN user_id END, CASE WHEN NOT keyed THEN kind END,
       CASE WHEN NOT keyed THEN value + 1 END, CASE WHEN NOT keyed THEN props END,
       CASE WHEN NOT keyed THEN created_at END,
       created_at + INTERVAL 2 SECOND, true, id * 10 + 2 FROM f WHERE deleted),
log AS (
SELECT pk_id, op, id, user_id, kind, value, props, date_trunc('second', created_at) AS created_at,
       date_trunc('millisecond', event_at) AS event_ts, is_deleted, lsn FROM exact)
"""

ORDERS_COLUMNS = (
    "pk_id, op, id, user_id, product_name, amount, created_at, event_ts, is_deleted"
)
USERS_COLUMNS = "pk_id, op, id, full_name, email, created_at, event_ts, is_deleted"
EVENTS_COLUMNS = (
    "pk_id, op, id, user_id, kind, value, props, created_at, event_ts, is_deleted"
)

# Current tables: last change per key, deleted rows left out.
ORDERS_STATE = f"""{ORDERS_LOG},
state AS (
SELECT id, user_id, product_name,
       CAST(amount + CASE WHEN updated THEN 1 ELSE 0 END AS DECIMAL(20,2)) AS amount, created_at
FROM f WHERE NOT deleted)
"""

USERS_STATE = f"""{USERS_LOG},
state AS (
SELECT id, full_name || CASE WHEN updated THEN ' Updated' ELSE '' END AS full_name, email,
       created_at
FROM f WHERE NOT deleted)
"""


def base64_of(amount: str) -> str:
    """The wire form of a positive amount below 2^39 hundredths."""
    number = f"CAST({amount} * 100 AS BIGINT)"
    size = (
        f"CASE WHEN {number} < 128 THEN 1 WHEN {number} < 32768 THEN 2 "
        f"WHEN {number} < 8388608 THEN 3 WHEN {number} < 2147483648 THEN 4 ELSE 5 END"
    )
    return f"to_base64(unhex(right(lpad(hex({number}), 10, '0'), 2 * ({size}))))"


def order_image(amount: str) -> str:
    """A full row image of an order as JSON text."""
    return (
        "'{\"id\":' || id || ',\"user_id\":' || user_id || ',\"product_name\":\"' || "
        f"product_name || '\",\"amount\":\"' || {base64_of(amount)} || '\",\"created_at\":' || "
        "epoch_us(created_at) || '}'"
    )


def order_message(before: str, after: str, op: str, step: int) -> str:
    """A wrapped value of an order change as JSON text."""
    return (
        f"'{{\"schema\":null,\"payload\":{{\"before\":' || {before} || ',\"after\":' || {after} || "
        f"',\"op\":\"' || {op} || '\",\"ts_ms\":' || (epoch_ms(created_at) + {step * 1000}) || "
        "',\"source\":{\"name\":\"appdb\",\"schema\":\"public\",\"table\":\"orders\",\"lsn\":' || "
        f"(id * 10 + {step}) || '}}}}}}'"
    )


_NEW = "(amount + CASE WHEN updated THEN 1 ELSE 0 END)"
_KEY = (
    "'{\"id\":' || id || ',\"user_id\":null,\"product_name\":null,\"amount\":null,"
    "\"created_at\":null}'"
)
_FIRST_OP = "CASE WHEN o_orderstatus = 'F' THEN 'r' ELSE 'c' END"

# Orders topic as text: one line per record, in the JSON the records hold.
ORDERS_TOPIC = f"""{ORDERS_LOG},
topic AS (
SELECT id * 10 AS "offset", '{{"schema":null,"payload":{{"id":' || id || '}}}}' AS key_str,
       {order_message("'null'", order_image('amount'), _FIRST_OP, 0)} AS json FROM f
UNION ALL
SELECT id * 10 + 1, '{{"schema":null,"payload":{{"id":' || id || '}}}}',
       {order_message(order_image('amount'), order_image('(amount + 1)'), "'u'", 1)}
FROM f WHERE updated
UNION ALL
SELECT id * 10 + 2, '{{"schema":null,"payload":{{"id":' || id || '}}}}',
       {order_message(f"CASE WHEN keyed THEN {_KEY} ELSE {order_image(_NEW)} END",
                      "'null'", "'d'", 2)}
FROM f WHERE deleted)
"""
