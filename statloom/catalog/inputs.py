"""Inputs derived from the standard tables, in SQL both engines read.

Braces name the source; ``cte`` gives the same text as a WITH clause.
"""

from __future__ import annotations

INPUTS: dict[str, tuple[list[str], str]] = {
    # sensor readings, 1 in 7 values missing
    "readings": (
        ["events"],
        """SELECT event_id, user_id, ts, event_type,
                  CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value,
                  CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS kind
           FROM {events}""",
    ),
    "sensors": (
        ["events"],
        """SELECT user_id AS id, event_id, ts, value AS s1,
                  CAST(event_id % 13 AS DOUBLE) AS s2, CAST(5 AS DOUBLE) AS s3
           FROM {events}""",
    ),
    "invoices": (
        ["lineitem"],
        "SELECT l_suppkey AS vendor, l_extendedprice AS amount FROM {lineitem}",
    ),
    "passengers": (
        ["orders"],
        """SELECT o_orderkey AS passenger_id,
                  CASE WHEN o_orderkey % 97 = 0 THEN NULL
                       WHEN o_orderstatus = 'F' THEN 1
                       WHEN o_orderstatus = 'P' AND o_orderkey % 5 < 2 THEN 1 ELSE 0 END AS survived,
                  1 + o_custkey % 3 AS pclass,
                  CASE WHEN o_orderkey % 5 < 2 THEN 'female' ELSE 'male' END AS sex,
                  concat('Order', CAST(o_custkey AS STRING), ', ',
                         CASE WHEN o_orderkey % 23 = 1 THEN 'Dr' WHEN o_orderkey % 23 = 2 THEN 'Rev'
                              WHEN o_orderkey % 23 = 3 THEN 'Mme' WHEN o_orderkey % 23 = 4 THEN 'Mlle'
                              WHEN o_orderkey % 23 = 5 THEN 'Ms' WHEN o_orderkey % 23 = 6 THEN 'Master'
                              WHEN o_orderkey % 23 = 7 THEN 'Countess'
                              WHEN o_orderkey % 5 = 0 THEN 'Miss' WHEN o_orderkey % 5 = 1 THEN 'Mrs'
                              ELSE 'Mr' END, '. Key') AS name,
                  CASE WHEN o_orderkey % 7 = 0 THEN NULL
                       ELSE CAST(floor(o_totalprice / 6250) AS INT) END AS age,
                  o_custkey % 4 AS sibsp, o_orderkey % 3 AS parch,
                  CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_totalprice / 1000 END AS fare,
                  CASE WHEN o_orderkey % 11 = 0 THEN NULL
                       WHEN o_orderpriority = '2-HIGH' THEN 'C'
                       WHEN o_orderpriority = '3-MEDIUM' THEN 'Q' ELSE 'S' END AS embarked
           FROM {orders}""",
    ),
    "trips": (
        ["lineitem", "orders"],
        """SELECT concat('M', CAST(l_suppkey AS STRING)) AS medallion, l_returnflag AS payment_type,
                  l_linenumber AS passenger_count, l_quantity / 5 AS trip_distance,
                  CAST(l_quantity * 420 AS BIGINT) AS trip_time_in_secs,
                  o_orderdate AS pickup, l_shipdate AS dropoff,
                  l_extendedprice / 1000 AS fare_amount,
                  l_extendedprice * (l_discount - 0.01) / 1000 AS tip_amount,
                  l_extendedprice * (1 + l_tax) / 500 AS total_amount,
                  40 + (l_partkey % 100) / 200 AS pickup_lat, -74 + (l_suppkey % 50) / 100 AS pickup_lon,
                  40 + (l_orderkey % 100) / 200 AS dropoff_lat, -74 + (l_partkey % 50) / 100 AS dropoff_lon,
                  CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END AS tipped
           FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    ),
    "loans": (
        ["orders", "customer", "nation"],
        """SELECT o_orderkey AS id, o_orderstatus AS loan_status,
                  CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_bad,
                  substring(o_orderpriority, 1, 1) AS grade, n_name AS addr_state,
                  5 + (o_custkey % 200) / 10 AS int_rate, o_totalprice AS funded_amnt,
                  o_totalprice / 36 AS installment, c_acctbal AS revol_bal, c_mktsegment AS home_ownership,
                  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_custkey % 100 AS INT) END AS bc_util
           FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey""",
    ),
    "rfm_orders": (
        ["orders"],
        "SELECT o_custkey AS customer, o_orderkey AS order_id, o_totalprice AS amount, o_orderdate AS day, o_orderstatus AS status FROM {orders}",
    ),
}


def cte(*names: str) -> str:
    """WITH clause defining the named inputs over the plain tables."""
    parts = []
    for name in names:
        sources, text = INPUTS[name]
        parts.append(f"{name} AS ({text.format(**{s: s for s in sources})})")
    return "WITH " + ", ".join(parts) + " "
