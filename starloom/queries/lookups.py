"""First-match lookup joins and the flagship star target."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from starloom.functions.clean import epoch_ms_to_timestamp, fill_null_defaults, stamp
from starloom.functions.window import IncrementalWindow, apply_window
from starloom.operators.lookup import Lookup, first_per_key, last_per_key, lookup_join
from starloom.operators.project import drop_empty_rows
from starloom.operators.sets import DATABASE
from starloom.queries.registry import query, table

FIELDS = {"first_order": "o_orderkey", "first_price": "o_totalprice", "first_priority": "o_orderpriority"}


def _customers(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")


@query(
    "lookup_first_match",
    """
    WITH f AS (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1)
    SELECT c_custkey AS o_custkey, c_name, o_orderkey AS first_order, o_totalprice AS first_price,
           o_orderpriority AS first_priority
    FROM customer LEFT JOIN f ON c_custkey = f.o_custkey
    """,
)
def lookup_first_match(spark, sf):
    lookup = Lookup(table(spark, sf, "orders"), FIELDS, ["o_orderkey"], key="o_custkey", on_miss="null")
    return lookup_join(_customers(spark, sf), {"orders": lookup}).select("o_custkey", "c_name", "_hit_orders.*")


NULL_SAFE_KEYS = """
    WITH c AS (SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_custkey END AS k, c_name FROM customer),
         o AS (SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS k, * FROM orders),
         f AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY k ORDER BY o_orderkey) = 1)
"""


@query(
    "lookup_null_safe",
    NULL_SAFE_KEYS
    + """
    SELECT c.k, c_name, o_orderkey AS first_order, o_totalprice AS first_price, o_orderpriority AS first_priority
    FROM c LEFT JOIN f ON c.k IS NOT DISTINCT FROM f.k
    """,
)
def lookup_null_safe(spark, sf):
    """A NULL key finds the rows with a NULL key."""
    customers = table(spark, sf, "customer").select(
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey")).alias("k"), "c_name"
    )
    orders = table(spark, sf, "orders").withColumn("k", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")))
    lookup = Lookup(orders, FIELDS, ["o_orderkey"], key="k", on_miss="null")
    return lookup_join(customers, {"orders": lookup}).select("k", "c_name", "_hit_orders.*")


@query(
    "lookup_first_row_fallback",
    """
    WITH o AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey END AS o_custkey,
                      CASE WHEN o_totalprice > 200000 THEN o_orderpriority END AS pr
               FROM orders),
         f AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1),
         a AS (SELECT * FROM o ORDER BY o_orderkey LIMIT 1)
    SELECT c_custkey AS o_custkey, c_name,
           CASE WHEN f.o_custkey IS NULL THEN a.o_orderkey ELSE f.o_orderkey END AS first_order,
           CASE WHEN f.o_custkey IS NULL THEN a.pr ELSE f.pr END AS first_priority
    FROM customer LEFT JOIN f ON c_custkey = f.o_custkey CROSS JOIN a
    """,
)
def lookup_first_row_fallback(spark, sf):
    """Customers without an urgent order get the first order of all; a match with NULL fields stays."""
    orders = table(spark, sf, "orders").withColumns(
        {
            "pr": F.when(F.col("o_totalprice") > 200000, F.col("o_orderpriority")),
            "o_custkey": F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_custkey")),
        }
    )
    lookup = Lookup(orders, {"first_order": "o_orderkey", "first_priority": "pr"}, ["o_orderkey"], key="o_custkey")
    return lookup_join(_customers(spark, sf), {"orders": lookup}).select("o_custkey", "c_name", "_hit_orders.*")


@query(
    "lookup_within_database",
    """
    WITH c AS (SELECT CASE c_mktsegment WHEN 'BUILDING' THEN 'F' WHEN 'MACHINERY' THEN 'O' ELSE 'P' END AS _database,
                      c_custkey FROM customer),
         o AS (SELECT * REPLACE (CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_custkey END AS o_custkey)
               FROM orders),
         f AS (SELECT * FROM o
               QUALIFY row_number() OVER (PARTITION BY o_orderstatus, o_custkey ORDER BY o_orderkey) = 1),
         a AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) = 1)
    SELECT c._database, c_custkey AS o_custkey, coalesce(f.o_orderkey, a.o_orderkey) AS first_order,
           coalesce(f.o_totalprice, a.o_totalprice) AS first_price,
           coalesce(f.o_orderpriority, a.o_orderpriority) AS first_priority
    FROM c LEFT JOIN f ON c._database = f.o_orderstatus AND c_custkey = f.o_custkey
           LEFT JOIN a ON c._database = a.o_orderstatus
    """,
)
def lookup_within_database(spark, sf):
    """Matches and the first row of all are looked for within the row's own database."""
    database = F.expr("CASE c_mktsegment WHEN 'BUILDING' THEN 'F' WHEN 'MACHINERY' THEN 'O' ELSE 'P' END")
    customers = table(spark, sf, "customer").select(database.alias(DATABASE), F.col("c_custkey").alias("o_custkey"))
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    orders = table(spark, sf, "orders").withColumn("o_custkey", F.when(urgent, F.col("o_custkey")))
    orders = orders.withColumnRenamed("o_orderstatus", DATABASE)
    lookup = Lookup(orders, FIELDS, ["o_orderkey"], key="o_custkey")
    joined = lookup_join(customers, {"orders": lookup}, scope=(DATABASE,))
    return joined.select(DATABASE, "o_custkey", "_hit_orders.*")


@query(
    "first_per_key",
    """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_extendedprice, l_partkey, l_suppkey) = 1
    """,
)
def first_per_key_query(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_shipdate"
    )
    order = ["l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey"]
    return first_per_key(lines, ["l_orderkey"], order).drop("l_shipdate")


@query(
    "last_per_key",
    """
    SELECT user_id, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1
    """,
)
def last_per_key_query(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value")
    return last_per_key(events, ["user_id"], ["event_id"])


@query(
    "star_target",
    """
    WITH n AS (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey),
         c AS (SELECT * FROM customer
               QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY c_custkey) = 1)
    SELECT o_orderkey AS order_id, o_custkey AS customer_id,
           CASE WHEN o_orderstatus = 'P' THEN 0 ELSE c_nationkey END AS tenant_id,
           c_name AS customer_name, c_mktsegment AS segment, n_name AS nation_name, r_name AS region_name,
           o_orderstatus AS status, o_totalprice AS amount,
           make_timestamp(epoch_us(o_orderdate)) AS created_at, TIMESTAMP '2024-06-01 00:00:00' AS etl_timestamp
    FROM orders LEFT JOIN c ON o_custkey = c_custkey LEFT JOIN n ON c_nationkey = n_nationkey
    WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-12-31'
    """,
)
def star_target(spark, sf):
    """A fact table in full: window, two lookups, cleaning, NULL default, epoch time and load time."""
    orders = apply_window(
        table(spark, sf, "orders"), IncrementalWindow.between("1996-01-01", "1999-12-31"), column="o_orderdate"
    ).withColumnRenamed("o_custkey", "c_custkey")
    regions = Lookup(
        table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey"),
        {"region_name": "r_name"}, ["n_regionkey"], key="n_regionkey", on_miss="null",
    )
    nations = lookup_join(table(spark, sf, "nation"), {"region": regions}).select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name", "_hit_region.region_name"
    )
    customers = Lookup(
        table(spark, sf, "customer"),
        {"c_nationkey": "c_nationkey", "customer_name": "c_name", "segment": "c_mktsegment"},
        ["c_custkey"], key="c_custkey", on_miss="null",
    )
    joined = lookup_join(orders, {"customer": customers}).select(*orders.columns, "_hit_customer.*")
    nation = Lookup(
        nations, {"nation_name": "n_name", "region_name": "region_name"}, ["c_nationkey"], key="c_nationkey",
        on_miss="null",
    )
    joined = lookup_join(joined, {"nation": nation})
    epoch = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    mapped = joined.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("c_custkey").alias("customer_id"),
        F.when(F.col("o_orderstatus") != "P", F.col("c_nationkey")).alias("tenant_id"),
        "customer_name",
        "segment",
        "_hit_nation.nation_name",
        "_hit_nation.region_name",
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("amount"),
        epoch.alias("created_at"),
    )
    filled = fill_null_defaults(drop_empty_rows(mapped), {"tenant_id": 0})
    timed = filled.withColumn("created_at", epoch_ms_to_timestamp(F.col("created_at"), filled.schema["created_at"].dataType))
    return stamp(timed, datetime(2024, 6, 1))
