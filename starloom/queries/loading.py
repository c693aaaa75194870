"""Loads: upsert, rejects, schema evolution."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from starloom.operators.load import REJECTS, accepted, conform, load_with_rejects, rejected, upsert
from starloom.operators.sets import union_all
from starloom.queries.registry import query, table

COLUMNS = ["o_orderkey", "o_totalprice", "o_orderpriority", "seq"]


def _changes(orders):
    """Two versions of each open order, new orders, and orders without a key."""
    opened = orders.filter("o_orderstatus = 'O'")
    first = opened.select("o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"), "o_orderpriority", F.lit(1).alias("seq"))
    second = opened.select("o_orderkey", (F.col("o_totalprice") + 2).alias("o_totalprice"), F.lit(None).cast("string").alias("o_orderpriority"), F.lit(2).alias("seq"))
    new = orders.filter("o_orderstatus = 'F'").select(
        (F.col("o_orderkey") + 1_000_000_000_000).alias("o_orderkey"), "o_totalprice", "o_orderpriority", F.lit(1).alias("seq")
    )
    unkeyed = orders.filter("o_orderstatus = 'P'").select(
        F.lit(None).cast("bigint").alias("o_orderkey"), "o_totalprice", "o_orderpriority", F.lit(1).alias("seq")
    )
    return union_all([second, first, new, unkeyed])


@query(
    "upsert_last_wins",
    """
    SELECT o_orderkey, o_totalprice, o_orderpriority, 0 AS seq FROM orders WHERE o_orderstatus <> 'O'
    UNION ALL SELECT o_orderkey, o_totalprice + 2, NULL, 2 FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT o_orderkey + 1000000000000, o_totalprice, o_orderpriority, 1 FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT NULL, o_totalprice, o_orderpriority, 1 FROM orders WHERE o_orderstatus = 'P'
    """,
)
def upsert_last_wins(spark, sf):
    orders = table(spark, sf, "orders")
    existing = orders.withColumn("seq", F.lit(0)).select(*COLUMNS)
    return upsert(existing, _changes(orders), ["o_orderkey"], ["seq"])


@query(
    "append_without_key",
    """
    SELECT n_nationkey, n_name FROM nation
    UNION ALL SELECT c_nationkey, c_name FROM customer
    """,
)
def append_without_key(spark, sf):
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    more = table(spark, sf, "customer").select(F.col("c_nationkey").alias("n_nationkey"), F.col("c_name").alias("n_name"), "c_acctbal")
    return upsert(nations, more, [], [])


ORDER_TARGET = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("is_open", T.BooleanType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("status", T.StringType(), True, {"max_length": 8}),
        T.StructField("note", T.StringType()),
    ]
)


def _raw_orders(spark, sf):
    """Orders as text with faults: amounts, flags and times that do not convert, missing keys, long texts."""
    return table(spark, sf, "orders").select(
        F.when(F.col("o_totalprice") > 20000, F.col("o_orderkey").cast("string")).alias("ORDER_ID"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("n/a")).otherwise(F.col("o_custkey").cast("string")).alias("Amount"),
        F.when(F.col("o_orderstatus") == "O", F.lit("True")).when(F.col("o_orderstatus") == "F", F.lit("0")).alias("is_open"),
        F.when(F.col("o_orderpriority") == "2-HIGH", F.lit(5)).otherwise(F.unix_millis(F.col("o_orderdate").cast("timestamp"))).alias("created_at"),
        F.col("o_orderpriority").alias("status"),
        F.col("o_custkey").alias("ignored"),
    )


RAW_SQL = """
    SELECT CASE WHEN o_totalprice > 20000 THEN o_orderkey END AS order_id,
           CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_custkey AS DOUBLE) END AS amount,
           CASE o_orderstatus WHEN 'O' THEN true WHEN 'F' THEN false END AS is_open,
           CASE WHEN o_orderpriority <> '2-HIGH' THEN o_orderdate END AS created_at,
           o_orderpriority AS status, CAST(NULL AS VARCHAR) AS note,
           concat_ws('; ',
               CASE WHEN NOT o_totalprice > 20000 THEN 'order_id: NULL' END,
               CASE WHEN o_orderpriority = '5-LOW' THEN 'amount: not double' END,
               CASE WHEN o_orderpriority = '2-HIGH' THEN 'created_at: not timestamp' END,
               CASE WHEN length(o_orderpriority) > 8 THEN 'status: longer than 8' END) AS reasons
    FROM orders
"""


def _checked(spark, sf):
    return load_with_rejects(_raw_orders(spark, sf), ORDER_TARGET, required=("order_id",), lengths=True)


@query("load_accepted", f"SELECT order_id, amount, is_open, created_at, status, note FROM ({RAW_SQL}) WHERE reasons = ''")
def load_accepted(spark, sf):
    return accepted(_checked(spark, sf))


@query("load_rejects", f"SELECT * FROM ({RAW_SQL}) WHERE reasons <> ''")
def load_rejects(spark, sf):
    return rejected(_checked(spark, sf)).withColumn("reasons", F.array_join(REJECTS, "; ")).drop(REJECTS)


@query(
    "schema_evolution",
    """
    SELECT p_partkey AS part_id, p_name AS name, CAST(NULL AS BOOLEAN) AS is_large, CAST(p_size AS BIGINT) AS size
    FROM part WHERE p_type <> 'LARGE'
    UNION ALL SELECT p_partkey, p_name, true, CAST(p_size AS BIGINT) FROM part WHERE p_type = 'LARGE'
    """,
)
def schema_evolution(spark, sf):
    """Rows of the old shape and of the new one in one schema; the column type is widened by a safe cast."""
    schema = T.StructType(
        [
            T.StructField("part_id", T.LongType()),
            T.StructField("name", T.StringType()),
            T.StructField("is_large", T.BooleanType()),
            T.StructField("size", T.LongType()),
        ]
    )
    parts = table(spark, sf, "part")
    old = parts.filter("p_type <> 'LARGE'").selectExpr("p_partkey AS part_id", "p_name AS name", "string(p_size) AS size")
    new = parts.filter("p_type = 'LARGE'").selectExpr("p_partkey AS part_id", "p_name AS NAME", "1 AS is_large", "p_size AS size")
    return union_all([conform(old, schema), conform(new, schema)])
