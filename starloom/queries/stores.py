"""Loads into tables and what is there afterwards."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from starloom.functions.window import IncrementalWindow
from starloom.operators.load import schema_diff
from starloom.operators.sets import DATABASE
from starloom.plans.run import load_all, load_table, recover
from starloom.plans.spec import MappingSet, TargetMapping
from starloom.queries.registry import query, table
from starloom.session import cut, shared_dir
from starloom.sinks import files
from starloom.sinks.datasets import write_extract, write_transformed, read_datasets
from starloom.sinks.store import StarStore
from starloom.sources.scan import latest_dataset, scan_layout
from starloom.streaming.incremental import read_landing, stream_upsert

ORDER = TargetMapping(
    name="fct_orders",
    sources=("orders",),
    key=("order_id",),
    columns={
        "order_id": "orders.o_orderkey", "customer_id": "orders.o_custkey", "status": "orders.o_orderstatus",
        "total": "orders.o_totalprice", "ordered_at": "orders.o_orderdate",
    },
    required=("status",),
    cluster_by=("customer_id", "ordered_at"),
    types={"order_id": "bigint", "customer_id": "bigint", "status": "varchar(50)", "total": "string", "ordered_at": "timestamp"},
)
ORDERS = MappingSet([ORDER])
LAST = TargetMapping(
    name="dim_last",
    sources=("orders",),
    key=("customer_id",),
    columns={"customer_id": "orders.o_custkey", "order_id": "orders.o_orderkey", "priority": "orders.o_orderpriority"},
    types={"customer_id": "bigint", "order_id": "bigint", "priority": "varchar(50)"},
)
LASTS = MappingSet([LAST])


@contextmanager
def passing_store(spark: SparkSession) -> Iterator[StarStore]:
    """A store in the shared folder that goes when its results are taken."""
    name = f"passing_{uuid4().hex}"
    store = StarStore(spark, name, f"{shared_dir(spark)}/{name}")
    try:
        yield store
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")
        files.remove(spark, store.root)


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("total"), F.col("o_orderdate").cast("timestamp").alias("ordered_at"),
    )


ORDER_SQL = """
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
           CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS total, CAST(o_orderdate AS TIMESTAMP) AS ordered_at FROM orders
"""
_PLAIN = ["order_id", "customer_id", "status", "total", "ordered_at"]


@query("load_clustered", f"SELECT * FROM ({ORDER_SQL}) UNION ALL SELECT * FROM ({ORDER_SQL}) WHERE status = 'P'")
def load_clustered(spark, sf):
    """Two appends into a declared table, in its layout, read back."""
    with passing_store(spark) as store:
        orders = _orders(spark, sf)
        load_table(store, ORDER.name, orders, ORDERS, cluster=True)
        load_table(store, ORDER.name, orders.filter("status = 'P'"), ORDERS)
        store.recluster(ORDER.name, ORDER.cluster_by, tie=ORDER.key, together=True)
        return cut(store.read(ORDER.name).select(*_PLAIN))


@query(
    "load_undeclared",
    """
    SELECT l_orderkey AS order_id, l_linenumber AS line, CAST(l_quantity AS DOUBLE) AS quantity,
           CAST(l_shipdate AS TIMESTAMP) AS shipped_at, l_returnflag AS flag FROM lineitem
    """,
)
def load_undeclared(spark, sf):
    """A table without declaration: types from the frame and the names of its columns."""
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"), F.col("l_quantity").cast("double").alias("quantity"),
        F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("shipped_at"), F.col("l_returnflag").alias("flag"),
    )
    with passing_store(spark) as store:
        load_table(store, "lines", lines, None)
        return cut(store.read("lines").select("order_id", "line", "quantity", "shipped_at", "flag"))


@query(
    "upsert_ties",
    "SELECT o_custkey AS customer_id, max(o_orderkey) AS order_id, arg_max(o_orderpriority, o_orderkey) AS priority FROM orders GROUP BY 1",
)
def upsert_ties(spark, sf):
    """No column says which row of a key is later: the one that arrives last stays."""
    rows = table(spark, sf, "orders").orderBy("o_orderkey").select(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderkey").alias("order_id"), F.col("o_orderpriority").alias("priority")
    )
    with passing_store(spark) as store:
        load_table(store, LAST.name, rows, LASTS, mode="upsert")
        return cut(store.read(LAST.name).select("customer_id", "order_id", "priority"))


@query(
    "upsert_buckets",
    """
    WITH a AS (SELECT o_custkey AS customer_id, max(o_orderkey) AS order_id FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1),
    b AS (SELECT o_custkey AS customer_id, min(o_orderkey) AS order_id FROM orders WHERE o_orderstatus = 'P' AND o_custkey % 3 = 0 GROUP BY 1)
    SELECT coalesce(b.customer_id, a.customer_id) AS customer_id, coalesce(b.order_id, a.order_id) AS order_id
    FROM a FULL JOIN b ON a.customer_id = b.customer_id
    """,
)
def upsert_buckets(spark, sf):
    """Two upserts into a table whose key is dealt to buckets; the second one replaces whole rows."""
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("customer_id"), F.col("o_orderkey").alias("order_id"), "o_orderstatus")
    with passing_store(spark) as store:
        load_table(store, LAST.name, orders.filter("o_orderstatus <> 'P'"), LASTS, mode="upsert", order_by=["order_id"], buckets=8)
        second = orders.filter("o_orderstatus = 'P' AND customer_id % 3 = 0").withColumn("n", -F.col("order_id"))
        store.upsert(LAST.name, second, ["customer_id"], ["n"])
        return cut(store.read(LAST.name).select("customer_id", "order_id"))


@query(
    "evolve_add",
    """
    SELECT o_orderkey AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id, o_orderstatus AS status,
           false AS is_new, CAST(NULL AS VARCHAR) AS note FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL SELECT o_orderkey, CAST(o_custkey AS VARCHAR), o_orderstatus, true, o_orderpriority FROM orders WHERE o_orderstatus = 'P'
    """,
)
def evolve_add(spark, sf):
    """New columns and one of another type in a partitioned table; old rows read the default or NULL."""
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), F.col("o_orderstatus").alias("status"),
        F.lit(True).alias("is_new"), F.col("o_orderpriority").alias("note"),
    )
    long, text = T.LongType(), T.StringType()
    with passing_store(spark) as store:
        store.ensure_table("t", T.StructType().add("order_id", long).add("customer_id", long).add("status", text), partition_by=["status"])
        store.append("t", orders.filter("status <> 'P'"))
        wider = T.StructType().add("order_id", long).add("customer_id", text).add("is_new", T.BooleanType()).add("note", text)
        store.evolve("t", wider.add("status", text))
        store.append("t", orders.filter("status = 'P'"))
        return cut(store.read("t").select("order_id", "customer_id", "status", "is_new", "note"))


@query(
    "schema_diff",
    """
    SELECT column_name AS "column",
           CASE WHEN column_name IN ('o_orderkey', 'o_orderstatus') THEN 'ok'
                WHEN column_name = 'o_totalprice' THEN 'mismatch' ELSE 'extra' END AS status
    FROM (DESCRIBE SELECT * FROM orders)
    UNION ALL SELECT 'o_note', 'missing'
    """,
)
def schema_diff_query(spark, sf):
    expected = T.StructType().add("O_ORDERKEY", T.IntegerType()).add("o_orderstatus", T.StringType())
    expected = expected.add("o_totalprice", T.StringType()).add("o_note", T.StringType())
    return schema_diff(spark, expected, table(spark, sf, "orders").schema).select("column", "status")


@query(
    "clear_targets",
    """
    SELECT 'fct_lines' AS "table", count(*) AS cleared, 0 AS "left" FROM lineitem
    UNION ALL SELECT 'fct_orders', count(*), 0 FROM orders
    """,
)
def clear_targets(spark, sf):
    """Rows go, also those of a partitioned table."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_returnflag").alias(DATABASE))
    with passing_store(spark) as store:
        load_table(store, ORDER.name, _orders(spark, sf), ORDERS)
        load_table(store, "fct_lines", lines, None, per_database=True)
        return cut(store.clear())


@query(
    "load_strategies",
    """
    SELECT 'fct_orders' AS "table", 'loaded' AS status, count(*) AS parsed, count(o_orderstatus) AS loaded FROM orders
    UNION ALL SELECT 'broken', 'failed', NULL, 0
    UNION ALL SELECT 'empty', 'skipped', 0, 0
    UNION ALL SELECT 'dim_last', 'recovered', count(*), count(*) FROM orders
    """,
)
def load_strategies(spark, sf):
    """One target fails, one has no rows, one is loaded by a recovery; a loaded one is not loaded again."""
    orders = table(spark, sf, "orders")
    broken = orders.select(F.raise_error(F.concat(F.lit("order "), F.col("o_orderkey").cast("string"))).cast("string").alias("x"))
    last = orders.select(F.col("o_custkey").alias("customer_id"), F.col("o_orderkey").alias("order_id"))
    with passing_store(spark) as store:
        targets = {ORDER.name: _orders(spark, sf), "broken": broken, "empty": orders.filter("o_orderkey < 0")}
        first = load_all(store, targets, "continue_on_error", ORDERS, parallel=2)
        again = recover(store, {ORDER.name: broken, LAST.name: last}, mappings=LASTS)
        rows = [(r[0], r[1], r[2], r[3]) for r in first.rows] + [(r[0], "recovered", r[2], r[3]) for r in again.rows]
    return spark.createDataFrame(rows, "table string, status string, parsed bigint, loaded bigint")


@query(
    "extract_layout",
    """
    SELECT 'tenant_' || lower(o_orderstatus) AS _database, o_orderkey, o_orderdate AS updated_at FROM orders
    WHERE o_orderstatus <> 'P' AND o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'
    """,
)
def extract_layout(spark, sf):
    """An extract partitioned by database, scanned again in a window for some databases."""
    rows = table(spark, sf, "orders").select(
        F.concat(F.lit("tenant_"), F.lower("o_orderstatus")).alias(DATABASE), "o_orderkey", F.col("o_orderdate").alias("updated_at")
    )
    root = f"{shared_dir(spark)}/extract-{uuid4().hex}"
    try:
        write_extract(spark, {"orders": rows}, root)
        found = scan_layout(spark, root, "orders", IncrementalWindow.between("1998-01-01"), exclude="_p", order_by=["o_orderkey"])
        return cut(found.select(DATABASE, "o_orderkey", "updated_at"))
    finally:
        files.remove(spark, root)


@query("transformed_datasets", "SELECT 'json' AS form, doc_id, text FROM documents UNION ALL SELECT 'parquet', doc_id, text FROM documents")
def transformed_datasets(spark, sf):
    """Targets as datasets of their own, compressed JSON lines and Parquet, read back."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    root = f"{shared_dir(spark)}/transformed-{uuid4().hex}"
    try:
        parts = []
        for form in ("json", "parquet"):
            write_transformed({"docs": docs}, f"{root}/{form}", format=form, gzip=form == "json")
            found = read_datasets(spark, f"{root}/{form}", ["docs"], format=form, schemas={"docs": docs.schema})["docs"]
            parts.append(found.select(F.lit(form).alias("form"), "doc_id", "text"))
        return cut(parts[0].unionByName(parts[1]))
    finally:
        files.remove(spark, root)


@query("newest_dataset", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P'")
def newest_dataset(spark, sf):
    """Of two extracts the one that was written last."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    root = f"{shared_dir(spark)}/datasets-{uuid4().hex}"
    try:
        for name, status in (("z-first", "F"), ("a-second", "P")):
            orders.filter(F.col("o_orderstatus") == status).drop("o_orderstatus").write.parquet(f"{root}/{name}")
        return cut(spark.read.parquet(latest_dataset(spark, root)))
    finally:
        files.remove(spark, root)


@query("stream_load", "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1")
def stream_load(spark, sf):
    """The events as a stream, upserted by user; a second run has nothing to do."""
    with passing_store(spark) as store:
        schema = T.StructType().add("user_id", T.LongType()).add("event_id", T.LongType()).add("event_type", T.StringType())
        given = table(spark, sf, "events").schema
        store.ensure_table("last_event", schema, key=["user_id"], buckets=4)
        for _ in range(2):
            stream = read_landing(spark, f"{sf.rstrip('/')}/events.parq*", given).select("user_id", "event_id", "event_type")
            stream_upsert(stream, store, "last_event", ["user_id"], ["event_id"], f"{store.root}/checkpoint").awaitTermination()
        return cut(store.read("last_event"))
